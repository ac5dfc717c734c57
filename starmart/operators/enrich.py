"""Star join of a fact table to its dimensions."""

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import (
    BROADCAST_BYTES,
    broadcast_join,
    fits_broadcast,
    skew_join,
)
from starmart.operators.trailing import latest_per_key


def one_row_per_key(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per non-NULL key: the one with the largest ``prefer`` values, then by all columns."""
    known = df.dropna(subset=list(keys))
    return latest_per_key(known, keys, prefer)


@dataclass(frozen=True)
class Dimension:
    """A dimension table and the fact columns that refer to its key.

    ``on`` maps fact columns to dimension columns. ``columns`` maps the wanted dimension columns
    to their names in the result. Of several rows with one key the one with the largest
    ``prefer`` values is used, so facts are never multiplied; ``unique`` saves that step.
    """

    table: DataFrame
    on: Mapping[str, str]
    columns: Mapping[str, str]
    prefer: Sequence[str] = field(default_factory=tuple)
    unique: bool = False

    def candidates(self) -> DataFrame:
        used = dict.fromkeys([*self.on.values(), *self.prefer, *self.columns])
        return self.table.select(*[F.col(f"`{name}`") for name in used])

    def rows(self, candidates: DataFrame) -> DataFrame:
        """Key and wanted columns under their names in the result, one row per key."""
        keys = list(self.on.values())
        df = candidates if self.unique else one_row_per_key(candidates, keys, self.prefer)
        return df.select(
            *[F.col(f"`{name}`").alias(fact) for fact, name in self.on.items()],
            *[F.col(f"`{name}`").alias(new) for name, new in self.columns.items()],
        )


def enrich(
    fact: DataFrame,
    dimensions: Iterable[Dimension],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left-join every dimension; the fact table keeps its rows and their number.

    Dimensions whose files are not much larger than ``broadcast_bytes`` are measured in one job, with
    their repeated keys, and broadcast when small together; others are joined by a shuffle that splits
    hot keys. Large ones with the same fact columns are joined
    to each other first, so that the fact table is shuffled once for all of them. A dimension
    derived from a large table should be written first (see ``materialize``), else measuring it
    computes it once more. With ``broadcast_bytes=0`` every join is a shuffle.
    """
    dimensions = list(dimensions)
    tables = [dimension.candidates() for dimension in dimensions]
    result, large = fact, {}
    for dimension, table, small in zip(dimensions, tables, fits_broadcast(tables, broadcast_bytes)):
        keys, table = tuple(dimension.on), dimension.rows(table)
        if small:
            result = broadcast_join(result, table, keys)
        elif keys in large:
            large[keys] = _both(large[keys], table, keys)
        else:
            large[keys] = table
    strategy = "merge" if broadcast_bytes <= 0 else None
    for keys, table in large.items():
        result = skew_join(result, table, keys, probe=fact, strategy=strategy)
    added = [new for dimension in dimensions for new in dimension.columns.values()]
    return result.select(*[F.col(f"`{name}`") for name in [*fact.columns, *added]])


def _both(one: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of two dimensions by key, with what either has."""
    return one.join(other.hint("merge"), list(keys), "full")


def match_shares(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Share of rows whose column is not NULL, one row; ``columns`` maps columns to result names."""
    return df.agg(
        *[F.avg(F.col(f"`{name}`").isNotNull().cast("int")).alias(new) for name, new in columns.items()]
    )
