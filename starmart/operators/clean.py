"""Column and row cleaning."""

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the named columns; names the table does not have are ignored."""
    return df.drop(*names)


@dataclass(frozen=True)
class LabelRule:
    """Which values of a label column are valid.

    ``markers`` are substrings, matched with case, that make a label invalid. A NULL label passes
    no marker test, so it is dropped whenever markers are given, and also when ``required``.
    """

    column: str
    markers: tuple[str, ...] = ()
    required: bool = True

    def valid(self) -> Column:
        label = F.col(f"`{self.column}`")
        tests = [~label.contains(marker) for marker in self.markers]
        if self.required:
            tests.append(label.isNotNull())
        return reduce(lambda left, right: left & right, tests, F.lit(True))


def drop_invalid_labels(df: DataFrame, rules: Iterable[LabelRule]) -> DataFrame:
    """Keep the rows whose labels pass every rule, in one filter."""
    valid = reduce(lambda left, right: left & right, (rule.valid() for rule in rules), F.lit(True))
    return df.filter(valid)
