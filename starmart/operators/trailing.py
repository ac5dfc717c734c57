"""Latest years, latest rows and means."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.text import as_date, year_of


def latest_year(df: DataFrame, date: str) -> DataFrame:
    """One row: the latest ``year`` of ``date`` and the number of its rows, ``count``."""
    return (
        df.groupBy(year_of(date).alias("year")).count().orderBy(F.col("year").desc()).limit(1)
    )


def within_latest_years(df: DataFrame, date: str, years: int = 10) -> DataFrame:
    """Rows of the last ``years`` calendar years, counted back from the latest one in ``df``.

    The first day of the slice is a scalar subquery: one plan, no value read by the driver. It is
    compared with the date column itself, so for date and timestamp columns the test reaches the
    file scan and row groups outside the slice are not read.
    """
    if years < 1:
        raise ValueError("years must be at least 1")
    kind = df.schema[date].dataType.typeName()
    native = kind in ("date", "timestamp", "timestamp_ntz")
    column = F.col(f"`{date}`") if native else as_date(date)
    first_year = F.year(F.max(column)) - (years - 1)
    first_day = F.make_date(first_year, F.lit(1), F.lit(1))
    start = df.agg((first_day.cast(kind) if native else first_day).alias("start"))
    return df.filter(column >= start.scalar())


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType)


def _comparable(df: DataFrame, name: str) -> Column:
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.MapType) and not _has_map(kind.valueType):
        column = F.map_from_entries(F.array_sort(F.map_entries(column)))
    return F.to_json(F.struct(column)) if _has_map(kind) else column


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per ``keys``: the largest by ``order``, then by the other columns.

    Maps have no order; they, and columns with maps in them, are compared by their JSON texts.
    The result is the same in every run, and each task first reduces its own rows, so a hot key
    costs one row per task in the shuffle.
    """
    wanted = [name for name in (columns or df.columns) if name not in keys]
    ranked = list(order) + [name for name in wanted if name not in order]
    row = F.struct(*[F.col(f"`{name}`") for name in ranked])
    if any(_has_map(df.schema[name].dataType) for name in ranked):
        best = F.max_by(row, F.struct(*[_comparable(df, name) for name in ranked])).alias("__row")
    else:
        best = F.max(row).alias("__row")
    named = [F.col(f"`{key}`") for key in keys]
    return df.groupBy(*named).agg(best).select(*named, *[F.col(f"__row.`{name}`") for name in wanted])


def mean_by(
    df: DataFrame,
    keys: Sequence[str],
    columns: dict[str, str],
    dedupe: str = "none",
    location: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """Mean of several columns per key; ``columns`` maps each to its name in the result.

    NULL, and text that is no number, is left out. ``dedupe="latest"`` first keeps the latest row
    by ``order`` of each ``location``; ``"none"`` uses every row.
    """
    if dedupe == "latest":
        used = list(dict.fromkeys([*location, *keys, *order, *columns]))
        df = latest_per_key(df.select(*[f"`{name}`" for name in used]), location, order)
    elif dedupe != "none":
        raise ValueError(f"unknown dedupe: {dedupe}")
    means = [
        F.avg(F.col(f"`{name}`").try_cast("double")).alias(new) for name, new in columns.items()
    ]
    return df.groupBy(*[F.col(f"`{key}`") for key in keys]).agg(*means)
