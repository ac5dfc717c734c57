"""Means over the latest years from stored monthly sums.

A folder ``y<year>`` below ``path`` holds the states of that year: one row for each month and key with
the sum and number of every column, so the mean of any number of years is merged from them. A new
month is read alone: its states take the place of those of that month, and only the folders of its
years are written anew. Adding the same month twice changes nothing.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.text import as_date
from starmart.sources import files, staging
from starmart.sources.scratch import materialize
from starmart.sources.writers import write_parquet


def _folder(path: str, year: int) -> str:
    return f"{path.rstrip('/')}/y{year}"


def state_years(spark: SparkSession, path: str) -> list[int]:
    """The years with states, in order; what a lost commit had moved away is brought back."""
    found = files.names(spark, path)
    for name in found:
        if name.startswith("_y") and name.endswith(".previous"):
            staging.recover(spark, _folder(path, int(name[2:-9])))
    return sorted(int(name[1:]) for name in files.names(spark, path) if name.startswith("y"))


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def monthly_states(
    df: DataFrame, keys: Sequence[str], date: str, columns: Sequence[str]
) -> DataFrame:
    """(year, month, keys, ``sums``, ``counts``): sums and numbers of ``columns``, in their order.

    NULL and text that is no number count nothing, but the row's month exists. Rows without a valid
    date belong to no month.
    """
    day = as_date(_quoted([date])[0])
    # Positions, as names of keys may be those of the columns made here.
    chosen = df.select(
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        *[key.alias(f"key{n}") for n, key in enumerate(_quoted(keys))],
        *[value.try_cast("double").alias(f"value{n}") for n, value in enumerate(_quoted(columns))],
    )
    at = ["year", "month", *[f"key{n}" for n in range(len(keys))]]
    values = [f"value{n}" for n in range(len(columns))]
    return (
        chosen.filter("year IS NOT NULL")
        .groupBy(*at)
        .agg(
            F.array(*[F.coalesce(F.sum(v), F.lit(0.0)) for v in values]).alias("sums"),
            F.array(*[F.count(v) for v in values]).alias("counts"),
        )
    )


def add_months(
    df: DataFrame, path: str, keys: Sequence[str], date: str, columns: Sequence[str]
) -> list[int]:
    """Put the months found in ``df`` into the states at ``path``; the years written are returned.

    ``df`` holds all rows of its months. It is read once, and of the states only those of its years.
    Each year is put in place by a rename: a lost job leaves every year as it was or as it should be,
    and the same call again completes it. One job adds to a path at a time.
    """
    spark = df.sparkSession
    old_years = set(state_years(spark, path))
    new = materialize(monthly_states(df, keys, date, columns), "states")
    # A row for each calendar month.
    months = new.select("year", "month").distinct()
    years = sorted(row["year"] for row in months.select("year").distinct().collect())
    if not years:
        return []
    merged = new
    kept = [_folder(path, year) for year in years if year in old_years]
    if kept:
        old = spark.read.schema(new.schema).parquet(*kept)
        merged = new.unionByName(old.join(F.broadcast(months), ["year", "month"], "left_anti"))
    staged = f"{path.rstrip('/')}/_staged"
    files.remove(spark, staged)
    # The folder gives the year, the column stays in the files as well.
    write_parquet(merged.withColumn("of", F.col("year")), staged, partition_by=["of"])
    for year in years:
        target = _folder(path, year)
        files.move(spark, f"{staged}/of={year}", staging.stage(spark, target))
        staging.commit(spark, target)
    files.remove(spark, staged)
    return years


def mean_of_states(
    spark: SparkSession, path: str, keys: Sequence[str], columns: dict[str, str], years: int = 10
) -> DataFrame:
    """Mean of several columns per key over the latest ``years`` calendar years of the states.

    ``keys`` and ``columns`` are those of ``add_months``, in their order; ``columns`` maps each to its
    name in the result. The window ends with the latest year of any row. Only its folders are read.
    """
    if years < 1:
        raise ValueError("years must be at least 1")
    found = state_years(spark, path)
    if not found:
        raise FileNotFoundError(f"no states at {path}")
    window = [_folder(path, year) for year in found if year > found[-1] - years]
    states = spark.read.parquet(*window)
    means = [
        # A group without numbers has no mean.
        F.try_divide(F.sum(F.get("sums", F.lit(n))), F.sum(F.get("counts", F.lit(n)))).alias(new)
        for n, new in enumerate(columns.values())
    ]
    grouped = states.groupBy(*[f"key{n}" for n in range(len(keys))]).agg(*means)
    named = [F.col(f"key{n}").alias(key) for n, key in enumerate(keys)]
    return grouped.select(*named, *_quoted(list(columns.values())))
