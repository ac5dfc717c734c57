"""Row-count gates, output checks and profiles."""

import logging
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.sources import staging

logger = logging.getLogger(__name__)

PROBE_ROWS = 1_000


def require_rows(df: DataFrame, name: str, min_rows: int = 1) -> DataFrame:
    """Raise ``AssertionError`` when ``df`` has fewer than ``min_rows`` rows, else return it.

    A small minimum is probed with rows of one constant: Spark tries one partition first and more
    only while rows are missing, so a scan-and-filter plan stops early. A large minimum is counted
    in full, without collecting rows.
    """
    if min_rows <= PROBE_ROWS:
        found = len(df.select(F.lit(1)).take(min_rows))
    else:
        found = df.count()
    if found < min_rows:
        raise AssertionError(f"{name}: {found} rows, at least {min_rows} required")
    return df


def write_checked(
    df: DataFrame,
    name: str,
    write: Callable[[DataFrame], None],
    min_rows: int = 1,
    cache: bool = False,
) -> int:
    """Write only a table that passes ``require_rows``; the number of rows written is returned.

    For sinks that cannot be staged, such as those that append; ``write_gated`` is the gate of all
    others. The table is probed before the write, which runs the shuffles of its plan once more,
    unless a small result is kept by ``cache``. Rows are counted by an observation of the write
    itself, so ``write`` must run one action on the table it is given.
    """
    if cache:
        df = df.persist()
    written = Observation()
    try:
        require_rows(df, name, min_rows)
        write(df.observe(written, F.count(F.lit(1)).alias("rows")))
    finally:
        if cache:
            df.unpersist()
    rows = written.get["rows"]
    logger.info("%s: %d rows written", name, rows)
    return rows


def write_gated(
    df: DataFrame,
    name: str,
    path: str,
    write: Callable[[DataFrame, str], None],
    min_rows: int = 1,
) -> int:
    """Write ``df`` in place of the output at ``path`` if it has ``min_rows`` rows; their number.

    The plan runs once: the rows are counted by an observation while ``write(df, folder)`` writes them
    to a staging folder, and only a table that passes is moved to ``path``. With too few rows an
    ``AssertionError`` is raised. Then, and when the job is lost, the old output stays as it was, so
    ``df`` may also be derived from it.
    """
    spark = df.sparkSession
    staged = staging.stage(spark, path)
    counted = Observation()
    try:
        write(df.observe(counted, F.count(F.lit(1)).alias("rows")), staged)
        rows = counted.get.get("rows", 0)
        if rows < min_rows:
            raise AssertionError(f"{name}: {rows} rows, at least {min_rows} required")
    except BaseException:
        staging.drop_staged(spark, path)
        raise
    staging.commit(spark, path)
    logger.info("%s: %d rows written", name, rows)
    return rows


def require_clean(good: DataFrame, bad: DataFrame, name: str, most: float) -> DataFrame:
    """Rows of a quarantine by ``reason``, as ``count``; raises where their share is above ``most``.

    ``good`` and ``bad`` are the tables of ``read_csv_checked``; each is counted in one pass.
    """
    reasons = value_profile(bad, "reason")
    # The list of reasons grows with the columns of the table, not with its rows.
    found = sorted(reasons.collect(), key=lambda row: (-row["count"], row["reason"]))
    wrong = sum(row["count"] for row in found)
    total = wrong + (good.count() if wrong else 0)
    if wrong > most * total:
        listed = ", ".join(f"{row['count']} {row['reason']}" for row in found)
        limit = f"at most {100 * most:.3g}%"
        raise AssertionError(f"{name}: {wrong} of {total} records are malformed, {limit}: {listed}")
    return reasons


def row_counts(tables: Mapping[str, DataFrame], min_rows: int = 1) -> DataFrame:
    """One row per table: ``table``, ``rows``, ``passed``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    report = reduce(DataFrame.unionAll, counts)
    return report.withColumn("passed", F.col("rows") >= min_rows)


def value_profile(df: DataFrame, *columns: str) -> DataFrame:
    """Number of rows per value, as ``count``."""
    return df.groupBy(*columns).count()


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: ``column``, ``rows``, ``nulls``. One pass over the table."""
    names = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(*[F.count_if(F.col(f"`{name}`").isNull()) for name in names]).alias("nulls"),
    )
    labelled = F.arrays_zip(
        F.array(*[F.lit(name) for name in names]).alias("column"), F.col("nulls")
    )
    return counts.select("rows", F.inline(labelled).alias("column", "nulls")).select(
        "column", "rows", "nulls"
    )


def output_report(
    spark: SparkSession, outputs: Mapping[str, tuple], count: bool = True
) -> DataFrame:
    """One row per expected output: ``output``, ``exists``, ``rows``.

    ``outputs`` maps a name to its format and path, and to reader options if there are any. A CSV
    is expected to have a header. Without ``count`` the outputs are only looked for and ``rows`` is
    NULL. Only a path that is not there counts as missing; one that cannot be read is an error.
    """
    rows = []
    for name, (format, path, *options) in outputs.items():
        reader = spark.read.options(header=True).options(**(options[0] if options else {}))
        try:
            df = reader.format(format).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows.append(_report_row(spark.range(1), name, False, F.lit(0)))
            continue
        if count:
            counted = df.agg(F.count(F.lit(1)).alias("rows"))
            rows.append(_report_row(counted, name, True, F.col("rows")))
        else:
            rows.append(_report_row(spark.range(1), name, True, F.lit(None)))
    return reduce(DataFrame.unionAll, rows)


def _report_row(df: DataFrame, name: str, exists: bool, rows) -> DataFrame:
    return df.select(
        F.lit(name).alias("output"),
        F.lit(exists).alias("exists"),
        rows.cast("long").alias("rows"),
    )


def require_outputs(
    spark: SparkSession, outputs: Mapping[str, tuple], min_rows: int = 0
) -> DataFrame:
    """The report; raises ``AssertionError`` when an output is missing or too short."""
    report = output_report(spark, outputs, count=min_rows > 0)
    short = F.col("exists") & (F.col("rows") < min_rows)
    failed = report.filter(~F.col("exists") | F.coalesce(short, F.lit(False))).collect()
    if failed:
        raise AssertionError("outputs missing or too short: " + ", ".join(r.output for r in failed))
    return report
