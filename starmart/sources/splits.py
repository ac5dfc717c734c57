"""Lines of large text files, read in splits by many tasks and numbered along each file.

Spark reads a file in blocks of ``spark.sql.files.maxPartitionBytes``, each line in the block where it
begins. What a line needs to know of the lines before it is found in two steps: a running value inside
its block, and one over the blocks of the file, of which there are few.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = ["path", "block"]


def file_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """``path``, ``block`` (first byte of the block), ``seq`` (grows by 1 along a block), ``value``."""
    lines = spark.read.options(**options).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def before(*order: str, within: list[str] = BLOCK):
    """The rows before the current one; those of a file's blocks with ``within=["path"]``."""
    return W.partitionBy(*within).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)


def block_starts(lines: DataFrame, **totals: Column) -> DataFrame:
    """A row per block: ``path``, ``block``, ``first_seq``, ``lines_before``, and the sum of each of
    ``totals`` over all earlier blocks of the file as ``<name>_before``."""
    blocks = lines.groupBy(*BLOCK).agg(
        F.min("seq").alias("first_seq"),
        F.count(F.lit(1)).alias("lines"),
        *[F.sum(column).alias(name) for name, column in totals.items()],
    )
    earlier = before("block", within=["path"])
    sums = [F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_before") for name in ("lines", *totals)]
    return blocks.select(*BLOCK, "first_seq", *sums)


def line_number() -> Column:
    """The number of a line in its file, from 1, for lines joined with the starts of their blocks."""
    return F.col("lines_before") + F.col("seq") - F.col("first_seq") + 1


def toggled(df: DataFrame, known: Column, odd: Column, order: str, within: list[str], state: str) -> DataFrame:
    """Running state of a switch: adds ``<state>`` and ``<state>_odd`` as they are before each row.

    Each row sets the switch to ``known``, or turns it if ``known`` is NULL and ``odd``, or leaves it.
    ``<state>`` is NULL where no row of the group has set it yet; then ``<state>_odd`` says whether it
    has been turned an odd number of times since the start.
    """
    turns, last = f"{state}_turns", f"{state}_last"
    span = before(order, within=within)
    turned = F.sum((known.isNull() & odd).cast("int")).over(span)
    df = df.withColumn(turns, F.coalesce(turned, F.lit(0)))
    df = df.withColumn(last, F.last(F.when(known.isNotNull(), F.struct(known.alias("to"), turns)), ignorenulls=True).over(span))
    since = (F.col(turns) - F.col(f"{last}.{turns}")) % 2 == 1
    return df.withColumns({
        state: F.col(f"{last}.to") != since,
        f"{state}_odd": F.col(turns) % 2 == 1,
    }).drop(turns, last)
