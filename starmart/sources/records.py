"""CSV files with line breaks in cells, read by many tasks, and malformed records kept apart.

A record ends at the first line break outside of quotes. A line cannot know by itself whether it
starts inside of a quoted cell, but the number of quotes before it does: with quotes doubled inside of
cells, as ``write_csv`` writes them, it is odd exactly then. Quotes are counted per line, and lines
with an odd number turn the state; they are counted along each block and over the blocks of a file, so
a file of any size is read by as many tasks as it has blocks, and only lines of records with line
breaks are grouped.

A quote in a cell that is not quoted as a whole breaks this rule, as it breaks the format.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.text import strip
from starmart.sources.readers import with_types
from starmart.sources.splits import BLOCK, before, block_starts, file_lines, line_number
from starmart.sources.writers import CSV_QUOTES

_CORRUPT = "__corrupt"


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``line`` (the first one, from 1), ``record`` and ``open``.

    ``open`` marks what follows a last quote that is never closed: its lines are not joined but come
    one by one, so a lost quote does not gather the rest of a file in one row. Blank records are left
    out. Line breaks inside of cells stay as they are.
    """
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    lines = file_lines(spark, path, lineSep="\n").withColumn("odd", odd)
    blocks = block_starts(lines, odd=F.col("odd"))
    totals = lines.groupBy("path").agg(F.sum("odd").alias("odd_lines"))
    counted = lines.join(blocks, BLOCK).withColumn("line", line_number())
    turns = F.col("odd_before") + F.coalesce(F.sum("odd").over(before("seq")), F.lit(0))
    counted = counted.withColumn("turns", turns).join(totals, "path")
    # The n-th odd line opens a record that the next one closes; n is odd.
    inside = F.col("turns") % 2 == 1
    opened = F.when(inside, F.col("turns")).when(F.col("odd") == 1, F.col("turns") + 1)
    unclosed = (opened == F.col("odd_lines")) & (F.col("odd_lines") % 2 == 1)
    counted = counted.select(
        "path", "line", "value", opened.alias("opened"), F.coalesce(unclosed, F.lit(False)).alias("open")
    )
    alone = counted.filter("opened IS NULL OR open").select("path", "line", F.col("value").alias("record"), "open")
    parts = F.sort_array(F.collect_list(F.struct("line", "value")))
    joined = counted.filter("opened IS NOT NULL AND NOT open").groupBy("path", "opened").agg(
        F.min("line").alias("line"), F.array_join(F.transform(parts, lambda part: part["value"]), "\n").alias("record")
    )
    records = alone.unionByName(joined.select("path", "line", "record", F.lit(False).alias("open")))
    # The line end of other systems belongs to the line break.
    return records.withColumn("record", F.regexp_replace("record", "\r\\z", "")).filter(strip(F.col("record")) != "")


def _header(spark: SparkSession, path: str, sep: str) -> list[str]:
    """Names of the columns, from the first record that Spark finds; it reads no further."""
    return spark.read.options(header=True, multiLine=True, sep=sep, **CSV_QUOTES).csv(path).columns


def _parsed(
    spark: SparkSession, path: str, schema: T.StructType | None, sep: str, header: bool
) -> tuple[DataFrame, list[str]]:
    """``path``, ``line``, ``record``, ``open`` and ``row``: the cells as texts, and what is malformed."""
    if not header and schema is None:
        raise ValueError("files without header need a schema")
    names = _header(spark, path, sep) if header else schema.fieldNames()
    cells = T.StructType([*(T.StructField(name, T.StringType()) for name in names), T.StructField(_CORRUPT, T.StringType())])
    records = csv_records(spark, path)
    if header:
        records = records.filter("line > 1")
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, **CSV_QUOTES}
    ddl = ", ".join(f"`{field.name.replace('`', '``')}` string" for field in cells)
    return records.withColumn("row", F.from_csv("record", F.lit(ddl), options)), names


def _cell(name: str) -> Column:
    return F.col("row").getField(name)


def read_csv_records(
    spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",", header: bool = True
) -> DataFrame:
    """The table that ``read_csv(..., multiLine=True)`` gives, with a file read by many tasks.

    Without ``header`` the columns are those of ``schema``, in order. Missing cells are NULL.
    """
    parsed, names = _parsed(spark, path, schema, sep, header)
    table = parsed.select(*[_cell(name).alias(name) for name in names])
    return table if schema is None else with_types(table, schema)


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The good rows, typed like those of ``read_csv``, and a table of the others.

    Columns of the second table: ``path``, ``line`` (where the record starts, from 1), ``reason`` and
    ``record``. Reasons: ``unclosed quote``, ``cells`` (too few or too many), and ``type: a, b`` (cells
    of columns ``a`` and ``b`` hold text that is no value of their type). Every record is in one of
    the two tables. Each table reads the files when it is used.
    """
    parsed, names = _parsed(spark, path, schema, sep, header)
    missing = [name for name in schema.fieldNames() if name not in names]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    typed = [f for f in schema if not isinstance(f.dataType, T.StringType)]
    wrong = F.array_compact(F.array(F.lit(None).cast("string"), *[
        F.when(_cell(f.name).isNotNull() & _cell(f.name).try_cast(f.dataType).isNull(), F.lit(f.name)) for f in typed
    ]))
    reason = (
        F.when(F.col("open"), F.lit("unclosed quote"))
        .when(_cell(_CORRUPT).isNotNull(), F.lit("cells"))
        .when(F.size(wrong) > 0, F.concat(F.lit("type: "), F.array_join(wrong, ", ")))
    )
    judged = parsed.withColumn("reason", reason)
    good = judged.filter("reason IS NULL").select(*[_cell(name).alias(name) for name in names])
    bad = judged.filter("reason IS NOT NULL").select("path", "line", "reason", "record")
    return with_types(good, schema), bad
