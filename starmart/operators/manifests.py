"""Manifests: what an output held when it was written, and a check of its content against it.

A manifest has a row for each file of an output: ``file`` below the output's folder, its ``rows``, and
``hash``, the sum of a hash of every row, which does not depend on their order. It lies in the folder
``_manifest`` of the output, which readers pass over, and moves with it.
"""

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.sources import files

MANIFEST = "_manifest"
_SCHEMA = "file string, rows long, hash string"
_LISTED = 20


def row_hash(df: DataFrame) -> Column:
    """64 bits of a row: all its columns, and which of them are NULL. A map's order does not count."""
    columns, flags = [], []
    for field in df.schema.fields:
        column = F.col("`" + field.name.replace("`", "``") + "`")
        flags.append(column.isNull())
        columns.append(F.sort_array(F.map_entries(column)) if isinstance(field.dataType, T.MapType) else column)
    # A hash of several columns passes over NULLs, so their places are hashed as well.
    return F.xxhash64(F.array(*flags), *columns)


def measure(
    spark: SparkSession, path: str, format: str = "parquet", options: Mapping[str, str] | None = None
) -> DataFrame:
    """The manifest of an output as it is now: one scan, one row for each file with rows."""
    reader = spark.read.format(format).options(header=True).options(**(options or {}))
    df = reader.load(path)
    root = files.url_path(spark, path)
    # The path of a file without scheme and host, below the folder of the output.
    file = F.regexp_replace("_metadata.file_path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    file = F.substring(file, F.lit(len(root) + 2), F.length(file))
    return (
        df.select(file.alias("file"), row_hash(df).cast("decimal(20,0)").alias("hash"))
        .groupBy("file")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("hash").cast("string").alias("hash"))
    )


def write_manifest(
    spark: SparkSession, path: str, format: str = "parquet", options: Mapping[str, str] | None = None
) -> None:
    """Write the manifest of an output beside its files; it is read back from them once."""
    measure(spark, path, format, options).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{MANIFEST}")


def sealed(
    write: Callable[[DataFrame, str], None], format: str = "parquet", options: Mapping[str, str] | None = None
) -> Callable[[DataFrame, str], None]:
    """A sink that also writes the manifest, for ``write_gated``: both appear in one rename."""

    def run(df: DataFrame, path: str) -> None:
        write(df, path)
        write_manifest(df.sparkSession, path, format, options)

    return run


def content_report(
    spark: SparkSession, path: str, format: str = "parquet", options: Mapping[str, str] | None = None
) -> DataFrame:
    """One row for each file: ``file``, ``status``, ``rows``.

    ``status`` is ``same``, ``changed`` (other rows than in the manifest), ``added`` or ``missing``;
    ``rows`` are those found, of a missing file those expected. An output without a manifest, or
    without files, is an error of the reader.
    """
    listed = spark.read.schema(_SCHEMA).parquet(f"{path.rstrip('/')}/{MANIFEST}").alias("m")
    found = measure(spark, path, format, options).alias("f")
    same = (F.col("m.rows") == F.col("f.rows")) & (F.col("m.hash") == F.col("f.hash"))
    status = (
        F.when(F.col("m.file").isNull(), "added")
        .when(F.col("f.file").isNull(), "missing")
        .when(same, "same")
        .otherwise("changed")
    )
    both = listed.join(found, F.col("m.file") == F.col("f.file"), "full")
    return both.select(
        F.coalesce("m.file", "f.file").alias("file"),
        status.alias("status"),
        F.coalesce("f.rows", "m.rows").alias("rows"),
    )


def require_contents(spark: SparkSession, outputs: Mapping[str, tuple]) -> DataFrame:
    """Files by output and status, as ``files`` and ``rows``; raises where one differs.

    ``outputs`` maps a name to its format and path, and to reader options if there are any.
    """
    reports = [
        content_report(spark, path, format, *options).select(F.lit(name).alias("output"), "file", "status", "rows")
        for name, (format, path, *options) in outputs.items()
    ]
    report = reduce(DataFrame.unionAll, reports)
    wrong = report.filter("status <> 'same'").orderBy("output", "file").limit(_LISTED + 1).collect()
    if wrong:
        named = ", ".join(f"{row.output}/{row.file} {row.status}" for row in wrong[:_LISTED])
        raise AssertionError(f"outputs differ from their manifests: {named}{', ...' * (len(wrong) > _LISTED)}")
    return report.groupBy("output", "status").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
