"""Sinks: parquet and CSV tables, code dictionaries, write-once tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A quote inside a quoted cell is doubled, as CSV has it elsewhere.
CSV_QUOTES = {"quote": '"', "escape": '"'}


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Parquet; with ``partition_by`` one folder per value, written by few tasks each.

    Rows are brought together by value first, values with many rows in several parts, so the number
    of files follows the data and not the number of tasks times the number of values.
    """
    if partition_by:
        df = df.hint("rebalance", *[f"`{name}`" for name in partition_by])
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", header: bool = True, sep: str = ","
) -> None:
    df.write.mode(mode).options(header=header, sep=sep, **CSV_QUOTES).csv(path)


def write_single_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """CSV as one file per call, for small exports: one file is one writing task.

    The plan before the write keeps its parallelism. ``write_csv`` is the sink for large results.
    """
    write_csv(df.repartition(1), path, mode)


def write_if_absent(df: DataFrame, path: str, format: str = "parquet", **options: str) -> None:
    """Write only when the target does not exist yet; an existing target is left as it is."""
    df.write.mode("ignore").format(format).options(**options).save(path)


def write_dictionary(dictionary: DataFrame, path: str, format: str = "parquet") -> None:
    """Code dictionary, one folder ``section=<name>`` per section.

    ``parquet`` keeps every column. ``json`` writes one object ``{code: label}`` per line, which
    ``read_code_map`` reads back.
    """
    if format == "parquet":
        dictionary.write.mode("overwrite").partitionBy("section").parquet(path)
    elif format == "json":
        pair = F.to_json(F.create_map("code", "label")).alias("value")
        dictionary.select("section", pair).write.mode("overwrite").partitionBy("section").text(path)
    else:
        raise ValueError(f"unknown dictionary format: {format}")
