"""Sources: CSV, parquet, whole text documents and JSON code maps."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.sources.writers import CSV_QUOTES


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sep: str = ",",
    **options: str,
) -> DataFrame:
    """CSV with a header line. Without ``schema`` every column is text.

    With ``schema`` the columns it names are converted by NAME, whatever their order in the
    file; text that does not convert becomes NULL. Other columns stay text. A doubled quote in a
    quoted cell is a quote. Cells with line breaks need ``multiLine=True``, and such a file is
    read by one task.
    """
    raw = spark.read.options(header=True, sep=sep, **{**CSV_QUOTES, **options}).csv(path)
    return raw if schema is None else with_types(raw, schema)


def read_csv_by_position(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", **options: str
) -> DataFrame:
    """CSV without a header line; its columns are those of ``schema``, in order."""
    return spark.read.schema(schema).options(sep=sep, **{**CSV_QUOTES, **options}).csv(path)


def with_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    missing = [name for name in schema.fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    casts = {
        field.name: F.col(f"`{field.name}`").try_cast(field.dataType)
        for field in schema
        if df.schema[field.name].dataType != field.dataType
    }
    return df.withColumns(casts) if casts else df


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet files by folder or glob; a declared schema saves the footer read at planning."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per text file: ``path``, ``value`` (the whole text)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), "value"
    )


def code_map_rows(
    df: DataFrame, json: str, code: str = "code", label: str = "label", order: str | None = None
) -> DataFrame:
    """Explode a column of JSON objects ``{code: label}`` into rows, other columns kept.

    Text that is no such object is an error; NULL and blank text has no codes. ``order`` adds the
    place of the code in its object, from which the last of a repeated code can be told.
    """
    kept = [F.col(f"`{name}`") for name in df.columns if name != json]
    some = df.filter(F.col(f"`{json}`").rlike(r"\S"))
    parsed = F.from_json(F.col(f"`{json}`"), "map<string,string>", {"mode": "FAILFAST"})
    rows = some.select(*kept, F.posexplode(parsed).alias("__place", code, label))
    return rows.withColumnRenamed("__place", order) if order else rows.drop("__place")


def read_code_map(
    spark: SparkSession,
    path: str,
    code: str = "code",
    label: str = "label",
    multi_line: bool = False,
    order: str | None = None,
) -> DataFrame:
    """Code dictionary from JSON objects ``{code: label}``, one or more per file.

    Each line is one object, holding any number of codes; ``multi_line`` takes each file as one
    object instead. Anything else is an error. ``order`` adds a number that grows along each file.
    A folder written by ``write_dictionary`` also gives its ``section`` column.
    """
    if not order:
        return code_map_rows(spark.read.text(path, wholetext=multi_line), "value", code, label)
    files = spark.read.text(path, wholetext=True)
    others = [F.col(f"`{name}`") for name in files.columns if name != "value"]
    lines = F.array("value") if multi_line else F.split("value", "\n")
    numbered = files.select(*others, F.posexplode(lines).alias("__line", "value"))
    rows = code_map_rows(numbered, "value", code, label, order=order)
    return rows.withColumn(order, F.col("__line") * (1 << 31) + F.col(f"`{order}`")).drop("__line")


def read_code_maps(
    spark: SparkSession, paths: dict[str, str], multi_line: bool = False
) -> DataFrame:
    """One dictionary ``section, code, label, line_no`` from a JSON code map per section."""
    tables = [
        read_code_map(spark, path, multi_line=multi_line, order="line_no").select(
            F.lit(section).alias("section"), "code", "label", "line_no"
        )
        for section, path in paths.items()
    ]
    return reduce(DataFrame.unionAll, tables)
