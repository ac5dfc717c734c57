"""Airports that can be joined: those with an IATA code, without the continent."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.clean import drop_columns
from starmart.operators.quality import write_gated
from starmart.schemas import AIRPORTS
from starmart.sources.readers import read_csv
from starmart.sources.writers import write_csv


def airports(raw: DataFrame) -> DataFrame:
    return drop_columns(raw.filter(F.col("iata_code").isNotNull()), ["continent"])


def run(spark: SparkSession, source: str, out: str) -> int:
    result = airports(read_csv(spark, source, AIRPORTS))
    return write_gated(result, "airports", out, write_csv)
