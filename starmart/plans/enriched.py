"""Arrivals with the demographics and weather of their city and the airport of their port."""

from pyspark.sql import DataFrame, SparkSession

from starmart.operators.enrich import Dimension, enrich
from starmart.operators.quality import write_gated
from starmart.schemas import AIRPORTS_OUT, WEATHER_OUT, demographics_out
from starmart.sources.readers import read_csv, read_csv_by_position, read_parquet, with_types
from starmart.sources.writers import write_parquet


def enriched(
    arrivals: DataFrame, demographics: DataFrame, weather: DataFrame, airports: DataFrame
) -> DataFrame:
    """A city found in several states takes the row with the largest population."""

    def others(df: DataFrame, key: str, prefix: str = "") -> dict[str, str]:
        return {name: prefix + name for name in df.columns if name != key}

    return enrich(
        arrivals,
        [
            Dimension(
                demographics,
                {"City": "City"},
                others(demographics, "City"),
                prefer=["Total Population"],
            ),
            Dimension(weather, {"City": "City"}, others(weather, "City")),
            Dimension(airports, {"i94port": "iata_code"}, others(airports, "iata_code", "airport_")),
        ],
    )


def run(
    spark: SparkSession,
    arrivals: str,
    demographics: str,
    weather: str,
    airports: str,
    out: str,
    weather_header: bool = True,
) -> int:
    """``weather_header=False`` reads a weather table without header by its declared columns."""
    if weather_header:
        readings = read_csv(spark, weather, WEATHER_OUT)
    else:
        readings = read_csv_by_position(spark, weather, WEATHER_OUT)
    people = read_csv(spark, demographics)
    result = enriched(
        read_parquet(spark, arrivals),
        with_types(people, demographics_out(people.columns)),
        readings,
        read_csv(spark, airports, AIRPORTS_OUT),
    )
    return write_gated(result, "enriched", out, write_parquet)
