"""Mean temperature per city over the latest years."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.quality import write_gated
from starmart.operators.trailing import mean_by, within_latest_years
from starmart.schemas import WEATHER
from starmart.sources.readers import read_csv
from starmart.sources.writers import write_csv

# Fixed values.
YEARS = 10
COUNTRY = "United States"
LOCATION = ("City", "Country", "Latitude", "Longitude")
MEANS = {
    "AverageTemperature": "City_AverageTemperature",
    "AverageTemperatureUncertainty": "City_AverageTemperatureUncertainty",
}


def weather(
    raw: DataFrame, years: int = YEARS, country: str = COUNTRY, dedupe: str = "none"
) -> DataFrame:
    """The years end with the latest one of the whole input, whatever its country.

    ``dedupe="latest"`` averages the latest reading of each location instead of all readings.
    """
    recent = within_latest_years(raw, "dt", years).filter(
        (F.col("Country") == country) & F.col("AverageTemperature").isNotNull()
    )
    return mean_by(recent, ["City"], MEANS, dedupe, location=LOCATION, order=["dt"])


def run(
    spark: SparkSession,
    source: str,
    out: str,
    years: int = YEARS,
    country: str = COUNTRY,
    dedupe: str = "none",
    header: bool = True,
) -> int:
    result = weather(read_csv(spark, source, WEATHER), years, country, dedupe)
    return write_gated(result, "weather", out, lambda df, path: write_csv(df, path, header=header))
