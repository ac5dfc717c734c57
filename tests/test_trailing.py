import pytest
from conftest import rows
from pyspark.sql import functions as F

from starmart import latest_per_key, latest_year, mean_by, within_latest_years
from starmart.plans.weather import weather

READINGS = [
    # dt, temperature, uncertainty, city, country, latitude, longitude
    ("2013-09-01", "20.0", "0.5", "Berlin", "Germany", "52N", "13E"),
    ("2012-01-01", "10.0", "0.2", "Troy", "United States", "42N", "73W"),
    ("2012-02-01", "14.0", "0.4", "Troy", "United States", "42N", "73W"),
    ("2011-05-01", "30.0", None, "Troy", "United States", "42N", "83W"),
    ("2010-05-01", None, "0.9", "Troy", "United States", "42N", "73W"),
    ("2003-12-31", "99.0", "9.0", "Troy", "United States", "42N", "73W"),
    ("2004-01-01", "1.0", "0.1", "Old", "United States", "1N", "1W"),
    ("bad date", "50.0", "5.0", "Troy", "United States", "42N", "73W"),
]


@pytest.fixture
def readings(spark):
    return spark.createDataFrame(
        READINGS,
        "dt string, AverageTemperature string, AverageTemperatureUncertainty string, City string,"
        " Country string, Latitude string, Longitude string",
    )


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz"])
def test_within_latest_years(readings, kind):
    df = readings.withColumn("dt", F.col("dt").try_cast(kind))
    found = within_latest_years(df, "dt", 10).select(F.year(F.col("dt").cast("date")).alias("y"))
    assert sorted({row.y for row in found.collect()}) == [2004, 2010, 2011, 2012, 2013]
    assert within_latest_years(df, "dt", 1).count() == 1
    with pytest.raises(ValueError):
        within_latest_years(df, "dt", 0)


def test_no_dates_gives_no_rows(readings):
    assert within_latest_years(readings.filter("dt = 'bad date'"), "dt").count() == 0


def test_first_day_reaches_the_scan(spark):
    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = within_latest_years(lineitem, "l_shipdate", 3)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "GreaterThanOrEqual(l_shipdate,ScalarSubquery" in text
    assert "Join" not in text


def test_latest_year(readings):
    assert rows(latest_year(readings, "dt")) == [(2013, 1)]


def test_weather_true_mean(readings):
    assert rows(weather(readings)) == [("Old", 1.0, 0.1), ("Troy", 18.0, pytest.approx(0.3))]


def test_weather_latest_reading_per_location(readings):
    # Troy has two locations: 14.0 (the later of two) and 30.0.
    assert rows(weather(readings, dedupe="latest")) == [("Old", 1.0, 0.1), ("Troy", 22.0, 0.4)]


def test_weather_options(readings):
    assert rows(weather(readings, years=2, country="Germany")) == [("Berlin", 20.0, 0.5)]
    assert weather(readings, country="Nowhere").count() == 0


def test_latest_per_key_is_stable(spark):
    df = spark.range(0, 10_000, numPartitions=8).select(
        (F.col("id") % 7).alias("k"), (F.col("id") % 100).alias("o"), F.col("id").alias("v")
    )
    first = rows(latest_per_key(df, ["k"], ["o"]))
    assert first == rows(latest_per_key(df.repartition(3), ["k"], ["o"]))
    assert all(o == 99 for _, o, _ in first) and len(first) == 7


def test_mean_by_rejects_unknown_dedupe(readings):
    with pytest.raises(ValueError):
        mean_by(readings, ["City"], {"AverageTemperature": "m"}, "first")


def test_rows_with_maps(spark):
    data = [
        (1, 5, {"b": 2, "a": 1}, [{"x": 1}]),
        (1, 5, {"a": 1, "b": 3}, [{"x": 2}]),
        (1, 4, {"z": 9}, None),
        (None, 1, None, None),
    ]
    df = spark.createDataFrame(data, "k int, o int, m map<string,int>, n array<map<string,int>>")
    for order in (df, df.orderBy(F.col("o"), F.col("n").isNull())):
        found = {row.k: row for row in latest_per_key(order, ["k"], ["o"]).collect()}
        assert found[1].m == {"a": 1, "b": 3} and found[1].n == [{"x": 2}] and found[1].o == 5
        assert found[None].m is None and found[None].o == 1
