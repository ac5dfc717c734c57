"""Stored monthly sums: the same means as from all rows, and only what changed is read and written."""

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

import starmart as sm
from starmart.operators.states import state_years
from starmart.sources import files

KEYS, MEANS = ["city", "country"], {"t": "mean_t", "sums": "mean_u"}


@pytest.fixture
def readings(spark):
    made = spark.range(4000).select(
        F.expr("make_date(2003 + cast(id % 13 as int), 1 + cast(id % 11 as int), 1 + cast(id % 27 as int))").alias("month"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("c"), (F.col("id") % 5).cast("string"))).alias("city"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("country"),
        F.when(F.col("id") % 7 == 0, "no number").otherwise((F.col("id") % 17).cast("string")).alias("t"),
        F.when(F.col("id") % 5 != 2, F.col("id") % 4).alias("sums"),
    )
    return sm.materialize(made, "readings")


def _expected(df, years):
    return rows(sm.mean_by(sm.within_latest_years(df, "month", years), KEYS, MEANS))


def _found(spark, path, years):
    return rows(sm.mean_of_states(spark, path, KEYS, MEANS, years))


def _written(path):
    return {p.name: max(f.stat().st_mtime_ns for f in p.iterdir()) for p in path.iterdir()}


def test_months_added_one_by_one(spark, readings, tmp_path):
    path, last = str(tmp_path / "states"), datetime.date(2015, 1, 1)
    sm.add_months(readings.filter(F.col("month") < last), path, KEYS, "month", list(MEANS))
    for number in range(1, 12):
        month = readings.filter((F.year("month") == 2015) & (F.month("month") == number))
        written = sm.add_months(month, path, KEYS, "month", list(MEANS))
        assert written == ([2015] if month.count() else [])
    for years in (1, 3, 10, 50):
        assert _found(spark, path, years) == _expected(readings, years)
    with pytest.raises(ValueError):
        sm.mean_of_states(spark, path, KEYS, MEANS, 0)


def test_a_month_rewrites_its_year_only(spark, readings, tmp_path):
    path = tmp_path / "states"
    sm.add_months(readings, str(path), KEYS, "month", list(MEANS))
    before = _written(path)
    assert sorted(before) == [f"y{year}" for year in range(2003, 2016)]
    march = readings.filter((F.year("month") == 2010) & (F.month("month") == 3))
    changed = march.withColumn("t", F.lit("5"))
    assert march.count() and sm.add_months(changed, str(path), KEYS, "month", list(MEANS)) == [2010]
    after = _written(path)
    assert [name for name in after if after[name] != before[name]] == ["y2010"]
    rest = readings.exceptAll(march) if march.count() else readings
    assert _found(spark, str(path), 9) == _expected(rest.unionByName(changed), 9)


def test_only_the_window_is_read(spark, readings, tmp_path):
    path = str(tmp_path / "states")
    sm.add_months(readings, path, KEYS, "month", list(MEANS))
    read = sm.mean_of_states(spark, path, KEYS, MEANS, 3).inputFiles()
    assert {file.split("/")[-2] for file in read} == {"y2013", "y2014", "y2015"}


def test_a_lost_commit_is_undone(spark, readings, tmp_path):
    path = str(tmp_path / "states")
    sm.add_months(readings, path, KEYS, "month", list(MEANS))
    files.move(spark, f"{path}/y2014", f"{path}/_y2014.previous")
    assert _found(spark, path, 4) == _expected(readings, 4)
    assert state_years(spark, path)[-2:] == [2014, 2015]


def test_no_rows_and_no_dates(spark, readings, tmp_path):
    path = str(tmp_path / "states")
    nothing = readings.withColumn("month", F.lit("no date"))
    assert sm.add_months(nothing, path, KEYS, "month", list(MEANS)) == []
    with pytest.raises(FileNotFoundError):
        sm.mean_of_states(spark, path, KEYS, MEANS)
