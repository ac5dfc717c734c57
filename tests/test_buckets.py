"""Dimensions in buckets: the result of a full run, and only changed buckets written."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starmart.operators.buckets import merge_buckets, read_buckets
from starmart.sources import files


@pytest.fixture
def dimension(spark):
    return spark.range(500).select(
        F.when(F.col("id") > 0, F.col("id")).alias("k"),
        F.concat(F.lit("n"), "id").alias("name"),
        F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("x"),
        F.create_map(F.lit("a"), "id").alias("tags"),
    )


def _times(path):
    return {p.name: max(f.stat().st_mtime_ns for f in p.iterdir()) for p in path.iterdir()}


def test_second_run_writes_changed_buckets_only(spark, dimension, tmp_path):
    path = tmp_path / "d"
    assert merge_buckets(dimension, str(path), ["k"], buckets=16) == list(range(16))
    before = _times(path)
    assert merge_buckets(dimension.orderBy("x"), str(path), ["k"], complete=True, buckets=16) == []
    assert _times(path) == before
    later = dimension.withColumn("name", F.when(F.col("k") == 7, "seven").otherwise(F.col("name")))
    changed = merge_buckets(later, str(path), ["k"], complete=True, buckets=16)
    assert len(changed) == 1
    after = _times(path)
    assert [name for name in after if after[name] != before[name]] == [f"b{changed[0]}of16"]
    assert rows(read_buckets(spark, str(path))) == rows(later)


def test_rows_take_the_place_of_their_keys(spark, dimension, tmp_path):
    path = str(tmp_path / "d")
    merge_buckets(dimension, path, ["k"], buckets=8)
    change = spark.createDataFrame(
        [(None, "null key", 1.0, None), (3, "three", None, {"b": 1}), (900, "new", 2.0, {})],
        "k long, name string, x double, tags map<string,long>",
    )
    merge_buckets(change, path, ["k"], buckets=8)
    kept = dimension.filter("k IS NOT NULL AND k <> 3")
    assert rows(read_buckets(spark, path)) == rows(kept.unionByName(change))
    # Keys that go, the last ones of a bucket included.
    few = change.filter("k = 900")
    merge_buckets(few, path, ["k"], complete=True, buckets=8)
    assert rows(read_buckets(spark, path)) == rows(few)


def test_repeated_rows_are_counted(spark, dimension, tmp_path):
    path = str(tmp_path / "d")
    one = dimension.filter("k = 5")
    merge_buckets(one, path, ["k"])
    twice = one.unionAll(one)
    assert len(merge_buckets(twice, path, ["k"])) == 1
    assert read_buckets(spark, path).count() == 2


def test_lost_commit_and_wrong_calls(spark, dimension, tmp_path):
    path = str(tmp_path / "d")
    merge_buckets(dimension, path, ["k"], buckets=4)
    files.move(spark, f"{path}/b2of4", f"{path}/_b2of4.previous")
    assert rows(read_buckets(spark, path)) == rows(dimension)
    with pytest.raises(ValueError, match="4 buckets"):
        merge_buckets(dimension, path, ["k"], buckets=5)
    with pytest.raises(ValueError, match="other columns"):
        merge_buckets(dimension.drop("x"), path, ["k"], buckets=4)
    with pytest.raises(FileNotFoundError):
        read_buckets(spark, str(tmp_path / "none"))
    assert merge_buckets(dimension.filter("false"), path, ["k"], buckets=4) == []
    assert merge_buckets(dimension.filter("false"), path, ["k"], complete=True, buckets=4) == [0, 1, 2, 3]
