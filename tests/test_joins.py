import pytest
from conftest import rows
from pyspark.sql import functions as F

from starmart.operators.joins import (
    broadcast_join,
    fits_broadcast,
    hot_keys,
    measured_bytes,
    new_keys_only,
    skew_join,
)

HOWS = ("left", "inner", "left_semi", "left_anti")


@pytest.fixture
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _fact(spark, n=6000):
    """A third of the rows on one key, a third on NULL, the rest spread."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id") % 500)
    )
    return spark.range(0, n, numPartitions=16).select("id", key.cast("long").alias("k"))


def _dim(spark):
    return spark.range(0, 300).select(
        F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v")
    )


@pytest.mark.parametrize("how", HOWS)
def test_skew_join_equals_plain_join(spark, no_auto_broadcast, how):
    fact, dim = _fact(spark), _dim(spark)
    expected = fact.join(dim, "k", how)
    actual = skew_join(fact, dim, ["k"], how)
    assert set(actual.columns) == set(expected.columns)
    names = expected.columns
    assert rows(actual.select(names)) == rows(expected)


@pytest.mark.parametrize("how", HOWS)
def test_null_safe_and_several_keys(spark, no_auto_broadcast, how):
    fact = _fact(spark).withColumn("g", F.when(F.col("id") % 2 == 0, F.lit("a")))
    dim = (
        fact.filter(F.col("id") % 5 != 0)
        .groupBy("k", "g")
        .agg(F.count("id").alias("n"))
    )
    right = dim.withColumnsRenamed({"k": "k2", "g": "g2"})
    condition = F.col("k").eqNullSafe(F.col("k2")) & F.col("g").eqNullSafe(F.col("g2"))
    expected = fact.join(right, condition, how).drop("k2", "g2")
    actual = skew_join(fact, dim, ["k", "g"], how, null_safe=True)
    assert rows(actual.select(expected.columns)) == rows(expected)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_rows_are_spread(spark, no_auto_broadcast, adaptive):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = skew_join(_fact(spark), _dim(spark), ["k"], partitions=32)
        for condition in ("k = 7", "k is null"):
            per_task = joined.filter(condition).groupBy(F.spark_partition_id()).count()
            assert per_task.count() > 3, condition
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def _hash(spark, value):
    return spark.range(1).select(F.xxhash64(F.lit(value).cast("long"))).first()[0]


@pytest.mark.parametrize("partitions", [8, 200, 100_000])
def test_every_hot_key_is_found_and_gets_its_share(spark, partitions):
    found = hot_keys(_fact(spark, 60_000), F.xxhash64("k"), partitions)
    for key in (7, None):
        assert found[_hash(spark, key)] == pytest.approx(partitions / 3, rel=0.01, abs=1)
    # The 499 others hold 1/1500 of the rows each: hot only for very many partitions.
    assert len(found) == (2 if partitions < 3000 else 501)


def test_no_hot_keys_and_no_rows(spark, no_auto_broadcast):
    unique = spark.range(0, 5000).select(F.col("id").alias("k"))
    assert hot_keys(unique, F.xxhash64("k"), 8) == {}
    plain = skew_join(unique, _dim(spark), ["k"], "inner")
    assert plain.count() == 300
    assert "salt" not in plain._jdf.queryExecution().analyzed().toString()
    empty = unique.filter("k < 0")
    assert hot_keys(empty, F.xxhash64("k"), 8) == {}
    assert skew_join(empty, _dim(spark), ["k"]).count() == 0


def test_any_list_of_hot_keys_gives_the_same_rows(spark, no_auto_broadcast):
    fact, dim = _fact(spark), _dim(spark)
    other = spark.range(0, 50).select((F.col("id") * 0 + 11).alias("k"))
    expected = rows(fact.join(dim, "k", "left").select("id", "k", "v"))
    assert rows(skew_join(fact, dim, ["k"], probe=other).select("id", "k", "v")) == expected
    assert rows(skew_join(fact, dim, ["k"], partitions=5000).select("id", "k", "v")) == expected


@pytest.mark.parametrize("kinds", [("int", "long"), ("double", "int"), ("string", "int")])
def test_keys_of_different_types(spark, no_auto_broadcast, kinds):
    fact = _fact(spark).withColumn("k", F.col("k").cast(kinds[0]))
    dim = _dim(spark).withColumn("k", F.col("k").cast(kinds[1]))
    if kinds[0] == "double":
        fact = fact.withColumn("k", F.when(F.col("id") % 2 == 0, F.col("k") + 0.5).otherwise(F.col("k")))
    expected = fact.join(dim, fact.k == dim.k, "left").select(fact.id, fact.k, dim.v)
    for join in (skew_join, broadcast_join):
        joined = join(fact, dim, ["k"])
        assert joined.schema["k"].dataType == fact.schema["k"].dataType
        assert rows(joined.select("id", "k", "v")) == rows(expected)


def test_signed_zero_is_one_key(spark, no_auto_broadcast):
    zero = F.when(F.col("id") % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0))
    fact = spark.range(0, 1000, numPartitions=8).select(zero.alias("k"))
    dim = spark.createDataFrame([(0.0, "zero")], "k double, v string")
    assert skew_join(fact, dim, ["k"], "inner").count() == 1000


def test_broadcast_join_equals_plain_join(spark):
    fact, dim = _fact(spark), _dim(spark)
    for how in HOWS:
        expected = fact.join(dim, "k", how)
        assert rows(broadcast_join(fact, dim, ["k"], how).select(expected.columns)) == rows(expected)


def test_measured_bytes(spark):
    small = spark.createDataFrame([("a", 1), (None, 2)], "s string, n int")
    large = spark.range(10_000).select(F.repeat(F.lit("x"), 100).alias("s"))
    empty = small.filter("n > 5")
    nested = small.select(F.array("s", "s").alias("a"))
    sizes = measured_bytes([small, large, empty, nested])
    assert sizes[0] == 2 * (16 + 16) + 1
    assert sizes[1] == 10_000 * 116
    assert sizes[2] == 0
    assert sizes[3] > 32
    assert fits_broadcast([small, large], limit=1000) == [True, False]
    assert fits_broadcast([]) == []


def test_rejects_bad_arguments(spark):
    with pytest.raises(ValueError):
        skew_join(_fact(spark), _dim(spark), ["k"], "full")
    with pytest.raises(ValueError):
        skew_join(_fact(spark).withColumn("v", F.lit(1)), _dim(spark), ["k"])
    with pytest.raises(ValueError, match="both sides"):
        broadcast_join(_fact(spark).withColumn("V", F.lit(1)), _dim(spark), ["k"])


def test_new_keys_only(spark, no_auto_broadcast):
    fact, dim = _fact(spark), _dim(spark)
    expected = fact.join(dim, "k", "left_anti").select(fact.columns)
    assert rows(new_keys_only(fact, dim.unionAll(dim), ["k"])) == rows(expected)
