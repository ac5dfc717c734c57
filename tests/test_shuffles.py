"""Plans of joins by shuffle: what is probed, pushed, turned and repeated."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

import starmart as sm
from catalog import queries as catalog
from starmart.operators import joins
from starmart.operators.pivot import attach_pivot, pivot_counts

SF = "/root/testdata/sf0.01"


def _plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", ["lookup_chain_shuffled", "lookup_hot_key", "star_enrichment_shuffled"])
def test_shuffled_queries_shuffle(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF))
    assert "Broadcast" not in plan and "SortMergeJoin" in plan and "hashpartitioning" in plan


def test_no_probe_holds_a_join(spark, monkeypatch):
    probed = []
    found = joins.hot_keys

    def watch(df, hashed, partitions):
        probed.append(_plan(df))
        return found(df, hashed, partitions)

    monkeypatch.setattr(joins, "hot_keys", watch)
    catalog.lookup_chain_shuffled(spark, SF)
    assert len(probed) == 4 and not any("Join" in plan for plan in probed)


def test_filters_pass_below_salts(spark):
    fact = catalog.table(spark, SF, "lineitem").withColumn(
        "code", F.when(F.col("l_linenumber") > 1, F.lit(1)).otherwise(F.col("l_partkey"))
    )
    part = sm.Lookup(
        catalog.table(spark, SF, "part"), "code", "p_partkey", {"p_name": "part"}, unique=True
    )
    decoded = sm.decode(fact, [part], broadcast_bytes=0)
    salted = decoded.filter(F.col("part").isNotNull() & (F.col("l_quantity") > 40))
    plan = _plan(salted)
    assert "__salt" in plan and "GreaterThan(l_quantity,40.0)" in plan
    assert "Inner" in plan and "LeftOuter" not in plan
    plain = fact.filter("l_quantity > 40").join(part.table, F.col("code") == F.col("p_partkey"))
    assert salted.count() == plain.count()


def test_rules_make_all_joins_of_the_chain_inner(spark):
    for query in (catalog.lookup_chain, catalog.lookup_chain_shuffled):
        plan = _plan(query(spark, SF))
        assert "LeftOuter" not in plan


def test_rows_without_other_columns_are_dealt(spark):
    fact = spark.range(4000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("k"))
    known = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    assert joins.skew_join(fact, known, ["k"]).filter("v IS NOT NULL").count() == 3000


def test_one_limit_for_all_tables():
    assert joins.within_limit([20, 5, 10, 1], 16) == [False, True, True, True]
    assert joins.within_limit([], 10) == []


def test_whole_numbers_are_compared_to_the_last_digit(spark):
    large = 9_007_199_254_740_992
    codes = spark.createDataFrame([(str(large), "even"), ("582 ", "x")], "code string, label string")
    facts = spark.createDataFrame([(large,), (large + 1,), (582,)], "c long")
    lookup = sm.Lookup(codes, "c", "code", {"label": "name"}, numeric=True)
    assert rows(sm.decode(facts, [lookup])) == [(582, "x"), (large, "even"), (large + 1, None)]


def test_dictionaries_of_dictionaries_keep_rows_and_order(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3), (None, 4)], "x string, n int")
    one = spark.createDataFrame([("a", "10 "), ("b", None)], "code string, next string")
    two = spark.createDataFrame([(10, "ten", "k")], "code int, label string, more string")
    three = spark.createDataFrame([("k", "deep")], "code string, label string")
    chain = [
        sm.Lookup(one, "x", "code", {"next": "second"}),
        sm.Lookup(two, "second", "code", {"label": "name", "more": "third"}, numeric=True),
        sm.Lookup(three, "third", "code", {"label": "last"}),
    ]
    wanted = [("a", 1, "10 ", "ten", "k", "deep"), ("b", 2, None, None, None, None)]
    wanted += [("z", 3, None, None, None, None), (None, 4, None, None, None, None)]
    for limit in (sm.BROADCAST_BYTES, 0):
        found = sm.decode(fact, chain, limit)
        assert found.columns == ["x", "n", "second", "name", "third", "last"]
        assert rows(found) == sorted(wanted, key=repr)


def test_large_dimensions_of_one_key_are_joined_first(spark):
    fact = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r")], "k int, v string")
    left = spark.createDataFrame([(1, "a"), (9, "b")], "id int, x string")
    right = spark.createDataFrame([(1, "c"), (2, "d")], "id int, y string")
    dims = [sm.Dimension(left, {"k": "id"}, {"x": "x"}), sm.Dimension(right, {"k": "id"}, {"y": "y"})]
    for limit in (sm.BROADCAST_BYTES, 0):
        assert rows(sm.enrich(fact, dims, limit)) == [
            (1, "p", "a", "c"), (2, "q", None, "d"), (3, "r", None, None)
        ]


def test_small_totals_need_no_probe(spark, monkeypatch):
    monkeypatch.setattr(joins, "hot_keys", lambda *_: pytest.fail("probed"))
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 3)], "k int, c string, n int")
    assert rows(attach_pivot(df, ["k"], "c", "n")) == [(1, 2, 3)]
    known = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(sm.new_keys_only(spark.range(3).selectExpr("cast(id as int) k"), known, ["k"])) == [(0,), (2,)]


def test_large_new_keys_are_joined_by_shuffle(spark):
    known = spark.range(5).selectExpr("id % 3 AS k")
    assert rows(sm.new_keys_only(spark.range(6).withColumnRenamed("id", "k"), known, ["k"], 0)) == [(3,), (4,), (5,)]


def test_pivot_cells_are_exact_and_wide(spark):
    large = 2**53 + 1
    df = spark.createDataFrame([(1, "a", large), (1, "a", 2**40), (1, "b.c", 3)], "`k.x` int, c string, n long")
    assert rows(pivot_counts(df, ["k.x"], "c", "n")) == [(1, large + 2**40, 3)]
    with pytest.raises(ValueError, match="more than 1 values"):
        pivot_counts(df, ["k.x"], "c", "n", max_categories=1)


def test_label_rules_take_dotted_names(spark):
    df = spark.createDataFrame([("x",), (None,)], "`a.b` string")
    assert rows(sm.drop_invalid_labels(df, [sm.LabelRule("a.b", ("y",))])) == [("x",)]
