import pytest
from conftest import rows

from starmart import LabelRule, Lookup, decode, drop_columns, drop_invalid_labels
from starmart.functions.text import city_of, joined_key, month_of, year_of
from starmart.operators.labels import last_wins


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(
        [
            (1, "NYC", 582.0, "x"),
            (2, "LAX", 101.0, "x"),
            (3, "???", 999.0, "x"),
            (4, None, None, "x"),
            (5, "NYC", 0.0, "x"),
        ],
        "id int, port string, country double, other string",
    )


@pytest.fixture
def ports(spark):
    return spark.createDataFrame(
        [("NYC", "NEW YORK, NY  ", 1), ("LAX", "old", 2), ("LAX", "LOS ANGELES, CA", 3)],
        "code string, label string, line_no int",
    )


@pytest.fixture
def countries(spark):
    return spark.createDataFrame(
        [("582 ", "MEXICO"), (" 101", "ALBANIA"), ("0  ", "STATELESS"), ("bad", "NOWHERE")],
        "code string, label string",
    )


@pytest.mark.parametrize("limit", [32 * 1024 * 1024, 0])
def test_decode(spark, fact, ports, countries, limit):
    decoded = decode(
        fact,
        [
            Lookup(ports, "port", "code", {"label": "port_label"}, order="line_no"),
            Lookup(countries, "country", "code", {"label": "country_label"}, numeric=True),
        ],
        broadcast_bytes=limit,
    )
    assert decoded.columns == [*fact.columns, "port_label", "country_label"]
    assert decoded.schema["country"].dataType == fact.schema["country"].dataType
    assert rows(decoded) == [
        (1, "NYC", 582.0, "x", "NEW YORK, NY  ", "MEXICO"),
        (2, "LAX", 101.0, "x", "LOS ANGELES, CA", "ALBANIA"),
        (3, "???", 999.0, "x", None, None),
        (4, None, None, "x", None, None),
        (5, "NYC", 0.0, "x", "NEW YORK, NY  ", "STATELESS"),
    ]


def test_row_count_is_kept_for_repeated_codes(spark, fact, countries):
    twice = countries.unionAll(countries)
    lookup = Lookup(twice, "country", "code", {"label": "c"}, numeric=True)
    assert decode(fact, [lookup]).count() == fact.count()


def test_small_lookups_do_not_shuffle_the_fact(spark, ports):
    fact = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    lookup = Lookup(ports, "o_orderstatus", "code", {"label": "status"}, unique=True)
    plan = decode(fact, [lookup])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


def test_large_lookup_is_not_broadcast_by_hint(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    customer = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    lookup = Lookup(customer, "o_custkey", "c_custkey", {"c_name": "name"}, unique=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        decoded = decode(orders, [lookup], broadcast_bytes=0)
        plan = decoded._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        expected = orders.join(
            customer, orders.o_custkey == customer.c_custkey, "left"
        ).select(*orders.columns, customer.c_name.alias("name"))
        assert rows(decoded) == rows(expected)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_outer_join_becomes_inner_under_required_labels(spark, ports):
    fact = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    lookup = Lookup(ports, "o_orderstatus", "code", {"label": "status"}, unique=True)
    valid = drop_invalid_labels(decode(fact, [lookup]), [LabelRule("status", ("No",))])
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert "Inner, BuildRight" in plan


def test_label_rules(spark):
    df = spark.createDataFrame(
        [("NEW YORK",), ("No PORT Code (X)",), ("Collapsed (Y)",), ("collapsed",), (None,)],
        "Port string",
    )
    rule = LabelRule("Port", ("No PORT Code", "Collapsed"))
    assert rows(drop_invalid_labels(df, [rule])) == [("NEW YORK",), ("collapsed",)]
    assert drop_invalid_labels(df, [LabelRule("Port", required=False)]).count() == 5
    assert drop_invalid_labels(df, [LabelRule("Port", ("zz",), required=False)]).count() == 4
    assert drop_invalid_labels(df, [LabelRule("Port")]).count() == 4
    assert drop_invalid_labels(df, []).count() == 5


def test_drop_columns_ignores_absent_names(spark, fact):
    assert drop_columns(fact, ["other", "absent"]).columns == ["id", "port", "country"]


def test_city_of(spark):
    labels = ["  NEW YORK, NY   ", "WASHINGTON DC  ", "O'HARE-X, IL", "A, B, C", "", None, "\tX, Y"]
    df = spark.createDataFrame([(label,) for label in labels], "p string")
    found = [row[0] for row in df.select(city_of("p")).collect()]
    assert found == ["New York", "Washington Dc", "O'hare-x", "A", "", None, "\tx"]


def test_joined_key(spark):
    df = spark.createDataFrame([("NY", "Troy"), (None, "Troy")], "s string, c string")
    assert [r[0] for r in df.select(joined_key("s", "c")).collect()] == ["NY_Troy", None]


def test_year_and_month_of_text(spark):
    df = spark.createDataFrame([("2013-09-01",), ("nonsense",), (None,)], "dt string")
    assert [tuple(r) for r in df.select(year_of("dt"), month_of("dt")).collect()] == [
        (2013, 9),
        (None, None),
        (None, None),
    ]


def test_last_wins(spark):
    df = spark.createDataFrame(
        [("a", "old", 1), ("a", "new", 5), ("b", "only", 2)], "code string, label string, n int"
    )
    assert rows(last_wins(df, ["code"], "label", "n")) == [("a", "new"), ("b", "only")]
