"""One query per operator, each over whole tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import starmart as sm
from starmart.functions.text import month_of, year_of
from starmart.operators.quality import write_gated
from starmart.sources.readers import code_map_rows

# Kept as a label document: it is parsed like any other.
STATUS_LABELS = """/* order status, P is left out on purpose */
value $status
   'F' = 'Filled / shipped'
   'O' = 'Open'
   'O' = 'Open order' ;
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


# Lookups


def lookup_string_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    document = spark.createDataFrame([("status", STATUS_LABELS)], "path string, value string")
    status = sm.label_dictionary(document).filter(F.col("section") == "status")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sm.decode(
        orders,
        [sm.Lookup(status, "o_orderstatus", "code", {"label": "status"}, order="line_no")],
    )


def _text_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.col("n_nationkey").cast("string"), F.lit(" "))
    return table(spark, sf_dir, "nation").withColumn("n_nationkey", key)


def lookup_numeric_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _text_nation(spark, sf_dir)
    return sm.decode(
        customer,
        [sm.Lookup(nation, "c_nationkey", "n_nationkey", {"n_name": "nation"}, numeric=True)],
    )


def lookup_number_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes written in many forms, among them some that only rounding would make equal."""
    key = F.col("p_partkey")
    text, small = key.cast("string"), F.lit("0." + "0" * 12)
    form = F.pmod(key, F.lit(8))
    code = (
        F.when(form == 0, F.concat(F.lit(" 000"), text, F.lit(".000 ")))
        .when(form == 1, F.concat(text, F.lit("e0")))
        .when(form == 2, F.concat(text, F.lit("00E-2")))
        .when(form == 3, F.concat(F.lit("+"), text))
        .when(form == 4, F.concat(text, F.lit(".00000000001")))
        .when(form == 5, F.concat(F.lit("1"), F.lpad(text, 35, "0"), F.lit("0000")))
        .when(form == 6, F.concat(small, text, F.lit("e12")))
        .otherwise(F.concat(F.lit("no. "), text))
    )
    part = table(spark, sf_dir, "part")
    # The dictionary: whole numbers, then numbers of 40 digits, then numbers below 1.
    codes = part.select(text.alias("code"), F.concat(F.lit("whole "), "p_name").alias("label"))
    long = part.select(
        F.concat(F.lit("1"), F.lpad(text, 35, "0"), F.lit("e+4")).alias("code"), F.concat(F.lit("long "), "p_name").alias("label")
    )
    less = part.select(F.concat(F.lit("."), text).alias("code"), F.concat(F.lit("less "), "p_name").alias("label"))
    facts = part.select("p_partkey", code.alias("code"))
    # Several numbers below 1 are equal (.1 and .10): the largest label counts.
    lookup = sm.Lookup(codes.unionAll(long).unionAll(less), "code", "code", {"label": "part"}, numeric=True)
    return sm.decode(facts, [lookup])


CHAIN_RULES = (
    sm.LabelRule("priority", ("NOT SPECIFIED",)),
    sm.LabelRule("nation", ("NATION_1",)),
    sm.LabelRule("region", ("AFRICA", "Collapsed")),
    sm.LabelRule("segment"),
)


def lookup_chain(
    spark: SparkSession, sf_dir: str, broadcast_bytes: int = sm.BROADCAST_BYTES
) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    decoded = sm.decode(
        table(spark, sf_dir, "lineitem"),
        [
            sm.Lookup(
                orders,
                "l_orderkey",
                "o_orderkey",
                {"o_custkey": "custkey", "o_orderpriority": "priority"},
                unique=True,
            ),
            sm.Lookup(
                customer,
                "custkey",
                "c_custkey",
                {"c_nationkey": "nationkey", "c_mktsegment": "segment"},
                unique=True,
            ),
            sm.Lookup(
                _text_nation(spark, sf_dir),
                "nationkey",
                "n_nationkey",
                {"n_name": "nation", "n_regionkey": "regionkey"},
                numeric=True,
                unique=True,
            ),
            sm.Lookup(
                table(spark, sf_dir, "region"),
                "regionkey",
                "r_regionkey",
                {"r_name": "region"},
                unique=True,
            ),
        ],
        broadcast_bytes,
    )
    codes = ["custkey", "nationkey", "regionkey", "l_tax", "l_comment"]
    valid = sm.drop_invalid_labels(sm.drop_columns(decoded, codes), CHAIN_RULES)
    place = F.concat("region", F.lit(", "), "nation")
    return valid.withColumn("city", sm.city_of(place)).drop("region")


def lookup_chain_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain as it runs when no dictionary is small enough to be broadcast."""
    return lookup_chain(spark, sf_dir, broadcast_bytes=0)


def lookup_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One code on some two sevenths of the rows, NULL on one seventh, joined by shuffle."""
    line = F.col("l_linenumber")
    code = F.when(line <= 2, F.lit(0)).when(line > 3, F.col("l_partkey"))
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", code.cast("long").alias("partkey")
    )
    part = sm.Lookup(
        table(spark, sf_dir, "part"), "partkey", "p_partkey", {"p_name": "part"}, unique=True
    )
    return sm.decode(lineitem, [part], broadcast_bytes=0)


def lookup_required_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that need an entry in a dictionary too large to be broadcast: most go before the shuffle."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    small = table(spark, sf_dir, "part").filter("p_size <= 5")
    part = sm.Lookup(small, "l_partkey", "p_partkey", {"p_name": "part"}, unique=True, required=True)
    return sm.decode(lineitem, [part], broadcast_bytes=0)


def label_match_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = lookup_string_left(spark, sf_dir)
    return sm.match_shares(decoded, {"status": "status_share", "o_orderkey": "key_share"})


# Filters and projections


def _part_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("p_name") != "red widget", F.col("p_name"))
    return table(spark, sf_dir, "part").withColumn("p_name", name)


def invalid_label_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part_with_nulls(spark, sf_dir)
    return sm.drop_invalid_labels(part, [sm.LabelRule("p_name", ("blue", "anvil"))])


def _customer_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    return table(spark, sf_dir, "customer").withColumn("c_mktsegment", segment)


def null_keys_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _customer_with_nulls(spark, sf_dir)
    return customer.filter(F.col("c_mktsegment").isNotNull()).drop("c_acctbal")


def null_key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.null_audit(_customer_with_nulls(spark, sf_dir))


def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    dropped = ["l_tax", "l_discount", "l_extendedprice", "l_no_such_column"]
    return sm.drop_columns(table(spark, sf_dir, "lineitem"), dropped)


def city_from_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(F.lit("  "), F.upper("p_name"), F.lit(", "), "p_brand", F.lit(" "))
    part = table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))
    return part.withColumn("city", sm.city_of("label"))


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(
        F.col("o_orderstatus") == "P", F.concat(F.lit("no date "), "o_orderstatus")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("dt"))
    return orders.withColumns({"year": year_of("dt"), "month": month_of("dt")})


def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_mktsegment").alias("c.segment")
    )
    return sm.unpivot_columns(customer, ["c_custkey"])


def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").orderBy("o_orderkey").limit(20)


# Profiles and gates


def value_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.value_profile(table(spark, sf_dir, "events"), "event_type")


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def row_count_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    sm.require_rows(table(spark, sf_dir, "lineitem"), "lineitem")
    return sm.row_counts({name: table(spark, sf_dir, name) for name in TABLES})


# Pivots


def category_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return sm.pivot_counts(lineitem, ["l_orderkey"], "l_returnflag", "l_quantity")


def category_pivot_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells above 2^53, which neither 32 bits nor doubles hold."""
    amount = F.col("l_orderkey") * 1_000_000_007 + F.col("l_linenumber")
    lineitem = table(spark, sf_dir, "lineitem").withColumn("amount", amount.cast("long"))
    return sm.pivot_counts(lineitem, ["l_linestatus"], "l_returnflag", "amount")


def category_pivot_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.nullif(F.col("l_returnflag"), F.lit("N"))
    quantity = F.nullif(F.col("l_quantity"), F.lit(7.0))
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_partkey", flag.alias("flag"), quantity.alias("quantity")
    )
    return sm.pivot_counts(lineitem, ["l_partkey"], "flag", "quantity")


def _lineitem_with_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.nullif(F.col("l_linestatus"), F.lit("O"))
    return table(spark, sf_dir, "lineitem").withColumn("l_linestatus", status)


def _cell_text() -> Column:
    return F.array_join(
        F.transform("cells", lambda c: F.concat_ws("=", c["category"].cast("string"), c["total"].cast("string"))), ","
    ).alias("cells")


def sparse_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many categories as there are parts, one of them also as a column."""
    lineitem = table(spark, sf_dir, "lineitem")
    pivot = sm.sparse_pivot(lineitem, ["l_suppkey"], "l_partkey", "l_quantity", [1])
    return pivot.select("l_suppkey", F.size("cells").alias("n_cells"), _cell_text(), F.col("1").alias("part_1"))


def sparse_pivot_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivots of each line status alone, merged."""
    lineitem = table(spark, sf_dir, "lineitem")
    parts = [
        sm.sparse_pivot(lineitem.filter(test), ["l_suppkey"], "l_partkey", "l_quantity")
        for test in ("l_linestatus = 'O'", "l_linestatus <> 'O'", "l_linestatus IS NULL")
    ]
    merged = sm.merge_sparse_pivots(parts, ["l_suppkey"])
    return merged.select("l_suppkey", _cell_text(), sm.cell_of("cells", 2).alias("part_2"))


def pivot_join_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _lineitem_with_null_keys(spark, sf_dir).select(
        "l_orderkey", "l_linestatus", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity"
    )
    joined = sm.attach_pivot(
        lineitem, ["l_orderkey", "l_linestatus"], "l_returnflag", "l_quantity", distinct=False
    )
    return joined.withColumn("key", sm.joined_key("l_linestatus", "l_orderkey"))


def pivot_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _lineitem_with_null_keys(spark, sf_dir).select(
        "l_suppkey",
        "l_linestatus",
        year_of("l_shipdate").alias("year"),
        "l_returnflag",
        "l_quantity",
    )
    return sm.attach_pivot(
        lineitem, ["l_suppkey", "l_linestatus"], "l_returnflag", "l_quantity", ["A", "N", "R"]
    )


def pivot_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _lineitem_with_null_keys(spark, sf_dir).select(
        "l_suppkey", "l_linestatus", "l_linenumber", "l_returnflag", "l_quantity"
    )
    return sm.attach_pivot(
        lineitem,
        ["l_suppkey", "l_linestatus"],
        "l_returnflag",
        "l_quantity",
        ["A", "N", "R"],
        distinct=False,
        null_safe=False,
    )


# Latest years and means


def latest_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.latest_year(table(spark, sf_dir, "lineitem"), "l_shipdate")


def trailing_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = sm.within_latest_years(table(spark, sf_dir, "lineitem"), "l_shipdate", 3)
    return recent.groupBy(year_of("l_shipdate").alias("year")).count()


def trailing_years_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.within_latest_years(date_parts(spark, sf_dir), "dt", 2)


LATEST_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber"]


def latest_per_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return sm.latest_per_key(
        lineitem, ["l_suppkey", "l_returnflag"], LATEST_ORDER, [*LATEST_ORDER, "l_quantity"]
    )


def _trailing_mean(spark: SparkSession, sf_dir: str, dedupe: str) -> DataFrame:
    recent = sm.within_latest_years(table(spark, sf_dir, "lineitem"), "l_shipdate", 3)
    return sm.mean_by(
        recent.filter((F.col("l_linestatus") == "O") & F.col("l_quantity").isNotNull()),
        ["l_suppkey"],
        {"l_quantity": "mean_quantity", "l_linenumber": "mean_line"},
        dedupe,
        location=["l_suppkey", "l_returnflag"],
        order=[*LATEST_ORDER, "l_quantity"],
    )


def trailing_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trailing_mean(spark, sf_dir, "none")


def trailing_avg_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trailing_mean(spark, sf_dir, "latest")


def trailing_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly runs into stored sums: all earlier months, then the latest one alone, which is run twice."""
    month = F.date_trunc("month", "l_shipdate")
    counted = F.when(F.col("l_quantity").isNotNull(), F.col("l_linenumber"))
    lineitem = table(spark, sf_dir, "lineitem").withColumn("l_linenumber", counted)
    latest = lineitem.agg(F.max(month).alias("month"))
    path, keys = sm.scratch_path(spark, "states"), ["l_suppkey", "l_linestatus"]
    means = {"l_quantity": "mean_quantity", "l_linenumber": "mean_line"}
    for rows in (month < latest.scalar(), month == latest.scalar(), month == latest.scalar()):
        sm.add_months(lineitem.filter(rows), path, keys, "l_shipdate", list(means))
    found = sm.mean_of_states(spark, path, keys, means, years=3)
    return found.filter("l_linestatus = 'O' AND mean_quantity IS NOT NULL").drop("l_linestatus")


# Dictionaries and text


def code_map_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return code_map_rows(events, "props")


def _text(*lines) -> Column:
    parts = []
    for line in lines:
        parts += [*(line if isinstance(line, tuple) else (line,)), "\n"]
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])


def label_text_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, name, brand, kind, size = (
        F.col(c) for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    )
    text = _text(
        ("/* part ", key.cast("string"), ": 'codes' / labels"),
        "   second = 'no entry' */",
        "  value $brand",
        ("   '", brand, "'\t=\t'", name, ", IT''S / ", kind, "     '"),
        "   'x.y' = 'first' /* = repeated */",
        ("   'x.y' = '", kind, "; checked' ;"),
        "",
        "/* sizes, in a comment:",
        "value size",
        ("   ", size.cast("string"), "  =  Size ", size.cast("string")),
        "*/",
        ";",
    )
    docs = table(spark, sf_dir, "part").select("p_partkey", text.alias("value"))
    return sm.label_dictionary(docs, doc=["p_partkey"])


def label_text_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, brand, kind, size = (F.col(c) for c in ("p_name", "p_brand", "p_type", "p_size"))
    text = _text(
        "libname library 'folder' ;",
        "proc format library=library ;",
        "",
        "/* brands */",
        "",
        "",
        "  value $brand",
        ("   '", brand, "'\t=\t'", name, "      '"),
        "   'x.y' = 'first'",
        "   'n/a' = 'lost line'",
        ("   'x.y' = '", kind, "' ;"),
        ";",
        "/* sizes:",
        "value size",
        ("   ", size.cast("string"), " = Size ", size.cast("string")),
        "*/",
    )
    docs = table(spark, sf_dir, "part").select("p_partkey", text.alias("value"))
    return sm.label_dictionary(docs, doc=["p_partkey"], parity=True)


def label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label document for every region, each a text file of its own, read and parsed."""
    region = table(spark, sf_dir, "region")
    text = _text("value $region", ("'", F.col("r_regionkey").cast("string"), "' = '", F.col("r_name"), "' ;"))
    path = sm.scratch_path(spark, "regions")
    region.select("r_regionkey", text.alias("value")).write.partitionBy("r_regionkey").text(path)
    return sm.label_dictionary(sm.read_documents(spark, path)).select("section", "code", "label")


def label_files_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label document for every brand, with all of its parts, read line by line in splits."""
    part = table(spark, sf_dir, "part")
    key, brand = F.col("p_partkey").cast("string"), F.replace("p_brand", F.lit("#"), F.lit("_"))
    lines = F.array(
        F.concat(F.lit("'"), key, F.lit("' = '"), F.col("p_name"), F.lit(" / it''s' /* size")),
        F.concat(F.col("p_size").cast("string"), F.lit(" */ ;")),
        F.concat(F.lit("last = '"), key, F.lit("'")),
    )
    heads = part.select(brand.alias("brand"), F.lit(0).cast("long").alias("at"), F.lit(0).alias("n")).distinct()
    heads = heads.withColumn("value", F.concat(F.lit("value $"), "brand"))
    body = part.select(brand.alias("brand"), F.col("p_partkey").alias("at"), F.posexplode(lines).alias("n", "value"))
    texts = heads.unionByName(body).repartition("brand").sortWithinPartitions("brand", "at", "n")
    path = sm.scratch_path(spark, "brands")
    texts.select("brand", "value").write.partitionBy("brand").text(path)
    return sm.split_label_dictionary(spark, path).drop("path")


def line_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sm.document_lines(
        documents, "text", drop_pattern="/", skip=5, min_length=9, drop_phrases=["the "]
    )


def last_label_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return sm.last_wins(orders, ["o_custkey"], "o_orderpriority", "o_orderkey")


# Keys and star joins


def code_map_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as one JSON object over many lines, with a repeated code, used as a dictionary."""
    entry = F.format_string('  "%d": "%s"', "n_nationkey", "n_name")
    early = F.lit('  "3": "not the last"')
    nations = table(spark, sf_dir, "nation").agg(
        F.concat(F.lit("{\n"), F.array_join(F.concat(F.array(early), F.sort_array(F.collect_list(entry))), ",\n"), F.lit("\n}"))
    )
    path = sm.scratch_path(spark, "nations")
    nations.write.text(path)
    codes = sm.read_code_map(spark, path, multi_line=True, order="place")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    lookup = sm.Lookup(codes, "c_nationkey", "code", {"label": "nation"}, numeric=True, order="place")
    return sm.decode(customer, [lookup])


def new_keys_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    date = F.col("o_orderdate")
    in_2001 = (date >= F.lit("2001-01-01").cast("date")) & (date < F.lit("2002-01-01").cast("date"))
    orders = table(spark, sf_dir, "orders").filter(in_2001)
    known = orders.select(F.col("o_custkey").alias("c_custkey"))
    return sm.new_keys_only(customer, known, ["c_custkey"])


def one_row_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").withColumn(
        "c_nationkey", F.nullif(F.col("c_nationkey"), F.lit(3))
    )
    return sm.one_row_per_key(customer, ["c_nationkey", "c_mktsegment"], prefer=["c_acctbal"])


def star_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    pivot = sm.pivot_counts(
        lineitem, ["l_suppkey"], "l_returnflag", "l_quantity", ["A", "N", "R"]
    )
    supplies = sm.materialize(pivot, "supplies")
    means = sm.materialize(trailing_avg(spark, sf_dir), "means")
    fact = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return sm.enrich(
        fact,
        [
            sm.Dimension(
                supplies, {"l_suppkey": "l_suppkey"}, {c: c for c in "ANR"}, unique=True
            ),
            sm.Dimension(
                means,
                {"l_suppkey": "l_suppkey"},
                {"mean_quantity": "mean_quantity"},
                unique=True,
            ),
            sm.Dimension(
                table(spark, sf_dir, "part"),
                {"l_partkey": "p_partkey"},
                {"p_name": "p_name", "p_brand": "p_brand"},
                unique=True,
            ),
        ],
    )


def star_enrichment_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = sm.Dimension(
        table(spark, sf_dir, "part"), {"l_partkey": "p_partkey"}, {"p_name": "p_name"}
    )
    return sm.enrich(lineitem, [part], broadcast_bytes=0)


# Sinks, read back


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = sm.scratch_path(spark, "orders")
    sm.write_csv(orders, path)
    return sm.read_csv(spark, path, orders.schema)


def csv_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sm.scratch_path(spark, "customer")
    sm.write_csv(_customer_with_nulls(spark, sf_dir).drop("c_acctbal"), path, sep=";")
    return sm.read_csv(spark, path, sep=";")


def csv_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with quotes, commas and line breaks, written and read back."""
    odd = F.concat(F.lit('Lowell "Field", '), F.col("p_name"), F.lit('\n"'), F.col("p_brand"), F.lit('""'))
    part = table(spark, sf_dir, "part").select("p_partkey", odd.alias("p_name"), "p_size")
    path = sm.scratch_path(spark, "quotes")
    sm.write_csv(part, path)
    return sm.read_csv(spark, path, part.schema, multiLine=True)


def csv_quotes_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same names, read by as many tasks as the files have blocks."""
    odd = F.concat(F.lit('Lowell "Field", '), F.col("p_name"), F.lit('\n"'), F.col("p_brand"), F.lit('""'))
    part = table(spark, sf_dir, "part").select("p_partkey", odd.alias("p_name"), "p_size")
    path = sm.scratch_path(spark, "quotes")
    sm.write_csv(part, path)
    return sm.read_csv_records(spark, path, part.schema)


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of parts, some malformed: the good rows typed, the others with their reason and text."""
    part = table(spark, sf_dir, "part")
    key, name, size = (F.col(c).cast("string") for c in ("p_partkey", "p_name", "p_size"))
    plain = F.concat(key, F.lit(',"'), name, F.lit('\n""x""",'), size)
    form = F.pmod("p_partkey", F.lit(10))
    line = (
        F.when(form == 3, F.concat(key, F.lit(","), name))
        .when(form == 6, F.concat(plain, F.lit(",7")))
        .when(form == 9, F.concat(key, F.lit(","), name, F.lit(",size "), size))
        .otherwise(plain)
    )
    path = sm.scratch_path(spark, "malformed")
    part.select(line.alias("value")).write.text(path)
    schema = part.select("p_partkey", "p_name", "p_size").schema
    good, bad = sm.read_csv_checked(spark, path, schema, header=False)
    sm.require_clean(good, bad, "parts", 0.5)
    return good.unionByName(bad.select("reason", "record"), allowMissingColumns=True)


def csv_without_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    path = sm.scratch_path(spark, "part")
    sm.write_csv(part, path, header=False)
    return spark.read.schema(part.schema).csv(path)


def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = value_profile(spark, sf_dir)
    path = sm.scratch_path(spark, "profile")
    for _ in range(2):
        sm.write_single_csv(profile, path)
    schema = T.StructType().add("event_type", "string").add("count", "long")
    files = F.countDistinct(F.col("_metadata.file_path")).alias("files")
    back = spark.read.options(header=True).schema(schema).csv(path)
    return back.groupBy("event_type").agg(
        files, F.count(F.lit(1)).alias("copies"), F.sum("count").alias("total")
    )


def write_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    path = sm.scratch_path(spark, "supplier")
    sm.write_if_absent(supplier, path)
    sm.write_if_absent(supplier.withColumn("s_acctbal", F.lit(0.0)), path)
    return spark.read.parquet(path)


def checked_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gated write of all orders, and the report of the check that asks for it."""
    path = sm.scratch_path(spark, "checked")
    write_gated(table(spark, sf_dir, "orders"), "orders", path, sm.write_parquet)
    return sm.require_outputs(spark, {"orders": ("parquet", path)}, min_rows=1)


def gated_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An output written, rewritten from itself, and kept as it is when a later gate fails."""
    path = sm.scratch_path(spark, "gated")
    open_orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    write_gated(open_orders, "orders", path, sm.write_parquet)
    late = spark.read.parquet(path).filter("o_orderdate >= DATE'1998-01-01'")
    write_gated(late.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("late")), "late", path, sm.write_parquet)
    try:
        write_gated(spark.read.parquet(path).filter("late < 0"), "none", path, sm.write_parquet)
    except AssertionError:
        return spark.read.parquet(path)
    raise AssertionError("the gate let a table without rows pass")


def output_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gated output with its manifest, to which rows are then added in files that it does not list."""
    path, orders = sm.scratch_path(spark, "sealed"), table(spark, sf_dir, "orders")
    write_gated(orders, "orders", path, sm.sealed(sm.write_parquet))
    sm.require_contents(spark, {"orders": ("parquet", path)})
    sm.write_parquet(orders.filter("o_orderstatus = 'O'"), path, mode="append")
    return sm.content_report(spark, path).groupBy("status").agg(F.sum("rows").alias("rows"))


def merged_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension of an earlier month, with other balances and without some keys, brought up to date."""
    customer, path = table(spark, sf_dir, "customer"), sm.scratch_path(spark, "dimension")
    earlier = customer.filter("c_custkey % 101 > 0").withColumn(
        "c_acctbal", F.when(F.col("c_custkey") % 97 == 0, 0.0).otherwise(F.col("c_acctbal"))
    )
    sm.merge_buckets(earlier, path, ["c_custkey"])
    changed = customer.filter("c_custkey % 101 = 0 OR c_custkey % 97 = 0")
    sm.merge_buckets(changed, path, ["c_custkey"])
    return sm.read_buckets(spark, path)


def output_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, part = table(spark, sf_dir, "events"), table(spark, sf_dir, "part")
    base = sm.scratch_path(spark, "outputs")
    sm.write_parquet(events, f"{base}/events", partition_by=["event_type"])
    sm.write_csv(part, f"{base}/part")
    outputs = {
        "events": ("parquet", f"{base}/events"),
        "part": ("csv", f"{base}/part"),
        "missing": ("csv", f"{base}/missing"),
    }
    return sm.output_report(spark, outputs)


def dictionary_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("section"),
        F.col("p_partkey").cast("string").alias("code"),
        F.col("p_name").alias("label"),
    )
    path = sm.scratch_path(spark, "dictionary")
    sm.write_dictionary(part, path, "json")
    return sm.read_code_map(spark, path)


QUERIES = {
    query.__name__: query
    for query in (
        lookup_string_left,
        lookup_numeric_text,
        lookup_number_forms,
        lookup_chain,
        lookup_chain_shuffled,
        lookup_hot_key,
        lookup_required_shuffled,
        label_match_shares,
        invalid_label_filter,
        null_keys_dropped,
        null_key_audit,
        drop_columns,
        city_from_label,
        date_parts,
        wide_to_long,
        preview_limit,
        value_profile,
        row_count_gate,
        category_pivot,
        category_pivot_large,
        category_pivot_nulls,
        sparse_pivot,
        sparse_pivot_merged,
        pivot_join_back,
        pivot_distinct,
        pivot_null_keys,
        latest_year,
        trailing_years,
        trailing_years_text,
        latest_per_location,
        trailing_avg,
        trailing_avg_latest,
        trailing_states,
        code_map_explode,
        code_map_multiline,
        label_text_parse,
        label_text_parity,
        label_files,
        label_files_split,
        line_filters,
        last_label_wins,
        new_keys_only,
        one_row_per_key,
        star_enrichment,
        star_enrichment_shuffled,
        csv_roundtrip,
        csv_semicolon,
        csv_quotes,
        csv_quotes_split,
        csv_quarantine,
        csv_without_header,
        append_roundtrip,
        write_if_absent,
        checked_output,
        gated_rewrite,
        output_manifest,
        merged_dimension,
        output_presence,
        dictionary_roundtrip,
    )
}
