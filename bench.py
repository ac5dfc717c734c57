"""Times the headline queries; prints one JSON line.

``--naive`` times the same work in plain Spark: joins as SQL, the built-in pivot, the latest year read
by the driver. Both sides are timed from the call to the end of one write, without a gate.
``--all`` times every query of the catalog. ``--plans`` prints the plans instead.
"""

import argparse
import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.queries import CHAIN_RULES, QUERIES, table

HEADLINE = (
    "lookup_chain",
    "category_pivot",
    "trailing_avg",
    "trailing_avg_latest",
    "label_text_parse",
    "star_enrichment",
    "pivot_distinct",
    "latest_per_location",
    "line_filters",
    "code_map_explode",
)


def write(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


# The plain shape of the same work: each returns the table that is then written like ours.

PLAIN_CHAIN = """
    SELECT l.* EXCEPT (l_tax), o_orderpriority AS priority, n_name AS nation,
           c_mktsegment AS segment, initcap(split(trim(r_name || ', ' || n_name), ',')[0]) AS city
    FROM lineitem l
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
    WHERE NOT contains(o_orderpriority, 'NOT SPECIFIED') AND NOT contains(n_name, 'NATION_1')
      AND NOT contains(r_name, 'AFRICA') AND NOT contains(r_name, 'Collapsed')
      AND c_mktsegment IS NOT NULL
"""


def plain_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name in ("lineitem", "orders", "customer", "nation", "region"):
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(PLAIN_CHAIN)


def plain_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    pivot = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").pivot("l_returnflag")
    return pivot.agg(F.sum("l_quantity").cast("bigint")).fillna(0)


def _plain_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    last = lineitem.agg(F.max("l_shipdate")).first()[0].year
    wanted = (F.year("l_shipdate") > last - 3) & (F.col("l_linestatus") == "O")
    return lineitem.filter(wanted & F.col("l_quantity").isNotNull())


def _plain_means(df: DataFrame) -> DataFrame:
    return df.groupBy("l_suppkey").agg(F.avg("l_quantity"), F.avg("l_linenumber"))


def plain_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_means(_plain_recent(spark, sf_dir))


def plain_means_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_means(_plain_recent(spark, sf_dir).dropDuplicates(["l_suppkey", "l_returnflag"]))


PLAIN = {
    "lookup_chain": plain_chain,
    "category_pivot": plain_pivot,
    "trailing_avg": plain_means,
    "trailing_avg_latest": plain_means_latest,
}


def main() -> None:
    parse = argparse.ArgumentParser()
    parse.add_argument("--naive", action="store_true")
    parse.add_argument("--all", action="store_true")
    parse.add_argument("--plans", nargs="*")
    parse.add_argument("--runs", type=int, default=5)
    args = parse.parse_args()

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("starmart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    if args.plans is not None:
        for name in args.plans or HEADLINE:
            print(f"-- {name}")
            QUERIES[name](spark, sf_dir).explain("formatted")
        return

    names = PLAIN if args.naive else QUERIES if args.all else HEADLINE
    queries = PLAIN if args.naive else QUERIES
    jobs = {name: lambda s, d, q=queries[name]: write(q(s, d)) for name in names}
    seconds = {}
    for name, job in jobs.items():
        for _ in range(2):  # warm-up
            job(spark, sf_dir)
        times = []
        for _ in range(args.runs):
            start = time.perf_counter()
            job(spark, sf_dir)
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 4)
    print(
        json.dumps(
            {
                "metric": "naive_total_seconds" if args.naive else "query_total_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
