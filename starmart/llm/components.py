"""Connected components of a table of links, by alternating large and small stars.

Each round joins the links to the smallest neighbour of each end and ends at a shared folder, so
lost executors cost no more than a round. Rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.tables import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Move every larger (or smaller) neighbour of a node to the least of its neighbours and itself."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    # In a small star a is the larger end, so all that b holds are smaller neighbours.
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = both.join(least, "a")
    if large:
        moved = moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = least.select("a", F.col("m").alias("b"))
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(own)
    return moved.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each linked node reaches; unlinked ones are not listed."""
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    now = materialize(
        ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    mark = None
    while True:
        now = materialize(_star(_star(now, True), False), "links")
        # A star forest, in which every a has one b and no b is an a, does not change any more.
        row = now.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("h")
        ).first()
        if mark == (row["n"], row["h"]):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        mark = (row["n"], row["h"])
