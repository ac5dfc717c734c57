"""Numbers of rows within their groups, however large a group is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm.tables import name, shuffle_partitions

_SALT, _GROUP = "__ordinal_salt", "__ordinal_group"


def with_ordinals(
    df: DataFrame, group: str, order: Sequence[Column], ordinal: str, per_partition: int = 4
) -> DataFrame:
    """Number the rows of each group from 0, in an order that hashes of ``order`` deal out.

    A group is split by hashes of ``order`` into ``per_partition`` parts for each shuffle
    partition. Rows are numbered within a part, and the sizes of the parts before it are added, so
    no task sees more of a hot group than a part. Null is a group of its own. Rows alike in ``order``
    may swap their numbers, and come to one part: ``order`` should tell different rows apart.
    """
    parts = per_partition * shuffle_partitions(df.sparkSession)
    salted = df.withColumn(_SALT, F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sizes = salted.groupBy(name(group).alias(_GROUP), F.col(_SALT).alias(_SALT + "2")).agg(
        F.count(F.lit(1)).alias("__ordinal_n")
    )
    before = W.partitionBy(_GROUP).orderBy(_SALT + "2").rowsBetween(W.unboundedPreceding, -1)
    firsts = sizes.select(
        _GROUP, _SALT + "2", F.coalesce(F.sum("__ordinal_n").over(before), F.lit(0)).alias("__ordinal_first")
    )
    within = W.partitionBy(name(group), _SALT).orderBy(*order)
    numbered = salted.withColumn("__ordinal_row", F.row_number().over(within) - 1)
    matched = numbered.join(
        firsts,
        name(group).eqNullSafe(F.col(_GROUP)) & (F.col(_SALT) == F.col(_SALT + "2")),
    )
    return matched.withColumn(ordinal, F.col("__ordinal_first") + F.col("__ordinal_row")).drop(
        _SALT, _SALT + "2", _GROUP, "__ordinal_n", "__ordinal_first", "__ordinal_row"
    )


def running_starts(sizes: DataFrame, key: str, size: str, width: int, start: str) -> DataFrame:
    """(key, start): the sum of ``size`` over all smaller keys; keys are distinct whole numbers.

    Sums are run over groups of ``width`` keys, then inside each group, so the one step that sees
    all of the table at once gets one row for each group.
    """
    grouped = sizes.select(
        name(key).alias("__k"), name(size).alias("__v"), F.expr(f"`{key}` div {width}L").alias("__g")
    )
    earlier = W.orderBy("__h").rowsBetween(W.unboundedPreceding, -1)
    groups = (
        grouped.groupBy(F.col("__g").alias("__h"))
        .agg(F.sum("__v").alias("__sum"))
        .select("__h", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__base"))
    )
    before = W.partitionBy("__g").orderBy("__k").rowsBetween(W.unboundedPreceding, -1)
    return grouped.join(groups, F.col("__g") == F.col("__h")).select(
        F.col("__k").alias(key),
        (F.col("__base") + F.coalesce(F.sum("__v").over(before), F.lit(0))).alias(start),
    )
