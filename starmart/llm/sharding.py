"""Sharding by a two-pass external shuffle.

Pass one scatters the records uniformly into buckets that fit in memory, by seeded hashes of their
keys and texts. Pass two brings each bucket together, shuffles it with Fisher and Yates' algorithm
from a seed of its own, and writes it. Bucket after bucket, the shuffled records form one order of
the whole table; they are dealt to the shards in turn, so that shards differ by one record at most.

The result depends on the records, the seed and the number of buckets alone, so a task that is run
again does the same. Records alike in keys and text go to one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from starmart.llm.ordinals import running_starts
from starmart.llm.tables import name, pieces_of, shuffle_partitions, text_bytes

SHARDS = 8
BUCKET_BYTES = 64 << 20
SEED = 20240229

_BUCKET, _ORDER = "__bucket", "__order"
_GROUP = 1024


def bucket_count(df: DataFrame, text: str, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of about ``bucket_bytes`` of text, and at least one for each shuffle partition."""
    return pieces_of(text_bytes(df, text), bucket_bytes, shuffle_partitions(df.sparkSession))


def shuffle_to_shards(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    text: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Write all records below ``path``, a folder for each shard, and return the files as a table.

    New columns: ``shard`` (0 to ``shards`` - 1) and ``slot`` (place in the shard, gapless from 0);
    existing columns of these names are replaced. Null keys and null texts are values like others.
    An empty table is written as one without rows.
    """
    df = df.drop("shard", "slot")
    spark = df.sparkSession
    buckets = bucket_count(df, text, bucket_bytes)
    crc = F.coalesce(F.crc32(F.encode(name(text), "utf-8")), F.lit(-1))
    dealt = F.xxhash64(F.lit(seed), *[name(k) for k in keys], crc)
    scattered = df.withColumn(_BUCKET, F.pmod(dealt, F.lit(buckets)))
    # Rows arrive in any order; a second hash puts a bucket in a fixed one before it is shuffled.
    scattered = scattered.withColumn(_ORDER, F.xxhash64(F.lit(seed + 1), *[name(k) for k in keys], crc))

    kept = df.columns
    schema = StructType(
        [*df.schema.fields, StructField("slot", LongType()), StructField("shard", IntegerType())]
    )

    def fisher_yates(bucket: pa.Table, start: pa.Table) -> pa.Table:
        number, first = start["__b"][0].as_py(), start["__from"][0].as_py()
        fixed = bucket.sort_by(_ORDER)
        random = np.random.Generator(np.random.Philox(key=[seed, number]))
        place = np.arange(first, first + len(fixed))
        columns = fixed.take(pa.array(random.permutation(len(fixed)))).select(kept).columns
        dealt = [pa.array(place // shards), pa.array((place % shards).astype(np.int32))]
        return pa.table([*columns, *dealt], names=[*kept, "slot", "shard"])

    sizes = scattered.groupBy(F.col(_BUCKET).alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    starts = running_starts(sizes, "__b", "__n", _GROUP, "__from")
    # The start of a bucket comes to it as a second group, so that texts move only once.
    result = scattered.groupBy(_BUCKET).cogroup(starts.groupBy("__b")).applyInArrow(fisher_yates, schema)
    result.write.partitionBy("shard").parquet(path)
    return spark.read.schema(schema).parquet(path)
