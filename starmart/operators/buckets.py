"""Dimensions kept in buckets of their keys, of which a run rewrites only those that changed.

A folder ``b<number>of<buckets>`` below ``path`` holds the rows whose keys hash to that number. A run
compares the number of rows and an order-free hash of them bucket by bucket, and puts new folders in
place by a rename; the others are neither written nor touched.
"""

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.manifests import row_hash
from starmart.sources import files, staging
from starmart.sources.scratch import materialize
from starmart.sources.writers import write_parquet

BUCKETS = 64
_FOLDER = re.compile(r"b(\d+)of(\d+)")
_LOST = re.compile(r"_(b\d+of\d+)\.previous")
_BUCKET = "__bucket"


def _folder(path: str, number: int, buckets: int) -> str:
    return f"{path.rstrip('/')}/b{number}of{buckets}"


def _stored(spark: SparkSession, path: str, buckets: int | None = None) -> dict[int, str]:
    """The folders by number; what a lost commit had moved away is brought back."""
    for name in files.names(spark, path):
        lost = _LOST.fullmatch(name)
        if lost:
            staging.recover(spark, f"{path.rstrip('/')}/{lost[1]}")
    found = [match for match in map(_FOLDER.fullmatch, files.names(spark, path)) if match]
    if any(buckets is not None and int(match[2]) != buckets for match in found):
        raise ValueError(f"{path} has {found[0][2]} buckets, not {buckets}")
    return {int(match[1]): f"{path.rstrip('/')}/{match[0]}" for match in found}


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[_named(key) for key in keys]), F.lit(buckets)).cast("int").alias(_BUCKET)


def _states(df: DataFrame, columns: Sequence[str], suffix: str) -> DataFrame:
    plain = df.select(*[_named(name) for name in columns])
    hashed = df.select(_BUCKET, row_hash(plain).cast("decimal(20,0)").alias("hash"))
    return hashed.groupBy(F.col(_BUCKET).alias(f"bucket_{suffix}")).agg(
        F.count(F.lit(1)).alias(f"rows_{suffix}"), F.sum("hash").alias(f"hash_{suffix}")
    )


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The whole dimension."""
    found = _stored(spark, path)
    if not found:
        raise FileNotFoundError(f"no buckets at {path}")
    return spark.read.parquet(*[found[number] for number in sorted(found)])


def merge_buckets(
    df: DataFrame, path: str, keys: Sequence[str], complete: bool = False, buckets: int = BUCKETS
) -> list[int]:
    """Merge rows by their keys into the dimension at ``path``; the numbers of the buckets written.

    Rows of ``df`` take the place of all stored ones with the same keys, NULL being a key like others;
    new keys are added. With ``complete`` ``df`` is the whole dimension and keys that it lacks go.
    ``df`` is computed once, and of the stored rows only buckets with rows of ``df`` are read (all
    with ``complete``). A bucket whose rows stay the same is not written, so running again after a
    lost job completes it. One job merges into a path at a time; columns and the number of buckets
    stay those of the first run, and decimal, float or text values of equal bits are the same.
    """
    spark = df.sparkSession
    stored = _stored(spark, path, buckets)
    columns, schema = df.columns, df.schema
    new = materialize(df.select("*", _bucket(keys, buckets)), "buckets")
    # At most a number for each bucket.
    touched = {row[0] for row in new.select(_BUCKET).distinct().collect()}
    read = sorted(stored if complete else touched & set(stored))
    states = _states(new, columns, "new")
    merged = new
    if read:
        old = spark.read.parquet(*[stored[number] for number in read])
        # Files do not keep which values may be NULL.
        kinds = [{field.name: field.dataType.simpleString() for field in of.fields} for of in (schema, old.schema)]
        if kinds[0] != kinds[1]:
            raise ValueError(f"{path} has other columns: {old.schema.simpleString()}")
        old = old.select(*[_named(name) for name in columns], _bucket(keys, buckets))
        if not complete:
            key_rows = new.select(*[_named(key).alias(f"__key{n}") for n, key in enumerate(keys)]).distinct()
            same = [_named(key).eqNullSafe(F.col(f"__key{n}")) for n, key in enumerate(keys)]
            merged = new.unionAll(old.join(key_rows, reduce(Column.__and__, same), "left_anti"))
            states = _states(merged, columns, "new")
        before = _states(old, columns, "old")
        both = states.join(before, F.col("bucket_new") == F.col("bucket_old"), "full")
        equal = (F.col("rows_new") == F.col("rows_old")) & (F.col("hash_new") == F.col("hash_old"))
        wrong = both.filter(~F.coalesce(equal, F.lit(False)))
        changed = sorted(row[0] for row in wrong.select(F.coalesce("bucket_new", "bucket_old")).collect())
    else:
        changed = sorted(touched)
    if not changed:
        return []
    staged = f"{path.rstrip('/')}/_staged"
    files.remove(spark, staged)
    numbered = merged.filter(F.col(_BUCKET).isin(changed)).withColumnRenamed(_BUCKET, "bucket__")
    write_parquet(numbered, staged, partition_by=["bucket__"])
    for number in changed:
        target, source = _folder(path, number, buckets), f"{staged}/bucket__={number}"
        if files.exists(spark, source):
            files.move(spark, source, staging.stage(spark, target))
            staging.commit(spark, target)
        else:
            # Its last rows are gone.
            files.remove(spark, target)
    files.remove(spark, staged)
    return changed
