"""Scratch tables that every executor can read."""

import atexit
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=None)
def _local_base(application_id: str) -> str:
    folder = tempfile.mkdtemp(prefix=f"starmart-{application_id}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, grouped by application id.

    A temporary folder of this machine is used only with a local master and without the setting;
    on a cluster its files would not be seen by other machines, so there the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    application_id = spark.sparkContext.applicationId
    master = spark.conf.get("spark.master", "")
    if not shared and not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = f"{shared.rstrip('/')}/starmart-{application_id}" if shared else _local_base(application_id)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a scratch parquet table and read it back.

    For a derived table that is used several times: it is computed once, its lineage is cut,
    it survives the loss of executors, and Spark knows the size of the files it reads.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
