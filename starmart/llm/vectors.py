"""Vectors of a table column as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.tables import name


def all_vectors(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v array<double>, finite, sound): whether all components are finite, and the id is known."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    finite = F.coalesce(F.col("v").isNotNull() & ~bad, F.lit(False))
    return df.select(
        name(id_column).cast("long").alias("id"), name(vector).cast("array<double>").alias("v")
    ).withColumns({"finite": finite, "sound": F.col("id").isNotNull() & finite})


def sound_vectors(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v array<double>, dim) of the sound rows."""
    return all_vectors(df, id_column, vector).filter("sound").select("id", "v", F.size("v").alias("dim"))


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """A list column whose lists all have ``dim`` elements, as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), dim)
