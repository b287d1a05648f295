"""Vectors as rows of ``vec_id`` and ``embedding``, and as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def typed(vectors: DataFrame) -> DataFrame:
    """The two columns the operators work on, the vectors in double precision."""
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def finite() -> Column:
    """Whether ``embedding`` is there and all its entries are finite numbers."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col("embedding").isNotNull() & ~bad, F.lit(False))


def finite_vectors(vectors: DataFrame) -> DataFrame:
    """Finite vectors of the most frequent length; of equally frequent ones, of the longest."""
    rows = typed(vectors).where(finite())
    most = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("embedding") == (most.size if most else 0))


def matrix(lists: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(lists), -1) if len(lists) and len(flat) else np.empty((len(lists), 0))
