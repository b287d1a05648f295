"""Small helpers over whole frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """Put frames of a single row each next to one another, as one row."""
    stacked = one_row[0]
    for frame in one_row[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal the rows of an input that comes in very few splits over the cores.

    A file with one row group is one task, however many cores wait. Inputs with
    a split per core or more, as large ones have, are left alone: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits >= cores:
        return df
    return df.repartition(min(cores, 16 * splits), *keys)
