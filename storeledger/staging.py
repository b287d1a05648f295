"""Cutting lineage with written tables.

A result that several later steps read is written once to the folder the
cluster shares (``spark.checkpoint.dir``). Unlike a cached or locally
checkpointed frame it survives the loss of executors, and its size is known to
the planner. The folders may be cleared once a job has ended.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame

from .session import shared_folder


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a frame that reads it back."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/storeledger/{label}-{uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
