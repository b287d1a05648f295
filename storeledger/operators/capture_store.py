"""Immutable capture store: what a new delivery means against what is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_delivered(incoming: DataFrame, key: str = "order_date") -> DataFrame:
    """Path and hash of the delivery of each key that counts as first: the one with the first path."""
    return incoming.groupBy(key).agg(F.min_by(F.struct("path", "sha256"), "path").alias("first"))


def classify_captures(
    incoming: DataFrame, preserved: DataFrame, key: str = "order_date", first: DataFrame | None = None
) -> DataFrame:
    """Label each delivery ``new``, ``unchanged``, ``conflict``, ``missing_file``
    or ``checksum_mismatch``.

    ``incoming``: path, key, sha256. ``preserved``: key, sha256 (null when the
    key's folder has no file) and optionally recorded_sha256. When one batch
    delivers a key more than once, the first path counts as delivered first; who has
    ``first_delivered`` at hand already passes it as ``first``. Other columns of ``incoming`` stay.
    """
    kept = preserved.select(
        key,
        F.col("sha256").alias("kept_sha256"),
        (F.col("recorded_sha256") if "recorded_sha256" in preserved.columns
         else F.lit(None).cast("string")).alias("recorded_sha256"),
        F.lit(True).alias("is_kept"),
    )
    first = first_delivered(incoming, key) if first is None else first
    state = (
        F.when(F.col("is_kept") & F.col("kept_sha256").isNull(), "missing_file")
        .when(F.col("is_kept") & (F.col("kept_sha256") != F.col("sha256")), "conflict")
        .when(F.col("is_kept") & (F.lower("recorded_sha256") != F.col("kept_sha256")),
              "checksum_mismatch")
        .when(F.col("is_kept"), "unchanged")
        .when(F.col("path") == F.col("first.path"), "new")
        .when(F.col("sha256") == F.col("first.sha256"), "unchanged")
        .otherwise("conflict")
    )
    return (
        incoming.join(first, key, "left").join(kept, key, "left")
        .withColumn("capture_state", state)
        .drop("first", "is_kept", "recorded_sha256")
    )


def profile_captures(lines: DataFrame, by: str, product: str) -> DataFrame:
    """Per capture: rows, columns, missing values, repeated ids, stores, products."""
    measured = [c for c in lines.columns if c != by]
    nulls = sum((F.col(c).isNull().cast("int") for c in measured), F.lit(0))
    return lines.groupBy(by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max(F.lit(len(measured))).alias("column_count"),
        F.sum(nulls).alias("missing_values"),
        # Blank ids are equal to one another, so they count as one distinct value.
        (F.count(F.lit(1)) - F.count_distinct(F.coalesce("order_id", F.lit("\0"))))
        .alias("duplicate_order_ids"),
        F.count_distinct("store_id").alias("distinct_stores"),
        F.count_distinct(product).alias("distinct_products"),
    )


def first_records(lines: DataFrame, order_by, n: int = 5) -> DataFrame:
    """The first ``n`` records by a stated order; Spark keeps only ``n`` per task."""
    return lines.orderBy(*order_by).limit(n)
