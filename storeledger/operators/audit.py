"""Ingestion events: building, de-duplicating and reconciling the audit log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import AUDIT_FIELDS


def ingestion_events(checked: DataFrame, timestamp: Column, failure_date: Column) -> DataFrame:
    """One audit event per checked capture; failures are sorted by ``failure_date``."""
    ok = F.col("error_message").isNull()

    def when_ok(value):
        return F.when(ok, value.cast("string")).otherwise(F.lit(""))

    return checked.select(
        timestamp.cast("string").alias("timestamp_utc"),
        when_ok(F.col("order_date")).alias("order_date"),
        F.when(ok, "success").otherwise("failure").alias("status"),
        when_ok(F.col("row_count")).alias("row_count"),
        when_ok(F.col("file_size_bytes")).alias("file_size_bytes"),
        when_ok(F.col("sha256")).alias("sha256"),
        F.coalesce("error_message", F.lit("")).alias("error_message"),
        F.when(ok, F.col("order_date").cast("string"))
        .otherwise(failure_date.cast("string")).alias("sort_date"),
    )


def event_key(events: DataFrame) -> DataFrame:
    """Add the key under which an event is logged once: a success by date and
    hash, a failure by day and message."""
    ok = F.col("status") == "success"
    return events.withColumns({
        "key_status": F.when(ok, "success").otherwise("failure"),
        "key_date": F.when(ok, F.col("order_date")).otherwise(F.col("sort_date")),
        "key_text": F.when(ok, F.col("sha256")).otherwise(F.col("error_message")),
    })


KEY = ["key_status", "key_date", "key_text"]


def events_to_append(events: DataFrame, log: DataFrame) -> DataFrame:
    """Events whose key is not logged yet, the earliest of each key.

    Absent fields count as ''. The batch is reduced to one event per key by a
    pre-aggregating minimum before it meets the log.
    """
    filled = events.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in AUDIT_FIELDS])
    known = event_key(log.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in AUDIT_FIELDS]))
    first = event_key(filled).groupBy(*KEY).agg(F.min(F.struct(*AUDIT_FIELDS)).alias("e"))
    return first.join(known.select(*KEY).distinct(), KEY, "left_anti").select("e.*")


def audit_gaps(facts: DataFrame, log: DataFrame) -> DataFrame:
    """Preserved captures without a success event of their date and hash."""
    logged = log.where("status = 'success'").select("order_date", "sha256").distinct()
    return facts.join(logged, ["order_date", "sha256"], "left_anti")


def replay_summary(checked: DataFrame) -> DataFrame:
    """Valid and failed captures, counted."""
    status = F.when(F.col("error_message").isNull(), "valid").otherwise("failed")
    return checked.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("capture_count"))


def schema_cutover(facts: DataFrame) -> DataFrame:
    """Rows per capture date and key column, with the first date of each key column."""
    rows = facts.groupBy("order_date", "product_id_column").agg(
        F.sum("row_count").alias("row_count"))
    first = facts.groupBy("product_id_column").agg(F.min("order_date").alias("first_date"))
    return rows.join(first, "product_id_column")
