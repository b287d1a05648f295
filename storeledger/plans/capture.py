"""Capture runs: validate, preserve, log; replay; weather top-up; daily chain."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators import audit as A
from .. import constants as K
from ..operators.capture_rules import check_captures, check_folder, check_sidecars
from ..operators.capture_store import classify_captures, first_delivered
from ..operators.weather import backfill_plan, missing_stores, request_plan
from ..sinks.files import append_audit
from ..sources.captures import folder_date, read_captures, read_sidecars
from ..sources.tables import cached_stores, stores_with_coordinates
from ..staging import staged

PRESERVED = ("order_date", "path", "row_count", "sha256", "file_size_bytes", "product_id_column")


def preserved_manifest(spark: SparkSession, store: str) -> DataFrame:
    """What the capture store holds: one row per preserved date, without contents."""
    return _kept(spark, store).select(*PRESERVED)


def _kept(spark: SparkSession, store: str) -> DataFrame:
    schema = ("path string, row_count bigint, sha256 string, file_size_bytes bigint, "
              "product_id_column string, content binary, order_date string, order_month string")
    try:
        return spark.read.schema(schema).parquet(store)
    except AnalysisException as error:  # nothing preserved yet
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def kept_on(spark: SparkSession, store: str, days: list[str]) -> DataFrame:
    """What the store keeps for some dates."""
    months = sorted({day[:7] for day in days})
    return _kept(spark, store).where(F.col("order_month").isin(months) & F.col("order_date").isin(days))


def _outcome(checked: DataFrame, store: str) -> DataFrame:
    """Checked captures with the message that preserving them would raise.

    The bytes kept for the delivered dates are hashed anew. Months select folders of the store, dates the
    parts of its files, so other dates are not read. What is known of each date is written first: as many
    rows as the calendar has, so that deliveries need not be shuffled to meet them.
    """
    facts = checked.where("error_message is null")
    first = staged(first_delivered(facts), "capture-first")
    days = [r["order_date"] for r in first.select("order_date").collect()]
    kept = kept_on(checked.sparkSession, store, days).select("order_date", F.sha2("content", 256).alias("sha256"), F.col("sha256").alias("recorded_sha256"))
    judged = classify_captures(facts, staged(kept, "capture-kept"), first=first).select(*checked.columns, "capture_state")
    state, day = F.col("capture_state"), F.col("order_date")
    message = (
        F.when(state == "conflict", F.format_string(K.MSG_KEPT_OTHER, day))
        .when(state == "missing_file", F.format_string(K.MSG_KEPT_MISSING, day))
        .when(state == "checksum_mismatch", F.format_string(K.MSG_SIDECAR, F.concat(day, F.lit("/orders.csv"))))
    )
    failed = checked.where("error_message is not null").withColumn("capture_state", F.lit(None).cast("string"))
    return judged.withColumn("error_message", message).unionByName(failed)


def preserve_captures(files: DataFrame, store: str) -> DataFrame:
    """Check deliveries and append the new ones to the immutable capture store.

    The store is a table with one row per date, partitioned by month: a folder
    per date would hold a single small file. A delivery already kept with the
    same bytes is a no-op, with other bytes a failure that leaves the kept one
    alone. Returns one checked row per delivery.
    """
    checked = staged(check_captures(files, K.MAX_CAPTURE_BYTES), "capture-checked")
    outcome = staged(_outcome(checked, store), "capture-outcome")
    fresh = staged(outcome.where("error_message is null and capture_state = 'new'").select(*PRESERVED), "capture-fresh")
    (
        files.select("path", "content").join(fresh, "path")
        .withColumn("order_month", F.substring("order_date", 1, 7))
        .sortWithinPartitions("order_month", "order_date")
        .write.mode("append").partitionBy("order_month").parquet(store)
    )
    return outcome


def run_ingestion(files: DataFrame, store: str, log: str, now: datetime | None = None) -> DataFrame:
    """Preserve deliveries and log a success or a failure for each, once."""
    moment = now or datetime.now(timezone.utc)
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    moment = moment.astimezone(timezone.utc)
    outcome = preserve_captures(files, store)
    append_audit(A.ingestion_events(
        outcome, F.lit(moment.isoformat()), F.lit(moment.date().isoformat())), log)
    return outcome


def replay(spark: SparkSession, root: str, log: str, now: datetime | None = None) -> DataFrame:
    """Re-check every landed ``<date>/orders.csv`` and log what the log lacks.

    Reads only: a file in the wrong folder, or one that its sidecar does not
    vouch for, is reported, never copied. Returns the numbers of valid and failed captures.
    """
    moment = (now or datetime.now(timezone.utc)).isoformat()
    checked = check_sidecars(check_captures(read_captures(spark, root)), read_sidecars(spark, root))
    checked = staged(check_folder(checked), "replay-checked")
    append_audit(A.ingestion_events(
        checked, F.lit(moment), folder_date(F.col("path"))), log)
    return A.replay_summary(checked)


def weather_requests(stores: DataFrame, weather: DataFrame, target_date) -> DataFrame:
    """Requests still to be made for one date."""
    pending = missing_stores(stores_with_coordinates(stores), cached_stores(weather, target_date))
    return request_plan(pending.withColumn("date", F.lit(target_date).cast("date")))


def weather_backfill(sold: DataFrame, stores: DataFrame, weather: DataFrame) -> DataFrame:
    """Requests still to be made for every captured date on which a store sold (``store_id, order_date``)."""
    return request_plan(backfill_plan(sold, stores_with_coordinates(stores), weather))


def run_daily(files: DataFrame, store: str, log: str, on_captured=None, rebuild=None,
              now: datetime | None = None) -> bool:
    """Capture, then hand the captured dates to the weather step and rebuild.

    ``on_captured`` receives a DataFrame of order dates. Nothing follows a
    failed capture; without ``on_captured`` only the capture runs.
    """
    outcome = run_ingestion(files, store, log, now)
    if not outcome.where("error_message is not null").isEmpty():
        return False
    if on_captured:
        on_captured(outcome.select("order_date").distinct())
        if rebuild:
            rebuild()
    return True


__all__ = ["preserve_captures", "preserved_manifest", "replay", "run_daily",
           "run_ingestion", "weather_backfill", "weather_requests"]
