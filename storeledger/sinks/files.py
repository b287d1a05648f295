"""File outputs: sorted CSV exports, JSON reports, snapshots, audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..constants import AUDIT_FIELDS
from ..operators.audit import event_key, events_to_append
from ..schemas import AUDIT_LOG
from ..staging import staged

LOG_MONTH = "log_month"


def write_sorted_csv(df: DataFrame, folder: str, keys, single_file: bool = False) -> None:
    """CSV with a header, ordered over all part files, nulls last.

    ``orderBy`` ranges the rows over tasks by sampled keys; one file is only for
    results known to be small.
    """
    ordered = df.orderBy(*[F.asc_nulls_last(k) for k in keys])
    if single_file:
        ordered = ordered.coalesce(1)
    ordered.write.mode("overwrite").option("header", True).option("quote", '"').option(
        "escape", '"').csv(folder)


def write_by_date(df: DataFrame, folder: str, keys, date: str = "order_date", whole: bool = False) -> None:
    """Parquet partitioned by date; a rerun replaces only the dates it holds, or with ``whole`` the folder.

    Rows are ranged by date and keys, so a busy date spreads over several files.
    """
    (
        df.repartitionByRange(date, *keys).sortWithinPartitions(date, *keys)
        .write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(date).parquet(folder)
    )


def write_report(report: DataFrame, folder: str) -> None:
    """A one-row report as JSON; null fields are written too."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(folder)


def write_snapshot(df: DataFrame, folder: str) -> DataFrame:
    """A snapshot that is never overwritten, returned with the hash of each file."""
    df.write.mode("errorifexists").option("header", True).csv(folder)
    files = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    return files.select("path", F.sha2("content", 256).alias("sha256"), "length")


def log_month(events: DataFrame) -> DataFrame:
    """``events`` with the month of the date they are logged under, which names their folder in the log."""
    keyed = event_key(events.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in AUDIT_FIELDS]))
    month = F.substring("key_date", 1, 7)
    return keyed.select(*AUDIT_FIELDS, F.when(month == "", "undated").otherwise(month).alias(LOG_MONTH))


def logged(spark: SparkSession, folder: str, months: list[str] | None = None) -> DataFrame:
    """The events of a log, of some months only if these are given; none if nothing is logged yet."""
    try:
        log = spark.read.schema(f"{AUDIT_LOG.toDDL()}, {LOG_MONTH} string").option("header", True).csv(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], AUDIT_LOG)
    return (log if months is None else log.where(F.col(LOG_MONTH).isin(months))).select(*AUDIT_FIELDS)


def append_audit(events: DataFrame, folder: str) -> int:
    """Append the events not logged yet; returns how many were appended.

    An event can only repeat one that is logged under its own date, so only the
    months that ``events`` touch are read. Appending the same events again adds nothing.
    """
    spark = events.sparkSession
    named = staged(log_month(events), "audit-events")
    months = [r[LOG_MONTH] for r in named.select(LOG_MONTH).distinct().collect()]  # as many as the calendar has
    fresh = staged(log_month(events_to_append(named, logged(spark, folder, months))), "audit-append")
    added = fresh.count()
    if added:
        fresh.repartition(LOG_MONTH).write.mode("append").partitionBy(LOG_MONTH).option("header", True).csv(folder)
    return added


def read_audit_folder(spark: SparkSession, folder: str) -> DataFrame:
    from ..sources.tables import blank_to_empty

    return blank_to_empty(logged(spark, folder))


__all__ = ["append_audit", "read_audit_folder", "write_by_date",
           "write_report", "write_snapshot", "write_sorted_csv"]
