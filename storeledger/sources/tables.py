"""Stores, weather and the audit log, from JDBC, catalog tables or files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import AUDIT_FIELDS, STORE_COLUMNS, WEATHER_COLUMNS
from ..schemas import AUDIT_LOG
from .captures import read_text_csv


def read_table(spark: SparkSession, name: str, columns=None, jdbc: dict | None = None) -> DataFrame:
    """A catalog table, or a JDBC table when connection options are given."""
    source = (
        spark.read.format("jdbc").options(**jdbc).option("dbtable", name).load()
        if jdbc else spark.table(name)
    )
    return source.select(*columns) if columns else source


def read_stores(spark: SparkSession, name: str = "stores", jdbc: dict | None = None) -> DataFrame:
    return read_table(spark, name, STORE_COLUMNS, jdbc)


def read_weather(
    spark: SparkSession, name: str = "store_weather_daily", jdbc: dict | None = None
) -> DataFrame:
    return read_table(spark, name, WEATHER_COLUMNS, jdbc)


def read_tables(spark: SparkSession, names, jdbc: dict | None = None) -> dict[str, DataFrame]:
    """Full scans of several tables; without JDBC options absent tables raise at once."""
    if not jdbc:
        known = {t.name for t in spark.catalog.listTables()}
        absent = sorted(set(names) - known)
        if absent:
            raise ValueError(f"Tables not found: {', '.join(absent)}")
    return {name: read_table(spark, name, jdbc=jdbc) for name in names}


def stores_with_coordinates(stores: DataFrame) -> DataFrame:
    return stores.select("store_id", "latitude", "longitude").where(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    )


def cached_stores(weather: DataFrame, target_date) -> DataFrame:
    """Stores that already have weather for one date; the filter reaches the source."""
    return weather.where(F.col("date") == F.lit(target_date).cast("date")).select("store_id")


def read_audit_log(spark: SparkSession, path) -> DataFrame:
    """The audit log as text; fields that are absent or empty become ''."""
    return blank_to_empty(read_text_csv(spark, path, AUDIT_LOG))


def blank_to_empty(log: DataFrame) -> DataFrame:
    return log.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in AUDIT_FIELDS])


def typed_audit_log(log: DataFrame) -> DataFrame:
    """Counts written as ``104`` or ``104.0`` and both timestamp forms, typed."""
    empty = {c: F.nullif(F.col(c), F.lit("")) for c in AUDIT_FIELDS}
    stamp = F.to_timestamp(F.replace(empty["timestamp_utc"], F.lit("T"), F.lit(" ")))
    return log.select(
        stamp.alias("timestamp_utc"),
        empty["order_date"].cast("date").alias("order_date"),
        "status",
        empty["row_count"].cast("double").cast("bigint").alias("row_count"),
        empty["file_size_bytes"].cast("double").cast("bigint").alias("file_size_bytes"),
        empty["sha256"].alias("sha256"),
        empty["error_message"].alias("error_message"),
        F.coalesce(empty["sort_date"].cast("date"), empty["order_date"].cast("date"),
                   F.to_date(stamp)).alias("sort_date"),
    )
