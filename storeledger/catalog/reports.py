"""Reports and joins over the gold table, and the capture stream."""

from __future__ import annotations

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import functions as F

from ..operators import reports as R
from ..session import shared_folder
from ..operators.audit import event_key
from ..sinks.files import read_audit_folder
from ..streaming.capture_stream import audit_stream, take_in
from . import testbed as T
from .gold import _assembled
from .lines import _edge

RUN_TIME = datetime(2026, 7, 31, 2, 37, tzinfo=timezone.utc)


def headline_totals(spark, sf):
    return R.headline_totals(_assembled(spark, sf))


def daily_sales_trend(spark, sf):
    return _edge(R.daily_sales_trend(_assembled(spark, sf)))


def daily_trend_scaled(spark, sf):
    return _edge(R.daily_trend_scaled(_assembled(spark, sf)))


def sales_vs_precipitation(spark, sf):
    found = R.sales_vs_precipitation(_assembled(spark, sf))
    return found.select("store_id", "wet_days", "dry_days",
                        *[F.round(c, 4).alias(c) for c in ("wet_sales", "dry_sales", "correlation")])


def category_by_region(spark, sf):
    return R.category_by_region(_assembled(spark, sf))


def _sold(spark, sf):
    lines = T.landed_lines(spark, sf)
    return lines.withColumn("product_id", F.coalesce(
        "product_id", F.concat(F.lit("P"), F.substring("new_product_id", 3, 20))))


def orders_stores_products(spark, sf):
    return R.joined_lines(
        _sold(spark, sf), T.supplier_stores(spark, sf), T.legacy_products(spark, sf), "inner")


def joined_preview(spark, sf):
    # Stores and products are unique, so the first lines can be taken before they are joined.
    first = R.preview(_sold(spark, sf), ["order_id"], 5)
    return R.preview(R.joined_lines(
        first, T.supplier_stores(spark, sf), T.legacy_products(spark, sf), "left"), ["order_id"], 5)


def stream_capture(spark, sf):
    """All order captures as a stream: checked, preserved once per date, logged."""
    rows = T.table(spark, sf, "lineitem").schema
    stream = spark.readStream.schema(rows).option("pathGlobFilter", "lineitem.parquet").parquet(sf)
    folder = f"{shared_folder(spark)}/storeledger/stream-{uuid4().hex}"
    # The stream reads a single file, hence one split: deal its rows over the cores.
    dealt = stream.repartition(spark.sparkContext.defaultParallelism, "l_orderkey", "l_linenumber")
    take_in(T.captures_of(dealt), f"{folder}/store", f"{folder}/log", f"{folder}/checkpoint",
            lambda: RUN_TIME)
    return read_audit_folder(spark, f"{folder}/log").select(
        "order_date", "status", "row_count", "sha256", "error_message", "sort_date")


def audit_event_stream(spark, sf):
    """All events as a file stream of audit rows; each event key passes once."""
    schema = T.table(spark, sf, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    log = _events_as_log_stream(source)
    folder = f"{shared_folder(spark)}/storeledger/stream-{uuid4().hex}"
    audit_stream(log, f"{folder}/out", f"{folder}/checkpoint")
    return event_key(read_audit_folder(spark, f"{folder}/out")).select("key_status", "key_date", "key_text")


def _events_as_log_stream(events):
    ok = F.col("event_type") != "error"
    day = T.text_day("ts")
    return events.select(
        F.col("ts").cast("string").alias("timestamp_utc"), F.when(ok, "success").otherwise("failure").alias("status"), day.alias("order_date"),
        F.lit("1").alias("row_count"), F.lit("10").alias("file_size_bytes"), F.sha2("props", 256).alias("sha256"),
        F.col("props").alias("error_message"), day.alias("sort_date"))


_DAYS = f"""WITH {T.GOLD}, days AS (SELECT strftime(order_date, '%Y-%m-%d') AS order_date, CAST(sum(net_sales) AS DOUBLE) AS net_sales FROM gold GROUP BY 1)"""

QUERIES = {
    "headline_totals": (headline_totals, f"""WITH {T.GOLD} SELECT CAST(sum(net_sales) AS DOUBLE) AS net_sales, count(DISTINCT order_date) AS days,
        count(DISTINCT store_id) AS stores, count(DISTINCT canonical_product_id) AS products FROM gold"""),
    "daily_sales_trend": (daily_sales_trend, f"{_DAYS} SELECT * FROM days"),
    "daily_trend_scaled": (daily_trend_scaled, f"""{_DAYS} SELECT order_date, net_sales,
        (net_sales - min(net_sales) OVER ()) / (max(net_sales) OVER () - min(net_sales) OVER ()) AS scaled,
        row_number() OVER (ORDER BY net_sales DESC, order_date) = 1 AS is_peak FROM days"""),
    "sales_vs_precipitation": (sales_vs_precipitation, f"""WITH {T.GOLD}, d AS (SELECT store_id, order_date, CAST(sum(net_sales) AS DOUBLE) AS sales,
          CAST(max(precipitation_sum_mm) AS DOUBLE) AS rain FROM gold WHERE precipitation_sum_mm IS NOT NULL GROUP BY 1, 2)
        SELECT store_id, count(*) FILTER (WHERE rain > 0) AS wet_days, count(*) FILTER (WHERE NOT rain > 0) AS dry_days,
          round(avg(sales) FILTER (WHERE rain > 0), 4) AS wet_sales, round(avg(sales) FILTER (WHERE NOT rain > 0), 4) AS dry_sales,
          round(corr(rain, sales), 4) AS correlation FROM d GROUP BY 1"""),
    "category_by_region": (category_by_region, f"""WITH {T.GOLD}, c AS (SELECT region, canonical_category, CAST(sum(net_sales) AS DOUBLE) AS net_sales,
          CAST(sum(units_sold) AS BIGINT) AS units_sold FROM gold GROUP BY 1, 2)
        SELECT *, rank() OVER (PARTITION BY region ORDER BY net_sales DESC) AS sales_rank FROM c"""),
    "orders_stores_products": (orders_stores_products, f"""WITH {T.LINES}, {T.SUPPLIER_STORES}, {T.PRODUCTS}
        SELECT l.order_id, l.store_id, p.product_id, s.store_name, p.product_name FROM lines l JOIN stores s USING (store_id)
        JOIN legacy_products p ON p.product_id = coalesce(l.product_id, 'P' || substr(l.new_product_id, 3))"""),
    "joined_preview": (joined_preview, f"""WITH {T.LINES}, {T.SUPPLIER_STORES}, {T.PRODUCTS}
        SELECT l.order_id, l.store_id, coalesce(l.product_id, 'P' || substr(l.new_product_id, 3)) AS product_id, s.store_name, p.product_name
        FROM lines l LEFT JOIN stores s USING (store_id)
        LEFT JOIN legacy_products p ON p.product_id = coalesce(l.product_id, 'P' || substr(l.new_product_id, 3))
        ORDER BY order_id LIMIT 5"""),
    "stream_capture": (stream_capture, f"""WITH {T.CHECKED}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY order_date ORDER BY path) AS n, first_value(sha256) OVER (PARTITION BY order_date ORDER BY path) AS first_sha
          FROM checked WHERE error_message IS NULL AND path LIKE 'landing/%')
        SELECT order_date, 'success' AS status, CAST(row_count AS VARCHAR) AS row_count, sha256, '' AS error_message, order_date AS sort_date FROM ranked WHERE n = 1
        UNION ALL SELECT DISTINCT '', 'failure', '', '', order_date || ' already has different contents; it was not overwritten.', '2026-07-31' FROM ranked WHERE sha256 <> first_sha
        UNION ALL SELECT DISTINCT '', 'failure', '', '', error_message, '2026-07-31' FROM checked WHERE error_message IS NOT NULL AND path LIKE 'landing/%'"""),
    "audit_event_stream": (audit_event_stream, """SELECT DISTINCT CASE WHEN event_type <> 'error' THEN 'success' ELSE 'failure' END AS key_status,
        strftime(ts, '%Y-%m-%d') AS key_date, CASE WHEN event_type <> 'error' THEN sha256(props) ELSE props END AS key_text FROM events"""),
}
