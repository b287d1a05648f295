"""Gold queries: grain, joins, conflicts, reconciliation, publishing."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import gold as G
from ..session import shared_folder
from ..sinks.tables import row_parity
from . import testbed as T
from .lines import _edge

TABLE = "daily_sales_weather"


def _orders(spark, sf):
    return G.normalize_silver(T.silver_lines(spark, sf))


def _assembled(spark, sf):
    return G.assemble(_orders(spark, sf), T.nation_stores(spark, sf), T.weather(spark, sf))


def gold_daily_sales(spark, sf):
    return _edge(G.gold_table(_assembled(spark, sf)))


def gold_store_join(spark, sf):
    joined = G.attach_stores(
        G.daily_sales(_orders(spark, sf)), T.nation_stores(spark, sf))
    return _edge(joined.select(*K.GRAIN, "store_name", "region", "has_store"))


def gold_product_join(spark, sf):
    orders = _orders(spark, sf)
    joined = G.attach_products(G.daily_sales(orders), G.product_attributes(orders))
    return _edge(joined.select(*K.GRAIN, *K.PRODUCT_ATTRIBUTES, "net_sales"))


def gold_weather_join(spark, sf):
    joined = G.attach_weather(G.daily_sales(_orders(spark, sf)), T.weather(spark, sf))
    return _edge(joined.select(*K.GRAIN, *K.WEATHER_MEASURES, "has_weather"))


def gold_validation_report(spark, sf):
    report = G.validation_report(_orders(spark, sf), _assembled(spark, sf), TABLE)
    return report.drop("grain", "sql_rows", "sql_csv_row_count_difference")


def reconcile_totals(spark, sf):
    orders = _orders(spark, sf)
    return G.reconcile(orders, G.daily_sales(orders))


def attribute_conflicts(spark, sf):
    """Part names as product ids: the same name is sold under many attributes."""
    lines = T.table(spark, sf, "part").select(
        F.col("p_name").alias("canonical_product_id"), F.upper("p_name").alias("canonical_product_name"),
        F.col("p_brand").alias("canonical_brand"), F.col("p_type").alias("canonical_category"),
        F.col("p_size").alias("canonical_subcategory"))
    return G.attribute_conflicts(lines)


def duplicate_grain_rows(spark, sf):
    """Unaggregated lines against the grain: how many share theirs."""
    return G.duplicate_grain(_orders(spark, sf))


def publish_parity(spark, sf):
    """Daily sales written to a table and counted again there."""
    daily = G.daily_sales(_orders(spark, sf))
    folder = f"{shared_folder(spark)}/storeledger/published-{uuid4().hex}"
    daily.write.parquet(folder)
    return row_parity(daily, spark.read.schema(daily.schema).parquet(folder))


_GOLD_EDGE = ", ".join(
    "strftime(order_date, '%Y-%m-%d') AS order_date" if c == "order_date"
    else f"CAST({c} AS DOUBLE) AS {c}" if c in ("net_sales", *K.WEATHER_MEASURES) else c
    for c in K.GOLD_COLUMNS)
_GRAIN_EDGE = "strftime(order_date, '%Y-%m-%d') AS order_date, store_id, canonical_product_id"

QUERIES = {
    "gold_daily_sales": (gold_daily_sales, f"WITH {T.GOLD} SELECT {_GOLD_EDGE} FROM gold"),
    "gold_store_join": (gold_store_join, f"WITH {T.GOLD} SELECT {_GRAIN_EDGE}, store_name, region, has_store FROM gold"),
    "gold_product_join": (gold_product_join, f"""WITH {T.GOLD} SELECT {_GRAIN_EDGE}, canonical_product_name, canonical_brand, canonical_category,
        canonical_subcategory, CAST(net_sales AS DOUBLE) AS net_sales FROM gold"""),
    "gold_weather_join": (gold_weather_join, f"""WITH {T.GOLD} SELECT {_GRAIN_EDGE}, CAST(temperature_2m_max_c AS DOUBLE) AS temperature_2m_max_c,
        CAST(temperature_2m_min_c AS DOUBLE) AS temperature_2m_min_c, CAST(precipitation_sum_mm AS DOUBLE) AS precipitation_sum_mm, has_weather FROM gold"""),
    "gold_validation_report": (gold_validation_report, f"""WITH {T.GOLD},
        s AS (SELECT count(*) AS silver_rows, CAST(sum(quantity) AS DOUBLE) AS silver_units, CAST(sum(net_sales) AS DOUBLE) AS silver_net_sales FROM silver),
        g AS (SELECT count(*) AS gold_rows, count(*) - count(DISTINCT (order_date, store_id, canonical_product_id)) AS duplicate_grain_rows,
          count(*) FILTER (WHERE NOT has_store) AS missing_store_rows, count(*) FILTER (WHERE NOT has_weather) AS missing_weather_rows,
          count(*) FILTER (WHERE canonical_product_name IS NULL) AS missing_product_name_rows,
          count(*) FILTER (WHERE canonical_brand IS NULL OR canonical_category IS NULL OR canonical_subcategory IS NULL) AS missing_product_attribute_rows,
          CAST(sum(units_sold) AS DOUBLE) AS gold_units, CAST(sum(net_sales) AS DOUBLE) AS gold_net_sales FROM gold)
        SELECT '{TABLE}' AS gold_table, s.*, g.*, round(gold_units - silver_units, 6) AS units_difference,
          round(gold_net_sales - silver_net_sales, 2) AS net_sales_difference,
          (duplicate_grain_rows + missing_store_rows + missing_weather_rows + missing_product_name_rows + missing_product_attribute_rows) = 0 AS prepublish_passed,
          false AS validation_passed FROM s, g"""),
    "reconcile_totals": (reconcile_totals, f"""WITH {T.SILVER}, s AS (SELECT count(*) AS silver_rows, CAST(sum(quantity) AS DOUBLE) AS silver_units,
          CAST(sum(net_sales) AS DOUBLE) AS silver_net_sales FROM silver),
        g AS (SELECT count(*) AS gold_rows, CAST(sum(u) AS DOUBLE) AS gold_units, CAST(sum(n) AS DOUBLE) AS gold_net_sales FROM (
          SELECT sum(quantity) AS u, sum(net_sales) AS n FROM silver GROUP BY order_date, store_id, canonical_product_id))
        SELECT s.*, g.*, round(gold_units - silver_units, 6) AS units_difference, round(gold_net_sales - silver_net_sales, 2) AS net_sales_difference FROM s, g"""),
    "attribute_conflicts": (attribute_conflicts, """SELECT p_name AS canonical_product_id, count(*) AS variant_count
        FROM (SELECT DISTINCT p_name, p_brand, p_type, p_size FROM part) GROUP BY 1 HAVING count(*) > 1"""),
    "duplicate_grain_rows": (duplicate_grain_rows, f"""WITH {T.SILVER} SELECT CAST(sum(n) AS BIGINT) AS duplicate_grain_rows FROM (
        SELECT count(*) AS n FROM silver GROUP BY order_date, store_id, canonical_product_id HAVING count(*) > 1)"""),
    "publish_parity": (publish_parity, f"""WITH {T.SILVER}, d AS (SELECT DISTINCT order_date, store_id, canonical_product_id FROM silver)
        SELECT count(*) AS source_rows, count(*) AS sql_rows, 0 AS sql_csv_row_count_difference, true AS validation_passed FROM d"""),
}
