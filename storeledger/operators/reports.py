"""Reports answered from the gold table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def headline_totals(gold: DataFrame) -> DataFrame:
    """Net sales, and the number of days, stores and products sold."""
    return gold.agg(
        F.sum("net_sales").cast("double").alias("net_sales"),
        F.count_distinct("order_date").alias("days"),
        F.count_distinct("store_id").alias("stores"),
        F.count_distinct("canonical_product_id").alias("products"),
    )


def daily_sales_trend(gold: DataFrame) -> DataFrame:
    return gold.groupBy("order_date").agg(F.sum("net_sales").cast("double").alias("net_sales"))


def daily_trend_scaled(gold: DataFrame) -> DataFrame:
    """Daily net sales scaled to 0..1 between the lowest and the highest day, peak marked."""
    trend = daily_sales_trend(gold)
    lo = trend.agg(F.min("net_sales")).scalar()
    hi = trend.agg(F.max("net_sales")).scalar()
    peak = trend.agg(F.min_by("order_date", F.struct(-F.col("net_sales"), "order_date"))).scalar()
    ends = trend.withColumns({"lo": lo, "hi": hi, "peak": peak})
    width = F.col("hi") - F.col("lo")
    return ends.select(
        "order_date", "net_sales",
        F.when(width == 0, 0.0).otherwise((F.col("net_sales") - F.col("lo")) / width).alias("scaled"),
        (F.col("order_date") == F.col("peak")).alias("is_peak"),
    )


def sales_vs_precipitation(gold: DataFrame) -> DataFrame:
    """Store-days, mean daily sales on wet and dry days, and their correlation, per store."""
    days = gold.where("precipitation_sum_mm is not null").groupBy("store_id", "order_date").agg(
        F.sum("net_sales").cast("double").alias("sales"),
        F.max("precipitation_sum_mm").cast("double").alias("rain"))
    wet = F.col("rain") > 0
    return days.groupBy("store_id").agg(
        F.count_if(wet).alias("wet_days"), F.count_if(~wet).alias("dry_days"),
        F.avg(F.when(wet, F.col("sales"))).alias("wet_sales"),
        F.avg(F.when(~wet, F.col("sales"))).alias("dry_sales"),
        F.corr("rain", "sales").alias("correlation"))


def category_by_region(gold: DataFrame, top: int | None = None) -> DataFrame:
    """Sales per region and category, ranked inside the region; optionally the top few."""
    sums = gold.groupBy("region", "canonical_category").agg(
        F.sum("net_sales").cast("double").alias("net_sales"),
        F.sum("units_sold").alias("units_sold"))
    place = F.rank().over(Window.partitionBy("region").orderBy(F.desc("net_sales")))
    ranked = sums.withColumn("sales_rank", place)
    return ranked.where(F.col("sales_rank") <= top) if top else ranked


def joined_lines(lines: DataFrame, stores: DataFrame, products: DataFrame, how: str) -> DataFrame:
    """Order lines with store and product names (inner, or left to keep every line)."""
    return (
        lines.join(stores.select("store_id", "store_name"), "store_id", how)
        .join(products.select("product_id", "product_name"), "product_id", how)
        .select("order_id", "store_id", "product_id", "store_name", "product_name")
    )


def preview(df: DataFrame, order_by, n: int) -> DataFrame:
    """First rows by a stated order; Spark itself has none."""
    return df.orderBy(*order_by).limit(n)
