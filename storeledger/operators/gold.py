"""Aggregation to the declared grain, dimension joins and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..frames import side_by_side
from ..functions.text import trim_ws
from ..schemas import MONEY, require_columns
from .quality import any_null

REQUIRED = ("order_id", *K.GRAIN, *K.PRODUCT_ATTRIBUTES, "quantity", "net_sales")
_TRIMMED = ("store_id", "canonical_product_id", "canonical_product_name")


def normalize_silver(silver: DataFrame) -> DataFrame:
    """Check columns, trim keys and names, and type the measures strictly."""
    require_columns(silver, REQUIRED, "Silver orders")
    return silver.withColumns({
        **{c: trim_ws(F.col(c).cast("string")) for c in _TRIMMED},
        "order_date": F.col("order_date").cast("date"),
        "net_sales": F.col("net_sales").cast(MONEY),
    })


def product_attributes(orders: DataFrame) -> DataFrame:
    """Distinct attribute tuples per product; a sound table has one each."""
    return orders.select("canonical_product_id", *K.PRODUCT_ATTRIBUTES).distinct()


def attribute_conflicts(orders: DataFrame) -> DataFrame:
    """Products with more than one attribute tuple."""
    return (
        product_attributes(orders).groupBy("canonical_product_id")
        .agg(F.count(F.lit(1)).alias("variant_count")).where("variant_count > 1")
    )


def daily_sales(orders: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Distinct orders, units and net sales per date, store and product.

    Null keys form groups. Spark pre-aggregates per (grain, order) before the
    shuffle, so a hot date, store or product does not meet in one task.
    ``carry`` names columns the product determines; they ride in the key, which
    saves a second scan and a join.
    """
    return orders.groupBy(*K.GRAIN, *carry).agg(
        F.count_distinct("order_id").alias("order_count"),
        F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("units_sold"),
        F.coalesce(F.sum("net_sales"), F.lit(0)).cast(MONEY).alias("net_sales"),
    )


def attach_products(daily: DataFrame, attributes: DataFrame) -> DataFrame:
    """Attributes per product; null ids match null ids."""
    right = attributes.withColumnRenamed("canonical_product_id", "_product")
    return daily.join(
        right, F.col("canonical_product_id").eqNullSafe(F.col("_product")), "left"
    ).drop("_product")


def attach_stores(daily: DataFrame, stores: DataFrame) -> DataFrame:
    """Store attributes and ``has_store``; null ids match null ids."""
    right = stores.select(
        trim_ws(F.col("store_id")).alias("_store"), *K.STORE_COLUMNS[1:],
        F.lit(True).alias("_hit"))
    return (
        daily.join(right, F.col("store_id").eqNullSafe(F.col("_store")), "left")
        .withColumn("has_store", F.coalesce("_hit", F.lit(False))).drop("_store", "_hit")
    )


def attach_weather(daily: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather of the store on the day and ``has_weather``; nulls match nulls."""
    right = weather.select(
        trim_ws(F.col("store_id")).alias("_store"),
        F.col("date").cast("date").alias("_date"),
        *K.WEATHER_MEASURES, "source", F.lit(True).alias("_hit"))
    return (
        daily.join(
            right,
            F.col("store_id").eqNullSafe(F.col("_store"))
            & F.col("order_date").eqNullSafe(F.col("_date")), "left")
        .withColumn("has_weather", F.coalesce("_hit", F.lit(False)))
        .drop("_store", "_date", "_hit")
    )


def assemble(orders: DataFrame, stores: DataFrame, weather: DataFrame) -> DataFrame:
    """Gold rows with the coverage flags ``has_store`` and ``has_weather``.

    The attributes travel with the grain: once ``attribute_conflicts`` is empty
    that equals joining them back, and if it is not, the grain check shows it.
    """
    daily = daily_sales(orders, K.PRODUCT_ATTRIBUTES)
    return attach_weather(attach_stores(daily, stores), weather)


def gold_table(assembled: DataFrame) -> DataFrame:
    return assembled.select(*K.GOLD_COLUMNS)


def duplicate_grain(gold: DataFrame) -> DataFrame:
    """How many rows share their grain with another row, all members counted."""
    return gold.groupBy(*K.GRAIN).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_grain_rows"))


def totals(df: DataFrame, units: str, prefix: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias(f"{prefix}_rows"),
        F.coalesce(F.sum(units), F.lit(0)).cast("double").alias(f"{prefix}_units"),
        F.coalesce(F.sum("net_sales"), F.lit(0)).cast("double").alias(f"{prefix}_net_sales"),
    )


def reconcile(orders: DataFrame, gold: DataFrame) -> DataFrame:
    """Units and sales before and after aggregation, with their differences."""
    both = side_by_side(totals(orders, "quantity", "silver"), totals(gold, "units_sold", "gold"))
    return with_differences(both)


def with_differences(both: DataFrame) -> DataFrame:
    return both.withColumns({
        "units_difference": F.round(F.col("gold_units") - F.col("silver_units"), 6),
        "net_sales_difference": F.round(
            F.col("gold_net_sales") - F.col("silver_net_sales"), 2),
    })


def validation_report(orders: DataFrame, assembled: DataFrame, table: str) -> DataFrame:
    """The one-row report of the pre-publish gate.

    The grain is re-counted per key and every other measure rides on the same
    aggregate, so gold is read once: sums and conditional counts per grain,
    then over all grains.
    """
    flags = {
        "missing_store_rows": ~F.col("has_store"),
        "missing_weather_rows": ~F.col("has_weather"),
        "missing_product_name_rows": F.col("canonical_product_name").isNull(),
        "missing_product_attribute_rows": any_null(*K.PRODUCT_ATTRIBUTES[1:]),
    }
    per_grain = assembled.groupBy(*K.GRAIN).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("units_sold").alias("units"), F.sum("net_sales").alias("sales"),
        *[F.count_if(test).alias(name) for name, test in flags.items()],
    )
    gold = per_grain.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("gold_rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_grain_rows"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in flags],
        F.coalesce(F.sum("units"), F.lit(0)).cast("double").alias("gold_units"),
        F.coalesce(F.sum("sales"), F.lit(0)).cast("double").alias("gold_net_sales"),
    )
    report = with_differences(side_by_side(totals(orders, "quantity", "silver"), gold))
    return report.select(
        F.lit(table).alias("gold_table"),
        F.array(*[F.lit(c) for c in K.GRAIN]).alias("grain"),
        "silver_rows", "gold_rows", *K.REPORT_GATES,
        "silver_units", "gold_units", "units_difference",
        "silver_net_sales", "gold_net_sales", "net_sales_difference",
        F.lit(None).cast("bigint").alias("sql_rows"),
        F.lit(None).cast("bigint").alias("sql_csv_row_count_difference"),
        prepublish_passed().alias("prepublish_passed"),
        F.lit(False).alias("validation_passed"),
    )


def prepublish_passed():
    """All seven conditions that must hold before anything is published."""
    test = (F.abs("units_difference") < K.UNITS_TOLERANCE) & (
        F.abs("net_sales_difference") < K.SALES_TOLERANCE)
    for name in K.REPORT_GATES:
        test = test & (F.col(name) == 0)
    return test
