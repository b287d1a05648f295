"""Explicit schemas; nothing is inferred when reading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .constants import AUDIT_FIELDS, STORE_COLUMNS

MONEY = T.DecimalType(18, 2)
# Prices and rates as landed, with more decimals than money has.
PRECISE = T.DecimalType(28, 10)


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


AUDIT_LOG = strings(*AUDIT_FIELDS)
LEGACY_PRODUCTS = strings(
    "product_id", "product_name", "category", "subcategory", "brand",
    "base_price", "margin_rate", "launch_date", "active",
)
NEW_PRODUCTS = strings(
    "new_product_id", "item_name", "department", "class", "brand_name",
    "msrp", "gross_margin", "launch_date", "active",
)
CANONICAL_CROSSWALK = strings(
    "legacy_product_id", "canonical_product_id", "canonical_product_name",
)
REVIEW_REGISTER = strings(
    "new_product_id", "new_product_name", "proposed_legacy_product_id",
    "match_score", "canonical_legacy_product_id", "review_decision",
    "review_basis", "reviewed_on",
)
STORES = T.StructType(
    [T.StructField(n, T.StringType()) for n in STORE_COLUMNS[:6]]
    + [T.StructField(n, T.DoubleType()) for n in STORE_COLUMNS[6:]]
)
WEATHER = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("temperature_2m_max_c", T.DecimalType(8, 3)),
    T.StructField("temperature_2m_min_c", T.DecimalType(8, 3)),
    T.StructField("precipitation_sum_mm", T.DecimalType(10, 3)),
    T.StructField("source", T.StringType()),
])


def require_columns(df: DataFrame, required, label: str) -> DataFrame:
    """Raise when a required column is absent; extra columns are fine."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{label} are missing columns: {', '.join(missing)}")
    return df
