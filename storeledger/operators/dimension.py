"""Product dimension and comparisons of product masters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import PRODUCT_ATTRIBUTES, UNKNOWN_LABELS
from ..schemas import require_columns


def product_dimension(crosswalk: DataFrame, legacy: DataFrame, new: DataFrame) -> DataFrame:
    """One row per canonical product: new products, approved ids the master lacks,
    and legacy products nothing replaced. Uniqueness is checked by the caller."""
    require_columns(crosswalk, ("legacy_product_id", "canonical_product_id",
                                "canonical_product_name"), "crosswalk")
    require_columns(legacy, ("product_id", "product_name", "brand", "category",
                             "subcategory"), "legacy products")
    require_columns(new, ("new_product_id", "item_name", "brand_name", "department",
                          "class"), "new products")
    approved = crosswalk.select(
        "canonical_product_id", F.col("canonical_product_name").alias("_approved"))
    known = new.select(
        F.col("new_product_id").alias("canonical_product_id"),
        F.col("item_name").alias("_item"),
        F.col("brand_name").alias("canonical_brand"),
        F.col("department").alias("canonical_category"),
        F.col("class").alias("canonical_subcategory"),
    ).join(approved, "canonical_product_id", "left").withColumn(
        "canonical_product_name", F.coalesce("_approved", "_item"))
    absent = crosswalk.select("canonical_product_id", "canonical_product_name").join(
        new.select(F.col("new_product_id").alias("canonical_product_id")),
        "canonical_product_id", "left_anti",
    ).withColumns({name: F.lit(label) for name, label in UNKNOWN_LABELS.items()})
    columns = ["canonical_product_id", *PRODUCT_ATTRIBUTES]
    return (
        known.select(*columns)
        .unionByName(absent.select(*columns))
        .unionByName(unmatched_legacy(crosswalk, legacy).select(*columns))
    )


def unmatched_legacy(crosswalk: DataFrame, legacy: DataFrame) -> DataFrame:
    """Legacy products no canonical product replaces, under their own id."""
    mapped = crosswalk.where("legacy_product_id is not null").select(
        F.col("legacy_product_id").alias("product_id"))
    return legacy.join(mapped, "product_id", "left_anti").select(
        F.col("product_id").alias("canonical_product_id"),
        F.col("product_name").alias("canonical_product_name"),
        F.col("brand").alias("canonical_brand"),
        F.col("category").alias("canonical_category"),
        F.col("subcategory").alias("canonical_subcategory"),
    )


def schema_diff(legacy: DataFrame, new: DataFrame) -> DataFrame:
    """Columns removed, added and retained between two snapshots, from their schemas."""
    old, now = set(legacy.columns), set(new.columns)
    rows = [(c, "retained" if c in now else "removed") for c in old]
    rows += [(c, "added") for c in now - old]
    return legacy.sparkSession.createDataFrame(sorted(rows), "column_name string, change string")


def attribute_value_diff(
    legacy: DataFrame, new: DataFrame, renamed: dict[str, str]
) -> DataFrame:
    """Values of each renamed attribute found on one side only.

    ``renamed`` maps the legacy column to the new one. All attributes are
    compared in one aggregate: one row per (attribute, value).
    """
    def unpivot(df, columns, side):
        pairs = F.explode(F.array(*[
            F.struct(F.lit(name).alias("attribute"),
                     F.col(column).cast("string").alias("value"))
            for name, column in columns
        ]))
        return df.select(pairs.alias("p")).select("p.*", F.lit(side).alias("is_new"))

    sides = unpivot(legacy, [(k, k) for k in renamed], False).unionByName(
        unpivot(new, list(renamed.items()), True))
    return (
        sides.where("value is not null").groupBy("attribute", "value")
        .agg(F.min("is_new").alias("lo"), F.max("is_new").alias("hi"))
        .where("lo = hi")
        .select("attribute", "value",
                F.when(F.col("lo"), "new_only").otherwise("legacy_only").alias("side"))
    )
