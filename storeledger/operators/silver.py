"""Typing, de-duplication and product resolution of order lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PRODUCT_ATTRIBUTES, SILVER_COLUMNS, UNKNOWN_LABELS
from ..frames import side_by_side
from ..functions.text import null_tokens, parse_currency, trim_ws, unknown_label
from ..schemas import MONEY, PRECISE

# target column -> (clean-up of the landed text, type)
_TYPED = {
    "order_id": (null_tokens, "string"),
    "order_date": (lambda c: null_tokens(trim_ws(c)), "date"),
    "store_id": (null_tokens, "string"),
    "product_id": (null_tokens, "string"),
    "new_product_id": (null_tokens, "string"),
    "quantity": (lambda c: null_tokens(trim_ws(c)), "int"),
    "unit_price": (parse_currency, PRECISE.simpleString()),
    "discount_pct": (lambda c: null_tokens(trim_ws(c)), PRECISE.simpleString()),
    "sales_channel": (null_tokens, "string"),
    "loyalty_member": (null_tokens, "string"),
}


def _wide(text: Column, strict: bool) -> Column:
    return text.cast("decimal(38,18)") if strict else text.try_cast("decimal(38,18)")


def _typed(name: str, kind: str) -> Column:
    """The value of cleaned text; a bad one, or a number that ``kind`` cannot hold as it is, fails the job (ANSI casts)."""
    text = F.col(name)
    if kind in ("string", "date"):
        return text.cast(kind)
    wide = F.col(f"_wide_{name}")
    held = wide.cast(kind)
    return F.when(wide.isNull() | (held == wide), held).otherwise(
        F.raise_error(F.concat(F.lit("Not a value of type "), F.lit(kind), F.lit(": "), text)).cast(kind))


def _fits(text: Column, kind: str) -> Column:
    if kind in ("string", "date"):
        return text.try_cast(kind).isNotNull()
    wide = _wide(text, False)
    return F.coalesce(wide.try_cast(kind) == wide, F.lit(False))


def type_orders(lines: DataFrame) -> DataFrame:
    """Type landed text strictly: a bad date or number fails the job, none is rounded."""
    # Clean texts and wide numbers are columns of their own, so that each is made once.
    cleaned = lines.select(*[clean(F.col(name)).alias(name) for name, (clean, _) in _TYPED.items()])
    wide = {f"_wide_{name}": _wide(F.col(name), True) for name, (_, kind) in _TYPED.items() if kind not in ("string", "date")}
    return cleaned.withColumns(wide).select(*[_typed(name, kind).alias(name) for name, (_, kind) in _TYPED.items()])


def quarantine_orders(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed rows, landed rows that do not fit their types, with the columns at fault)."""
    faults = F.filter(
        F.array(*[
            F.when(clean(F.col(n)).isNotNull() & ~_fits(clean(F.col(n)), kind), n)
            for n, (clean, kind) in _TYPED.items() if kind != "string"
        ]),
        lambda fault: fault.isNotNull(),
    )
    marked = lines.withColumn("_faults", faults)
    return (
        type_orders(marked.where(F.size("_faults") == 0).drop("_faults")),
        marked.where(F.size("_faults") > 0),
    )


def drop_exact_duplicates(orders: DataFrame) -> DataFrame:
    """Collapse fully identical rows; copies meet in the map-side aggregate first."""
    return orders.dropDuplicates()


def duplicate_counts(orders: DataFrame, by: str = "order_date") -> DataFrame:
    """Per date, rows landed, rows kept and the copies removed, in the one pass that removes them."""
    copies = orders.groupBy(*orders.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.groupBy(by).agg(
        F.sum("_copies").alias("landed_rows"), F.count(F.lit(1)).alias("kept_rows"),
        (F.sum("_copies") - F.count(F.lit(1))).alias("removed_rows"))


def conflicting_ids(orders: DataFrame, key: str = "order_id") -> DataFrame:
    """Ids that still cover more than one distinct row; null ids do not count."""
    return (
        orders.where(F.col(key).isNotNull())
        .groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
        .where("row_count > 1")
    )


def resolve_canonical(orders: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Canonical id: the mapped legacy id, else the new id, else the legacy id.

    ``crosswalk`` must be unique on the legacy id (see ``quality.require_unique``).
    """
    mapping = crosswalk.where("legacy_product_id is not null").select(
        F.col("legacy_product_id").alias("_legacy"),
        F.col("canonical_product_id").alias("_mapped"),
    )
    # Lines without a legacy id match nothing; their order id keeps them from gathering in one task.
    dealt = F.coalesce("product_id", F.concat(F.lit("\0"), "order_id"))
    same = (F.col("product_id") == F.col("_legacy")) & (dealt == F.col("_legacy"))
    return (
        orders.join(mapping, same, "left")
        .withColumn("canonical_product_id", F.coalesce("_mapped", "new_product_id", "product_id"))
        .drop("_legacy", "_mapped")
    )


def unresolved(orders: DataFrame) -> DataFrame:
    return orders.where("canonical_product_id is null").select(
        "order_id", "product_id", "new_product_id")


def fill_unknown(orders: DataFrame) -> DataFrame:
    """Label products the dimension does not know; each attribute on its own."""
    filled = {
        "canonical_product_name": F.coalesce(
            "canonical_product_name", unknown_label(F.col("canonical_product_id"))),
    }
    for name, label in UNKNOWN_LABELS.items():
        filled[name] = F.coalesce(name, F.lit(label))
    return orders.withColumns(filled)


def add_net_sales(orders: DataFrame) -> DataFrame:
    """Quantity times price. The price already is the selling price, so no discount."""
    return orders.withColumn(
        "net_sales", (F.col("quantity") * F.col("unit_price")).cast(MONEY))


def enrich(orders: DataFrame, dimension: DataFrame) -> DataFrame:
    """Attach product attributes (dimension unique on the canonical id)."""
    joined = orders.join(
        dimension.select("canonical_product_id", *PRODUCT_ATTRIBUTES),
        "canonical_product_id", "left")
    return add_net_sales(fill_unknown(joined)).select(*SILVER_COLUMNS)


def silver_invariants(silver: DataFrame) -> DataFrame:
    """One row of counts that are all zero for a sound silver table."""
    repeated = conflicting_ids(silver).agg(F.count(F.lit(1)).alias("duplicate_order_ids"))
    unknown = F.startswith(F.col("canonical_product_name"), F.lit("Unknown Product ("))
    missing = silver.agg(
        F.count_if(unknown & F.col("canonical_product_id").isNull()).alias("unknown_without_id"),
        F.count_if(F.col("canonical_product_name").isNull()).alias("missing_names"),
        F.count_if(F.col("canonical_brand").isNull() | F.col("canonical_category").isNull()
                   | F.col("canonical_subcategory").isNull()).alias("missing_attributes"),
    )
    return side_by_side(repeated, missing)
