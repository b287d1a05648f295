"""Data-quality gates: measure as DataFrames, raise only at the edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import QualityError
from ..schemas import require_columns

SAMPLE = 20  # rows quoted in an error text; the error keeps all rows as a DataFrame


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key values that occur more than once; nulls are a value like any other."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def require_none(rows: DataFrame, message: str) -> None:
    """Raise when any row exists, quoting the first few in order and how many there are."""
    sample = rows.orderBy(*[F.col(c) for c in rows.columns]).limit(SAMPLE).collect()
    if sample:
        shown = "; ".join(", ".join(str(v) for v in r) for r in sample)
        more = f"; ... ({rows.count()} in all)" if len(sample) == SAMPLE else ""
        raise QualityError(f"{message} {shown}{more}", rows)


def require_unique(df: DataFrame, keys, message: str) -> DataFrame:
    """The right side of a many-to-one join must be unique, or the join would fan out."""
    require_none(duplicate_keys(df, keys), message)
    return df


def require_unique_crosswalk(crosswalk: DataFrame) -> DataFrame:
    require_unique(crosswalk, "canonical_product_id",
                   "Crosswalk contains duplicate canonical product IDs:")
    require_unique(crosswalk.where("legacy_product_id is not null"), "legacy_product_id",
                   "Crosswalk contains duplicate legacy product IDs:")
    return crosswalk


def product_input_checks(products: DataFrame, id_column: str) -> DataFrame:
    """Row count, blank ids and repeated ids of a product table, as one row."""
    from ..functions.text import trim_ws

    per_id = products.groupBy(id_column).agg(F.count(F.lit(1)).alias("n"))
    blank = F.col(id_column).isNull() | (trim_ws(F.col(id_column).cast("string")) == "")
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("blank_ids"),
        F.count_if(F.col("n") > 1).alias("repeated_ids"),
    )


def require_products(products: DataFrame, required, id_column: str) -> DataFrame:
    require_columns(products, required, "Product data")
    found = product_input_checks(products, id_column).first()
    if not found["row_count"]:
        raise QualityError("Product data contains no rows.")
    if found["blank_ids"]:
        raise QualityError(f"Product data contains a blank {id_column}.")
    if found["repeated_ids"]:
        raise QualityError(f"Product data contains duplicate {id_column} values.")
    return products


def any_null(*columns: str) -> Column:
    test = F.col(columns[0]).isNull()
    for name in columns[1:]:
        test = test | F.col(name).isNull()
    return test


def missing_dates(present: DataFrame, column: str) -> DataFrame:
    """Days without a row between the first and the last day seen."""
    days = present.select(F.col(column).cast("date").alias("missing_date")).distinct()
    spine = days.agg(F.min("missing_date").alias("lo"), F.max("missing_date").alias("hi")).where(
        "lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("missing_date"))
    return spine.join(days, "missing_date", "left_anti")


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, as a union."""
    result = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        result = part if result is None else result.unionByName(part)
    return result
