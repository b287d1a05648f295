"""Crosswalk build: validate both masters, propose, write proposals and summary."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.crosswalk import crosswalk_summary, propose_crosswalk
from ..operators.quality import require_products
from ..sinks.files import write_report, write_sorted_csv
from ..staging import staged

LEGACY_REQUIRED = ("product_id", "product_name", "brand", "base_price")
NEW_REQUIRED = ("new_product_id", "item_name", "brand_name", "msrp")


def build_crosswalk(legacy: DataFrame, new: DataFrame) -> DataFrame:
    require_products(legacy, LEGACY_REQUIRED, "product_id")
    require_products(new, NEW_REQUIRED, "new_product_id")
    return propose_crosswalk(new, legacy)


def write_crosswalk(legacy: DataFrame, new: DataFrame, folder: str, summary: str) -> DataFrame:
    proposals = staged(build_crosswalk(legacy, new), "proposals")
    write_sorted_csv(proposals, folder, ("new_product_id",))
    write_report(crosswalk_summary(new, legacy, proposals), summary)
    return proposals
