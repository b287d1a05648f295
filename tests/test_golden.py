"""Published figures of a real lake, checked when its folder is given.

Set RETAIL_LAKE_DIR to a folder with bronze/orders/<date>/orders.csv,
bronze/products/<date>, bronze/ingestion_log.csv and silver crosswalk files.
"""

import os

import pytest
from pyspark.sql import functions as F

from storeledger import schemas
from storeledger.operators import audit, capture_rules, dimension, gold, review, silver
from storeledger.operators.crosswalk import crosswalk_summary
from storeledger.operators.quality import missing_dates
from storeledger.plans.build import build_silver
from storeledger.plans.crosswalk import build_crosswalk
from storeledger.sources import captures, orders, tables

LAKE = os.environ.get("RETAIL_LAKE_DIR")
pytestmark = pytest.mark.skipif(not LAKE, reason="RETAIL_LAKE_DIR is not set")
LAST = "2026-08-09"


@pytest.fixture(scope="module")
def products(spark):
    return captures.read_latest_products(spark, f"{LAKE}/bronze/products")


@pytest.fixture(scope="module")
def crosswalk(spark):
    return captures.read_text_csv(
        spark, f"{LAKE}/silver/canonical_product_crosswalk.csv", schemas.CANONICAL_CROSSWALK)


@pytest.fixture(scope="module")
def reviews(spark):
    return captures.read_text_csv(
        spark, f"{LAKE}/silver/product_crosswalk_review.csv", schemas.REVIEW_REGISTER)


@pytest.fixture(scope="module")
def lines(spark):
    return orders.read_orders(spark, f"{LAKE}/bronze/orders")


@pytest.fixture(scope="module")
def silver_table(lines, crosswalk, products):
    return build_silver(lines, crosswalk, *products).cache()


def test_both_readers_agree(spark, lines):
    direct = orders.read_order_lines_text(captures.read_captures(spark, f"{LAKE}/bronze/orders"))
    assert lines.count() == direct.count() == 4775
    typed = silver.type_orders(lines), silver.type_orders(direct)
    assert typed[0].exceptAll(typed[1]).isEmpty() and typed[1].exceptAll(typed[0]).isEmpty()


def test_silver_and_gold_totals(silver_table, lines):
    early = silver_table.where(F.col("order_date") <= LAST)
    assert lines.where(F.col("order_date") <= LAST).count() == 2856
    assert early.count() == 2852 and silver_table.count() == 4771
    daily = gold.daily_sales(gold.normalize_silver(early), gold.K.PRODUCT_ATTRIBUTES)
    total = gold.totals(daily, "units_sold", "gold").first()
    assert (total["gold_rows"], total["gold_units"], total["gold_net_sales"]) == (2586, 5608.0, 1057816.16)
    seen = daily.agg(F.count_distinct("order_date"), F.count_distinct("store_id"),
                     F.count_distinct("canonical_product_id")).first()
    assert tuple(seen) == (23, 8, 86)
    by_day = daily.groupBy("order_date").agg(F.sum("net_sales").cast("double").alias("s"))
    assert by_day.agg(F.max("s")).first()[0] == 66393.19
    everything = gold.totals(gold.daily_sales(gold.normalize_silver(silver_table)), "units_sold", "g").first()
    assert tuple(everything) == (4299, 9424.0, 1754322.32)


def test_unknown_product_and_missing_dates(silver_table):
    unknown = silver_table.where("canonical_product_name = 'Unknown Product (NP9999)'")
    assert [tuple(r) for r in unknown.groupBy(F.col("order_date").cast("string")).count().collect()] == [("2026-07-30", 4)]
    days = missing_dates(silver_table.where(F.col("order_date") <= LAST), "order_date")
    assert sorted(str(r[0]) for r in days.collect()) == [
        "2026-07-13", "2026-07-24", "2026-07-25", "2026-08-03", "2026-08-06", "2026-08-08"]
    assert set(silver.silver_invariants(silver_table).first()) == {0}


def test_captures_checksums_and_audit(spark):
    files = captures.read_captures(spark, f"{LAKE}/bronze/orders")
    checked = capture_rules.check_folder(capture_rules.check_captures(files)).cache()
    assert {r["status"]: r["capture_count"] for r in audit.replay_summary(checked).collect()} == {"valid": 38}
    by_key = checked.groupBy("product_id_column").agg(F.count("*"), F.min("order_date"), F.max("order_date"))
    assert {tuple(r) for r in by_key.collect()} == {
        ("product_id", 13, "2026-07-12", "2026-07-27"), ("new_product_id", 25, "2026-07-28", "2026-08-24")}
    states = captures.verify_checksums(captures.manifest(files), captures.read_sidecars(spark, f"{LAKE}/bronze/orders"))
    assert [tuple(r) for r in states.groupBy("checksum_state").count().collect()] == [("match", 38)]
    for name in ("products.csv", "new_products.csv"):
        masters = captures.read_captures(spark, f"{LAKE}/bronze/products", name)
        found = captures.verify_checksums(
            captures.manifest(masters), captures.read_sidecars(spark, f"{LAKE}/bronze/products", name))
        assert [r["checksum_state"] for r in found.collect()] == ["mismatch"]
    log = tables.read_audit_log(spark, f"{LAKE}/bronze/ingestion_log.csv")
    assert {r[0]: r[1] for r in log.groupBy("status").count().collect()} == {"success": 42, "failure": 5}
    assert audit.audit_gaps(checked, log).isEmpty()
    typed = tables.typed_audit_log(log)
    assert typed.where("timestamp_utc is null or sort_date is null").isEmpty()
    assert typed.where("status = 'success' and row_count is null").isEmpty()
    # The whole log is known already, so replaying every capture adds nothing.
    events = audit.ingestion_events(checked, F.lit("2026-09-01T00:00:00+00:00"), F.lit("2026-09-01"))
    assert audit.events_to_append(events, log).isEmpty()


def test_crosswalk_equals_the_published_one(spark, products, crosswalk, reviews):
    legacy, new = products
    got = build_crosswalk(legacy, new).cache()
    columns = got.columns
    want = spark.read.option("header", True).csv(f"{LAKE}/silver/product_crosswalk.csv")
    want = want.select(*[F.col(c).cast(got.schema[c].dataType).alias(c) for c in columns])
    assert got.exceptAll(want).collect() == [] and want.exceptAll(got).collect() == []
    summary = crosswalk_summary(new, legacy, got).first()
    assert summary["status_counts"] == {"exact_name_match": 60, "review_required": 20}
    assert set(review.review_rules(got, reviews).first()) == {0}
    assert {r[0]: r[1] for r in review.review_outcomes(reviews).collect()} == {
        "accepted": 14, "no_legacy_predecessor": 5, "corrected": 1}
    built = review.apply_review(got, reviews)
    assert built.exceptAll(crosswalk).isEmpty() and crosswalk.exceptAll(built).isEmpty()
    assert review.review_alignment(reviews, crosswalk).isEmpty()
    gone = dimension.unmatched_legacy(crosswalk, legacy).select("canonical_product_id")
    assert sorted(r[0] for r in gone.collect()) == ["P1069", "P1071", "P1073", "P1074", "P1075"]
    ranked = review.collision_price_rank(got, new, legacy).where("is_closest")
    decided = reviews.select("new_product_id", "canonical_legacy_product_id")
    kept = ranked.join(decided, "new_product_id").where(
        F.col("canonical_legacy_product_id") == F.col("proposed_legacy_product_id"))
    assert kept.count() == ranked.count()


def test_schema_and_attribute_differences(products):
    legacy, new = products
    change = {}
    for r in dimension.schema_diff(legacy, new).collect():
        change.setdefault(r["change"], []).append(r["column_name"])
    assert change["retained"] == ["active", "launch_date"]
    assert change["removed"] == ["base_price", "brand", "category", "margin_rate", "product_id",
                                 "product_name", "subcategory"]
    diff = dimension.attribute_value_diff(
        legacy, new, {"brand": "brand_name", "category": "department", "subcategory": "class"})
    found = {}
    for r in diff.collect():
        found.setdefault((r["attribute"], r["side"]), set()).add(r["value"])
    assert found[("brand", "new_only")] == {"Blue Ridge Outdoor Works", "Moss and Mile", "RTO House Brand"}
    assert found[("category", "legacy_only")] == {"emergency", "hydration", "outerwear"}
    assert found[("subcategory", "new_only")] == {"power storage", "waterproof outerwear"}
