"""A small lake, written here: snapshots, masters as text, the audit log, crosswalk files, stores."""

import json
import os

import pytest

from storeledger import constants as K
from storeledger import schemas
from storeledger.errors import CaptureError, QualityError
from storeledger.operators import audit, dimension, silver
from storeledger.operators.crosswalk import crosswalk_summary
from storeledger.plans.crosswalk import build_crosswalk, write_crosswalk
from storeledger.sources import captures, tables

LEGACY = "﻿product_id,product_name,category,subcategory,brand,base_price,margin_rate,launch_date,active\n" + "".join(
    f'{i},"{n}",c,s,{b},{p},0.3,2024-01-01,true\n' for i, n, b, p in (("007", "Rake, long", "Norvik", "12.50"), ("P2", "Oar", "Tarn", "40.00"), ("P3", "Mug", "Tarn", "5.00")))
NEW = "new_product_id,item_name,department,class,brand_name,msrp,gross_margin,launch_date,active\n" + "".join(
    f'{i},"{n}",c,s,{b},{p},0.3,2024-01-01,true\n' for i, n, b, p in (("N1", "Rake Long", "Norvik", "13.00"), ("N2", "Oar Duo", "Tarn", "41.00"), ("N3", "Oar", "Tarn", "39.00")))


def put(folder, day, name, content):
    os.makedirs(f"{folder}/{day}", exist_ok=True)
    with open(f"{folder}/{day}/{name}", "w", encoding="utf-8", newline="") as out:
        out.write(content)


@pytest.fixture()
def masters(spark, folder):
    for day in ("2025-03-01", "2025-03-02"):
        put(folder, day, "products.csv", LEGACY if day > "2025-03-01" else LEGACY.replace("Rake", "Hoe"))
        put(folder, day, "new_products.csv", NEW)
    put(folder, "2025-03-03", "products.csv", LEGACY.replace("Rake", "Saw"))  # incomplete
    put(folder, "notes", "products.csv", "x")
    return captures.read_latest_products(spark, folder)


def test_newest_complete_snapshot_as_text(spark, folder, masters):
    legacy, new = masters
    assert {r["product_id"]: (r["product_name"], r["base_price"]) for r in legacy.collect()} == {
        "007": ("Rake, long", "12.50"), "P2": ("Oar", "40.00"), "P3": ("Mug", "5.00")}
    assert sorted(r["new_product_id"] for r in new.collect()) == ["N1", "N2", "N3"]
    os.makedirs(f"{folder}/other/2025-01-01")
    put(f"{folder}/other", "2025-01-01", "products.csv", LEGACY)
    with pytest.raises(CaptureError, match="No complete product snapshot"):
        captures.read_latest_products(spark, f"{folder}/other")


def test_schemas_of_two_masters(masters):
    change = {r["column_name"]: r["change"] for r in dimension.schema_diff(*masters).collect()}
    assert {c for c, x in change.items() if x == "retained"} == {"launch_date", "active"}
    assert change["margin_rate"] == "removed" and change["msrp"] == "added"
    assert len(change) == len(schemas.LEGACY_PRODUCTS.names) + len(schemas.NEW_PRODUCTS.names) - 2


def test_crosswalk_files(spark, folder, masters):
    legacy, new = masters
    proposals = write_crosswalk(legacy, new, f"{folder}/crosswalk", f"{folder}/summary")
    written = spark.read.option("header", True).csv(f"{folder}/crosswalk").collect()
    assert [r["new_product_id"] for r in sorted(written, key=lambda r: r["new_product_id"])] == ["N1", "N2", "N3"]
    chosen = {r["new_product_id"]: (r["proposed_legacy_product_id"], r["match_status"]) for r in proposals.collect()}
    # "oar" is proposed twice, so even the equal name goes to review
    assert chosen == {"N1": ("007", K.EXACT_MATCH), "N2": ("P2", K.NEEDS_REVIEW), "N3": ("P2", K.NEEDS_REVIEW)}
    lines = [json.loads(line) for name in os.listdir(f"{folder}/summary") if name.startswith("part") for line in open(f"{folder}/summary/{name}")]
    assert len(lines) == 1 and (lines[0]["legacy_rows"], lines[0]["new_rows"]) == (3, 3)
    assert lines[0]["status_counts"] == {K.EXACT_MATCH: 1, K.NEEDS_REVIEW: 2} and lines[0]["scoring"] == {"name": 0.7, "brand": 0.2, "price": 0.1}
    assert crosswalk_summary(new, legacy, proposals).first()["note"] == lines[0]["note"]
    with pytest.raises(QualityError):
        build_crosswalk(legacy.unionByName(legacy.limit(1)), new)


def test_audit_log_as_text_and_typed(spark, folder):
    rows = [
        "2025-03-31T02:37:00+00:00,2025-03-30,success,104,20000,ab,,2025-03-30",
        "2025-03-31 02:37:00+00:00,2025-03-31,success,7.0,900,cd,,2025-03-31",
        '2025-04-01T00:10:00+00:00,,failure,,,,"down, again",2025-04-01',
        "2025-04-02T00:10:00+00:00,,failure,,,,late,",
    ]
    put(folder, "log", "ingestion_log.csv", "\n".join([",".join(K.AUDIT_FIELDS), *rows]) + "\n")
    log = tables.read_audit_log(spark, f"{folder}/log/ingestion_log.csv")
    assert log.where(" or ".join(f"{c} is null" for c in K.AUDIT_FIELDS)).isEmpty()
    typed = {str(r["timestamp_utc"])[:10] + r["sha256"] if r["sha256"] else r["error_message"]: r for r in tables.typed_audit_log(log).collect()}
    assert [typed[k]["row_count"] for k in ("2025-03-31ab", "2025-03-31cd")] == [104, 7]
    assert typed["2025-03-31ab"]["timestamp_utc"] == typed["2025-03-31cd"]["timestamp_utc"]
    assert str(typed["late"]["sort_date"]) == "2025-04-02" and typed["down, again"]["file_size_bytes"] is None
    facts = spark.createDataFrame([("2025-03-30", "ab"), ("2025-03-31", "zz")], "order_date string, sha256 string")
    assert [tuple(r) for r in audit.audit_gaps(facts, log).collect()] == [("2025-03-31", "zz")]


def test_duplicates_are_counted(spark):
    rows = [("a", "2025-01-01", 1), ("a", "2025-01-01", 1), ("a", "2025-01-01", 2), ("b", "2025-01-02", 1), (None, None, None), (None, None, None), (None, None, None)]
    found = silver.duplicate_counts(spark.createDataFrame(rows, "order_id string, order_date string, quantity int"), "order_date")
    assert {r["order_date"]: tuple(r)[1:] for r in found.collect()} == {"2025-01-01": (3, 2, 1), "2025-01-02": (1, 1, 0), None: (3, 1, 2)}
