"""Silver, gold, dimension, weather, review and writers on small fixtures."""

import contextlib
import io
import json
import os
import re
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from storeledger import constants as K
from storeledger import schemas
from storeledger.catalog import testbed
from storeledger.errors import QualityError
from storeledger.frames import spread
from storeledger.functions.text import parse_currency, trim_ws
from storeledger.operators import dimension, gold, quality, review, silver, weather
from storeledger.operators.reports import category_by_region, daily_trend_scaled
from storeledger.plans import build, capture
from storeledger.sinks import files, tables
from storeledger.sources import captures
from storeledger.sources import tables as source
from storeledger.sources.orders import BRONZE_COLUMNS, union_variants

LINE = ", ".join(f"{c} string" for c in BRONZE_COLUMNS)


def line(oid, day="2026-07-31", store="S1", old=None, new=None, qty="1", price="10.00"):
    return (oid, day, store, old, new, qty, price, "0", "pickup", "N")


@pytest.fixture(scope="module")
def masters(spark):
    crosswalk = spark.createDataFrame(
        [("P1", "NP1", "Approved One"), (None, "NP2", "Brand New"), ("P3", "NP9", "Gone From Master")],
        schemas.CANONICAL_CROSSWALK)
    legacy = spark.createDataFrame(
        [(f"P{i}", f"Old {i}", "cat", "sub", "Acme", "1.0", "0.1", "2020-01-01", "Y") for i in (1, 3, 4)],
        schemas.LEGACY_PRODUCTS)
    new = spark.createDataFrame(
        [(f"NP{i}", f"Item {i}", "dep", "cls", "Acme", "1.0", "0.1", "2020-01-01", "Y") for i in (1, 2, 5)],
        schemas.NEW_PRODUCTS)
    return crosswalk, legacy, new


def test_prices_and_white_space(spark):
    df = spark.createDataFrame([("$72.70",), (" $1,234.56 ",), ("58.07",), ("",), ("NA",)], "t string")
    got = [r[0] for r in df.select(parse_currency(F.col("t")).cast("decimal(18,2)")).collect()]
    assert got == [Decimal("72.70"), Decimal("1234.56"), Decimal("58.07"), None, None]
    odd = [" a b ", "\t x\x1f", "\x85y　", "", "z"]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    assert [r[0] for r in df.select(trim_ws(F.col("t"))).collect()] == [t.strip() for t in odd]


def test_typing_is_strict_or_quarantines(spark):
    bad = spark.createDataFrame([line("1", price="twelve"), line("2"), line("3", qty="x", day="31.07.2026")], LINE)
    with pytest.raises(PySparkException):
        silver.type_orders(bad).collect()
    good, rejected = silver.quarantine_orders(bad)
    assert [r["order_id"] for r in good.collect()] == ["2"]
    assert {r["order_id"]: r["_faults"] for r in rejected.collect()} == {"1": ["unit_price"], "3": ["order_date", "quantity"]}


def test_union_of_variants(spark):
    old = spark.createDataFrame([line("1", old="P1")], LINE).drop("new_product_id")
    new = spark.createDataFrame([line("2", new="NP1")], LINE).drop("product_id").select(
        *reversed([c for c in BRONZE_COLUMNS if c != "product_id"]))
    rows = {r["order_id"]: (r["product_id"], r["new_product_id"], r["unit_price"]) for r in union_variants(old, new).collect()}
    assert rows == {"1": ("P1", None, "10.00"), "2": (None, "NP1", "10.00")}


def test_dimension(spark, masters):
    rows = {r[0]: tuple(r)[1:] for r in dimension.product_dimension(*masters).collect()}
    assert rows == {
        "NP1": ("Approved One", "Acme", "dep", "cls"), "NP2": ("Brand New", "Acme", "dep", "cls"),
        "NP5": ("Item 5", "Acme", "dep", "cls"),
        "NP9": ("Gone From Master", "Unknown Brand", "Unknown Category", "Unknown Subcategory"),
        "P4": ("Old 4", "Acme", "cat", "sub")}
    with pytest.raises(ValueError, match="legacy products are missing columns: brand"):
        dimension.product_dimension(masters[0], masters[1].drop("brand"), masters[2])


def test_silver_build(spark, masters):
    lines = spark.createDataFrame([
        line("1", old="P1", price="$72.70", qty="2"), line("1", old="P1", price="72.70", qty="2"),
        line("2", old="P3"), line("3", old="P4"), line("4", new="NP2"), line("5", new="NP7", qty="3", price="$1,000.10"),
        line("6", old="P8")], LINE)
    rows = {r["order_id"]: r for r in build.build_silver(lines, *masters).collect()}
    assert {k: r["canonical_product_id"] for k, r in rows.items()} == {
        "1": "NP1", "2": "NP9", "3": "P4", "4": "NP2", "5": "NP7", "6": "P8"}
    assert rows["5"]["canonical_product_name"] == "Unknown Product (NP7)"
    assert rows["6"]["canonical_brand"] == "Unknown Brand"
    assert rows["1"]["net_sales"] == Decimal("145.40") and rows["5"]["net_sales"] == Decimal("3000.30")
    assert tuple(rows["1"].asDict()) == K.SILVER_COLUMNS


def test_silver_gates(spark, masters):
    conflict = spark.createDataFrame([line("1", new="NP1"), line("1", new="NP2"), line(None, new="NP1")], LINE)
    with pytest.raises(QualityError, match="Conflicting rows remain") as caught:
        build.build_silver(conflict, *masters)
    assert caught.value.rows.count() == 1
    with pytest.raises(QualityError, match="no canonical product ID"):
        build.build_silver(spark.createDataFrame([line("1")], LINE), *masters)
    twice = masters[0].unionByName(spark.createDataFrame([("P1", "NP8", "x")], schemas.CANONICAL_CROSSWALK))
    with pytest.raises(QualityError, match="duplicate legacy"):
        build.build_silver(spark.createDataFrame([line("1", new="NP1")], LINE), twice, *masters[1:])
    clash = masters[2].unionByName(masters[2].limit(1))
    with pytest.raises(QualityError, match="duplicate canonical"):
        build.build_silver(spark.createDataFrame([line("1", new="NP1")], LINE), *masters[:2], clash)


STORES = [("S1 ", "One", "Town", "TN", "East", "mall", 48.21, 16.37), ("S2", "Two", "City", "TN", "West", "mall", None, None)]


@pytest.fixture(scope="module")
def dims(spark):
    cached = spark.createDataFrame([("S1", "2026-07-31", "17.5"), ("S2", "2026-07-31", "30"), ("S1", "2026-08-01", None)],
                                   "store_id string, d string, t string").select(
        "store_id", F.col("d").cast("date").alias("date"), F.col("t").cast("decimal(8,3)").alias("temperature_2m_max_c"),
        F.lit(None).cast("decimal(8,3)").alias("temperature_2m_min_c"),
        F.lit(0).cast("decimal(10,3)").alias("precipitation_sum_mm"), F.lit("open-meteo").alias("source"))
    return spark.createDataFrame(STORES, schemas.STORES), cached


def silver_rows(spark, rows):
    return spark.createDataFrame(rows, "order_id string, order_date string, store_id string, canonical_product_id string, quantity int, net_sales double").withColumns({
        "canonical_product_name": F.concat(F.lit(" name "), "canonical_product_id"), "canonical_brand": F.lit("b"),
        "canonical_category": F.lit("c"), "canonical_subcategory": F.lit("s")})


def test_gold_grain_joins_and_report(spark, dims):
    orders = silver_rows(spark, [
        ("1", "2026-07-31", " S1", "NP1", 2, 10.5), ("1", "2026-07-31", "S1", "NP1 ", 1, 1.25), ("2", "2026-07-31", "S1", "NP1", None, None),
        ("3", "2026-08-02", "S2", "NP1", 1, 2.0), ("4", "2026-07-31", None, "NP2", 4, 8.0), ("5", "2026-07-31", "S7", "NP2", 1, 1.0)])
    rows, report = build.build_gold(orders, *dims, "sales")
    got = {(str(r["order_date"]), r["store_id"], r["canonical_product_id"]): r for r in rows.collect()}
    assert len(got) == 4 and tuple(rows.columns) == K.GOLD_COLUMNS
    first = got[("2026-07-31", "S1", "NP1")]
    assert (first["order_count"], first["units_sold"], first["net_sales"]) == (2, 3, Decimal("11.75"))
    assert (first["store_name"], first["temperature_2m_max_c"], first["canonical_product_name"]) == ("One", Decimal("17.500"), "name NP1")
    r = report.first()
    assert (r["silver_rows"], r["gold_rows"], r["missing_store_rows"], r["missing_weather_rows"]) == (6, 4, 2, 3)
    assert (r["units_difference"], r["net_sales_difference"], r["prepublish_passed"]) == (0.0, 0.0, False)


def test_gold_conflicts(spark, dims):
    orders = silver_rows(spark, [("1", "2026-07-31", "S1", "NP1", 2, 10.5), ("2", "2026-07-31", "S1", "NP1", 2, 10.5)])
    mixed = orders.withColumn("canonical_brand", F.col("order_id"))
    with pytest.raises(QualityError, match="conflicting attributes"):
        build.build_gold(mixed, *dims, "sales")
    with pytest.raises(QualityError, match="Stores are not unique"):
        build.build_gold(orders, dims[0].unionByName(dims[0]), dims[1], "sales")
    with pytest.raises(ValueError, match="Silver orders are missing columns: quantity"):
        build.build_gold(orders.drop("quantity"), *dims, "sales")
    assert gold.duplicate_grain(orders).first()[0] == 2
    assert gold.attribute_conflicts(mixed).first()["variant_count"] == 2


def test_rebuild_publishes_or_stops(spark, masters, dims, folder):
    lines = spark.createDataFrame([line("1", old="P1"), line("2", new="NP2", store="S2", qty="2")], LINE)
    spark.sql("DROP TABLE IF EXISTS sales_gold")
    final = build.rebuild(lines, *masters, *dims, folder, "sales_gold").first()
    assert final["validation_passed"] and final["sql_rows"] == 2 and spark.table("sales_gold").count() == 2
    assert spark.read.option("header", True).csv(f"{folder}/gold/sales_gold_csv").count() == 2
    late = lines.unionByName(spark.createDataFrame([line("3", day="2026-08-02", new="NP2")], LINE))
    with pytest.raises(QualityError, match="before publishing"):
        build.rebuild(late, *masters, *dims, folder, "sales_gold")
    assert spark.table("sales_gold").count() == 2  # nothing was published
    part = next(n for n in os.listdir(f"{folder}/gold/validation") if n.endswith(".json"))
    with open(f"{folder}/gold/validation/{part}") as report:
        saved = json.load(report)
    assert saved["missing_weather_rows"] == 1 and saved["sql_rows"] is None and not saved["validation_passed"]
    spark.sql("DROP TABLE sales_gold")


def payload(daily):
    return json.dumps({"daily": daily} if daily is not None else {})


def test_weather_payloads(spark):
    good = {"time": ["2026-07-30", "2026-07-31"], "temperature_2m_max": [1, 17.5], "temperature_2m_min": [1, None], "precipitation_sum": [0, 4.5]}
    cases = [good, None, {**good, "time": ["2026-07-30"]}, {**good, "precipitation_sum": [0]}, {k: v for k, v in good.items() if k != "temperature_2m_min"}]
    df = spark.createDataFrame([(str(i), "2026-07-31", payload(c)) for i, c in enumerate(cases)] + [("x", "2026-07-31", "not json")],
                               "store_id string, d string, payload string").withColumn("date", F.col("d").cast("date"))
    got = {r["store_id"]: r for r in weather.parse_payloads(df).collect()}
    assert (got["0"]["temperature_2m_max_c"], got["0"]["temperature_2m_min_c"], got["0"]["precipitation_sum_mm"]) == (
        Decimal("17.500"), None, Decimal("4.500"))
    assert [got[k]["error_message"] for k in "01234x"] == [
        None, "Open-Meteo response has no daily weather object.", "Open-Meteo returned no weather for 2026-07-31.",
        "Open-Meteo response is missing precipitation_sum.", "Open-Meteo response is missing temperature_2m_min.",
        "Open-Meteo response has no daily weather object."]
    assert weather.usable_weather(weather.parse_payloads(df)).count() == 1


def test_weather_requests_and_cache(spark, dims, folder):
    stores = spark.createDataFrame([("S1", 48.21, 16.37), ("S2", None, None), ("S3", 1.0, 2.0)], "store_id string, latitude double, longitude double")
    plan = capture.weather_requests(stores, dims[1], "2026-07-31").collect()
    assert [r["store_id"] for r in plan] == ["S3"]
    sold = spark.createDataFrame(
        [(s, d) for s in ("S1", "S2", "S3") for d in ("2026-07-31", "2026-08-01", "2026-08-02", "2026-08-02")], "store_id string, order_date string")
    todo = capture.weather_backfill(sold, stores, dims[1]).orderBy("store_id", "date").collect()
    assert [(r["store_id"], str(r["date"])) for r in todo] == [
        ("S1", "2026-08-02"), ("S3", "2026-07-31"), ("S3", "2026-08-01"), ("S3", "2026-08-02")]
    assert todo[0]["url"] == (
        K.WEATHER_URL + "?latitude=48.21&longitude=16.37&start_date=2026-08-02&end_date=2026-08-02"
        "&daily=temperature_2m_max%2Ctemperature_2m_min%2Cprecipitation_sum&timezone=auto")
    spark.sql("DROP TABLE IF EXISTS weather_cache")
    tables.create_if_missing(spark, "weather_cache", path=f"{folder}/weather_cache")
    tables.create_if_missing(spark, "weather_cache", path=f"{folder}/weather_cache")
    assert tables.insert_if_absent(dims[1].unionByName(dims[1]), "weather_cache") == 3
    assert tables.insert_if_absent(dims[1], "weather_cache") == 0
    assert source.read_weather(spark, "weather_cache").count() == 3
    with pytest.raises(ValueError, match="Tables not found"):
        source.read_tables(spark, ["weather_cache", "no_such_table"])
    spark.sql("DROP TABLE weather_cache")


def test_writers(spark, folder):
    df = spark.range(50).select((50 - F.col("id")).alias("k"), F.when(F.col("id") > 3, "x").alias("v"))
    files.write_sorted_csv(df, f"{folder}/csv", ["v", "k"])
    parts = sorted(n for n in os.listdir(f"{folder}/csv") if n.endswith(".csv"))
    rows = [line.strip().split(",") for n in parts for line in open(f"{folder}/csv/{n}") if not line.startswith("k,")]
    assert [int(r[0]) for r in rows] == [*range(1, 47), 47, 48, 49, 50] and rows[-1][1] in ("", '""')
    hashes = files.write_snapshot(df, f"{folder}/snap")
    assert hashes.where("length(sha256) = 64").count() >= 1
    with pytest.raises(PySparkException):
        files.write_snapshot(df, f"{folder}/snap")
    days = df.select(F.expr("date_add(date'2026-01-01', cast(k % 3 as int))").alias("order_date"), "k")
    files.write_by_date(days, f"{folder}/days", ("k",))
    files.write_by_date(days.where("order_date = date'2026-01-01'").limit(1), f"{folder}/days", ("k",))
    left = {str(r[0]): r[1] for r in spark.read.parquet(f"{folder}/days").groupBy("order_date").count().collect()}
    assert left["2026-01-01"] == 1 and left["2026-01-02"] == 17
    files.write_by_date(days.where("order_date = date'2026-01-01'"), f"{folder}/days", ("k",), whole=True)
    assert [str(r[0]) for r in spark.read.parquet(f"{folder}/days").select("order_date").distinct().collect()] == ["2026-01-01"]
    os.makedirs(f"{folder}/payloads/2026-07-31")
    with open(f"{folder}/payloads/2026-07-31/S9.json", "w") as out:
        out.write('{\n "daily": null}')
    landed = captures.read_weather_payloads(spark, f"{folder}/payloads")
    assert [(r["store_id"], str(r["date"])) for r in landed.collect()] == [("S9", "2026-07-31")]
    assert weather.usable_weather(weather.parse_payloads(landed)).count() == 0
    assert tables.row_parity(df, df.limit(3)).first()["sql_csv_row_count_difference"] == -47
    with pytest.raises(QualityError):
        tables.require_parity(tables.row_parity(df, df.limit(3)))


def test_product_gates_and_review(spark):
    ids = spark.createDataFrame([("a",), ("a",), (" ",), (None,)], "id string")
    assert tuple(quality.product_input_checks(ids, "id").first()) == (4, 2, 1)
    for rows, text in (([], "no rows"), ([("a",), ("",)], "blank"), ([("a",), ("a",)], "duplicate")):
        with pytest.raises(QualityError, match=text):
            quality.require_products(spark.createDataFrame(rows, "id string"), ["id"], "id")
    proposals = spark.createDataFrame(
        [("N1", "One", "P1", K.EXACT_MATCH), ("N2", "Two", "P2", K.NEEDS_REVIEW), ("N3", "Three", "P2", K.NEEDS_REVIEW), ("N4", "Four", "P4", K.NEEDS_REVIEW)],
        "new_product_id string, new_product_name string, proposed_legacy_product_id string, match_status string")
    reviews = spark.createDataFrame(
        [("N2", "Two", 0.9, "P2", "accepted", "ok", "2026-09-08"), ("N3", "Three", 1.2, None, "no_legacy_predecessor", "", "2026-9-8"),
         ("N4", "Four", 0.5, "P9", "maybe", "ok", "2026-09-08"), ("N4", "Four", 0.5, "P9", "accepted", "ok", "2026-09-08"), ("N1", "One", 0.5, "P1", "accepted", "ok", "2026-09-08")],
        "new_product_id string, new_product_name string, match_score double, canonical_legacy_product_id string, review_decision string, review_basis string, reviewed_on string")
    assert review.review_rules(proposals, reviews).first().asDict() == {
        "unreviewed": 0, "not_flagged": 1, "repeated_reviews": 1, "blank_basis": 1, "invalid_dates": 1,
        "invalid_decisions": 1, "scores_out_of_range": 1, "no_correction": 1}
    canonical = review.apply_review(proposals, reviews.where("review_decision <> 'maybe'"))
    assert {r[1]: r[0] for r in canonical.collect()} == {"N1": "P1", "N2": "P2", "N3": None, "N4": "P9"}
    assert review.review_alignment(reviews, canonical.where("canonical_product_id <> 'N1'")).count() == 1


def test_reports(spark):
    rows = spark.createDataFrame([("d1", "East", "a", 5.0, 1), ("d2", "East", "b", 9.0, 1), ("d2", "West", "a", 2.0, 1)],
                                 "order_date string, region string, canonical_category string, net_sales double, units_sold int")
    got = {r["order_date"]: (r["scaled"], r["is_peak"]) for r in daily_trend_scaled(rows).collect()}
    assert got == {"d1": (0.0, False), "d2": (1.0, True)}
    assert [(r["region"], r["canonical_category"]) for r in category_by_region(rows, 1).orderBy("region").collect()] == [("East", "b"), ("West", "a")]


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_plans(spark):
    sf = "/root/testdata/sf0.001"
    typed = silver.type_orders(testbed.landed_lines(spark, sf))
    assert "PythonUDF" not in plan_of(typed) and "EvalPython" not in plan_of(typed)
    stores = testbed.nation_stores(spark, sf)
    joined = gold.attach_stores(gold.daily_sales(gold.normalize_silver(testbed.silver_lines(spark, sf))), stores)
    assert "BroadcastHashJoin" in plan_of(joined) and "CartesianProduct" not in plan_of(joined)
    pruned = testbed.table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderdate")
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in plan_of(pruned)
    many = spark.range(0, 1000, 1, 64)
    assert spread(many, "id") is many  # enough splits already: no shuffle


def test_prices_are_cleaned_and_cast_once(spark):
    lines = spark.range(1).select(*[F.col("id").cast("string").alias(c) for c in BRONZE_COLUMNS])
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        silver.type_orders(lines).explain(True)
    plan = printed.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.count("translate(") == 2 and len(re.findall(r"cast\(\w+#\d+ as decimal\(38,18\)\) AS _wide", plan)) == 3


def test_lines_without_a_legacy_id_do_not_share_a_task(spark):
    columns = "order_id string, product_id string, new_product_id string"
    rows = [(f"o{i}", None, f"NP{i}") for i in range(300)] + [("a", "P1", None), ("b", "P2", None), ("c", None, None)]
    orders = spark.createDataFrame(rows, columns)
    crosswalk = spark.createDataFrame([("P1", "NQ1"), (None, "NX")], "legacy_product_id string, canonical_product_id string")
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = silver.resolve_canonical(orders, crosswalk).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    by_id = {r.order_id: r.canonical_product_id for r in found}
    assert len(found) == len(rows) and by_id["o7"] == "NP7" and (by_id["a"], by_id["b"], by_id["c"]) == ("NQ1", "P2", None)
    assert len({r.task for r in found if r.product_id is None}) > 1
