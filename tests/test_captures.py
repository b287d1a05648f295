"""Capture rules, store, audit and the stream, on small inline files."""

import contextlib
import csv
import io
import os
import re
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from storeledger import constants as K
from storeledger.catalog import captures
from storeledger.errors import CaptureError
from storeledger.operators import audit
from storeledger.operators import capture_rules as C
from storeledger.operators.capture_rules import check_captures, check_folder, validate_captures
from storeledger.operators.capture_store import classify_captures, first_records, profile_captures
from storeledger.plans import capture as plan
from storeledger.sinks import files as sink
from storeledger.sources import captures as source
from storeledger.sources.orders import read_order_lines_text, read_orders
from storeledger.streaming.capture_stream import audit_stream, capture_stream

NEW, OLD = K.MIGRATED_ORDER_COLUMNS, K.LEGACY_ORDER_COLUMNS
ROW = ("20250331-0001", "2025-03-31", "NORTH2", "KX88", "1", "12.45", "0", "counter", "N")
NOON = datetime(2025, 3, 31, 2, 37)


def text(*rows, columns=NEW, end="\n"):
    return end.join([",".join(columns), *(",".join(r) for r in rows)]) + end


def change(**values):
    return tuple(values.get(c, v) for c, v in zip(NEW, ROW))


CASES = {
    # name: (content, message or None, rows)
    "new": (text(ROW), None, 1),
    "old": (text((*ROW[:3], "OLD17", *ROW[4:]), columns=OLD), None, 1),
    "empty": ("", K.MSG_EMPTY, 0),
    "html": (" \n<HTML>error</html>", K.MSG_HTML, 0),
    "doctype": ("<!DocType html><p>", K.MSG_HTML, 0),
    "header_only": (text(), K.MSG_NO_ROWS, 0),
    "blank_lines_only": (text() + "\n\r\n\n", K.MSG_NO_ROWS, 0),
    "header_swapped": (text(ROW, columns=(NEW[1], NEW[0], *NEW[2:])),
                       "Row 2 has an invalid order_date: '20250331-0001'.", 1),
    "reordered": (text((ROW[1], ROW[0], *ROW[2:]), columns=(NEW[1], NEW[0], *NEW[2:])), None, 1),
    "two_dates": (text(ROW, change(order_date="2025-04-01")), K.MSG_MANY_DATES, 2),
    "us_date": (text(change(order_date="03/31/2025")), "Row 2 has an invalid order_date: '03/31/2025'.", 1),
    "no_such_day": (text(ROW, change(order_date="2025-02-30")), "Row 3 has an invalid order_date: '2025-02-30'.", 2),
    "blank_id": (text(ROW, change(order_id="  \t")), "Row 3 has no order_id.", 2),
    "extra_field": (text(ROW, (*ROW, "")), "Row 3 contains extra CSV fields.", 2),
    "first_failure": (text((*ROW, "x"), change(order_id="")), "Row 2 contains extra CSV fields.", 2),
    "short_row": (text(ROW, ROW[:2]), None, 2),
    "too_short": (text(ROW, ROW[:1]), "Row 3 has an invalid order_date: ''.", 2),
    "missing": (text(ROW[:8], columns=NEW[:8]), "Missing columns: loyalty_member, product_id", 0),
    "unexpected": (text((*ROW, "x"), columns=(*NEW, "zone")),
                   "Missing columns: product_id; Unexpected columns: zone", 0),
    "both_keys": (text((*ROW, "P1"), columns=(*NEW, "product_id")), K.MSG_BOTH_KEYS, 0),
    "blank_first_line": ("\n" + text(ROW), "Missing columns: " + ", ".join(sorted({*NEW, *OLD})), 0),
    "bom_crlf": ("﻿" + text(ROW, ROW, end="\r\n"), None, 2),
    "blank_between": (text(ROW) + "\n\n" + ",".join(ROW) + "\n", None, 2),
    "quoted": (text(change(unit_price='"$1,234.56"', sales_channel='"say ""hi"""')), None, 1),
    "quoted_header": (text(ROW, columns=tuple(f'"{c}"' for c in NEW)), None, 1),
    "line_end_in_quotes": (text(change(sales_channel='"two\nlines"'), ROW), None, 2),
    "quote_inside": (text(change(sales_channel='5" tall'), change(sales_channel='6" tall')), None, 2),
    "padded_date": (text(change(order_date=" 2025-03-31 ")), None, 1),
}


@pytest.fixture(scope="module")
def landed(spark):
    rows = [(f"in/{name}", bytearray(content.encode())) for name, (content, _, _) in CASES.items()]
    rows.append(("in/latin", bytearray("order_id,é".encode("latin-1"))))
    rows.append(("in/large", bytearray(b"x" * (K.MAX_CAPTURE_BYTES + 1))))
    return spark.createDataFrame(rows, "path string, content binary")


def test_every_rule(landed):
    found = {r["path"][3:]: r for r in check_captures(landed, K.MAX_CAPTURE_BYTES).collect()}
    assert check_captures(landed.where("path = 'in/large'")).first()["error_message"] != K.MSG_TOO_LARGE
    assert len(found) == len(CASES) + 2
    for name, (content, message, rows) in CASES.items():
        assert found[name]["error_message"] == message, name
        assert found[name]["row_count"] == rows, name
        assert found[name]["file_size_bytes"] == len(content.encode())
        if message is None:
            assert found[name]["order_date"] == "2025-03-31"
            # The csv module agrees on the number of records.
            assert rows == len(list(csv.DictReader(content.lstrip("﻿").splitlines(keepends=True))))
    assert found["latin"]["error_message"] == K.MSG_NOT_UTF8
    assert found["large"]["error_message"] == K.MSG_TOO_LARGE
    assert found["old"]["product_id_column"] == "product_id"
    facts, rejects = validate_captures(landed)
    assert facts.count() == sum(1 for _, m, _ in CASES.values() if m is None)
    assert rejects.count() + facts.count() == len(found)


def test_lines_follow_the_header_not_the_position(landed):
    lines = read_order_lines_text(landed.where("path in ('in/reordered', 'in/quoted', 'in/old')"))
    got = lines.select("order_id", "order_date", "product_id", "new_product_id", "unit_price", "sales_channel")
    want = [
        ("20250331-0001", "2025-03-31", None, "KX88", "$1,234.56", 'say "hi"'),
        ("20250331-0001", "2025-03-31", None, "KX88", "12.45", "counter"),
        ("20250331-0001", "2025-03-31", "OLD17", None, "12.45", "counter"),
    ]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def put(folder, day, content, name="orders.csv"):
    os.makedirs(f"{folder}/{day}", exist_ok=True)
    with open(f"{folder}/{day}/{name}", "wb") as out:
        out.write(content.encode())


def test_scan_by_header_sidecars_and_replay(spark, folder):
    root, log = f"{folder}/orders", f"{folder}/log"
    later = tuple(v.replace("2025-03-31", "2025-04-01") for v in ROW)
    put(root, "2025-03-30", text((ROW[0], "2025-03-30", "S001", "P1", *ROW[4:]), columns=OLD))
    put(root, "2025-03-31", text((ROW[1], ROW[0], *ROW[2:]), columns=(NEW[1], NEW[0], *NEW[2:])))
    put(root, "2025-04-01", text(later))
    put(root, "2025-04-02", text(later))  # in the wrong folder
    rows = {r["order_date"]: r for r in read_orders(spark, root).where("order_date <> '2025-04-01'").collect()}
    assert rows["2025-03-30"]["product_id"] == "P1" and rows["2025-03-30"]["new_product_id"] is None
    assert rows["2025-03-31"]["order_id"] == ROW[0] and rows["2025-03-31"]["new_product_id"] == "KX88"

    files = source.read_captures(spark, root)
    facts = {r["folder_date"]: r["sha256"] for r in source.manifest(files).collect()}
    put(root, "2025-03-30", f"{facts['2025-03-30'].upper()}  orders.csv\n# kept\n", "orders.csv.sha256")
    put(root, "2025-03-31", "0" * 64 + "  orders.csv\n", "orders.csv.sha256")
    states = source.verify_checksums(source.manifest(files), source.read_sidecars(spark, root))
    assert {r["folder_date"]: r["checksum_state"] for r in states.collect()} == {
        "2025-03-30": "match", "2025-03-31": "mismatch", "2025-04-01": "unrecorded", "2025-04-02": "unrecorded"}

    before = sorted(os.listdir(root))
    assert {r[0]: r[1] for r in plan.replay(spark, root, log, NOON).collect()} == {"valid": 2, "failed": 2}
    plan.replay(spark, root, log)
    events = sink.read_audit_folder(spark, log).collect()
    assert len(events) == 4  # the second replay added nothing
    failed = {e["sort_date"]: e["error_message"] for e in events if e["status"] == "failure"}
    assert sorted(failed) == ["2025-03-31", "2025-04-02"] and sorted(os.listdir(root)) == before
    assert failed["2025-04-02"] == "Folder 2025-04-02 contains orders for 2025-04-01."
    assert failed["2025-03-31"].endswith("/2025-03-31/orders.csv.sha256 does not match orders.csv.")


def test_scan_keeps_quoted_line_ends_and_refuses_web_pages(spark, folder):
    root = f"{folder}/orders"
    with pytest.raises(CaptureError, match="No order files"):
        read_orders(spark, root)
    put(root, "2025-03-31", text(change(sales_channel='"two\nlines"')))
    assert [r["sales_channel"] for r in read_orders(spark, root).collect()] == ["two\nlines"]
    put(root, "2025-04-01", "<html><body>moved</body></html>")
    with pytest.raises(PySparkException, match="HTML"):
        read_orders(spark, root).collect()


def delivery(spark, name, content):
    return spark.createDataFrame([(f"in/{name}", bytearray(content.encode()))], "path string, content binary")


def test_preserve_is_idempotent_and_never_overwrites(spark, folder):
    store, log = f"{folder}/store", f"{folder}/log"
    first = delivery(spark, "a", text(ROW))
    changed = delivery(spark, "b", text(change(new_product_id="KX99")))
    done = []
    assert plan.run_daily(first, store, log, lambda d: done.append(d.first()[0]), lambda: done.append("built"), NOON)
    assert plan.run_daily(first, store, log, now=NOON)  # capture only
    assert done == ["2025-03-31", "built"]
    assert not plan.run_daily(changed, store, log, lambda d: done.append("weather"), lambda: done.append("built"), NOON)
    assert done == ["2025-03-31", "built"]
    kept = spark.read.parquet(store).collect()
    assert len(kept) == 1 and bytes(kept[0]["content"]).decode() == text(ROW)
    events = sink.read_audit_folder(spark, log).collect()
    assert sorted(e["status"] for e in events) == ["failure", "success"]
    assert all(e["timestamp_utc"] == "2025-03-31T02:37:00+00:00" for e in events)
    good = next(e for e in events if e["status"] == "success")
    assert (good["order_date"], good["row_count"], good["sort_date"]) == ("2025-03-31", "1", "2025-03-31")


def test_kept_bytes_are_hashed_again(spark, folder):
    first = delivery(spark, "a", text(ROW))
    plan.preserve_captures(first, f"{folder}/store")
    kept = spark.read.parquet(f"{folder}/store")
    other = text(change(new_product_id="KX99")).encode()
    damaged = {
        "bytes": (kept.withColumn("content", F.lit(bytearray(other))), "2025-03-31 already has different contents; it was not overwritten."),
        "hash": (kept.withColumn("sha256", F.lit("0" * 64)), "2025-03-31/orders.csv.sha256 does not match orders.csv."),
        "gone": (kept.withColumn("content", F.lit(None).cast("binary")), "2025-03-31 exists without orders.csv; inspect it manually."),
    }
    for name, (rows, message) in damaged.items():
        rows.write.partitionBy("order_month").parquet(f"{folder}/{name}")
        assert [r["error_message"] for r in plan.preserve_captures(first, f"{folder}/{name}").collect()] == [message]
        assert spark.read.parquet(f"{folder}/{name}").count() == 1


def test_classification(spark):
    incoming = spark.createDataFrame(
        [("a", "d1", "x"), ("b", "d2", "x"), ("c", "d3", "x"), ("d", "d3", "x"), ("e", "d3", "y"),
         ("f", "d4", "x"), ("g", "d5", "x")], "path string, order_date string, sha256 string")
    kept = spark.createDataFrame(
        [("d1", "x", "X"), ("d2", "y", "y"), ("d4", None, None), ("d5", "x", "z")],
        "order_date string, sha256 string, recorded_sha256 string")
    got = {r["path"]: r["capture_state"] for r in classify_captures(incoming, kept).collect()}
    assert got == {"a": "unchanged", "b": "conflict", "c": "new", "d": "unchanged", "e": "conflict",
                   "f": "missing_file", "g": "checksum_mismatch"}


def test_audit_keys(spark):
    rows = [
        ("t1", "2025-03-31", "success", "1", "9", "s1", "", "2025-03-31"),
        ("t2", "2025-03-31", "success", "1", "9", "s1", None, "2025-03-31"),
        ("t3", "2025-03-31", "success", "1", "9", "s2", "", "2025-03-31"),
        ("t4", "", "failure", "", "", "", "down", "2025-03-31"),
        ("t5", None, "failure", "", "", "", "down", "2025-03-31"),
        ("t6", "", "failure", "", "", "", "down", "2025-04-01"),
    ]
    schema = ", ".join(f"{c} string" for c in K.AUDIT_FIELDS)
    events = spark.createDataFrame(rows, schema)
    fresh = audit.events_to_append(events, spark.createDataFrame(rows[2:3], schema))
    assert sorted(r["timestamp_utc"] for r in fresh.collect()) == ["t1", "t4", "t6"]


def test_profile_and_snapshot(spark, folder):
    lines = spark.createDataFrame(
        [("d1", "a", "S1", "P1"), ("d1", "a", "S1", None), ("d1", None, "S2", "P1"), ("d1", None, None, "P2"),
         ("d2", "a", "S1", "P1")], "day string, order_id string, store_id string, product string")
    got = {r["day"]: tuple(r)[1:] for r in profile_captures(lines, "day", "product").collect()}
    assert got["d1"] == (4, 3, 4, 2, 2, 2) and got["d2"] == (1, 3, 0, 0, 1, 1)
    assert [r["product"] for r in first_records(lines, ["day", F.desc("product")], 2).collect()] == ["P2", "P1"]
    for day, names in (("2025-03-28", ("products.csv", "new_products.csv")), ("2025-03-29", ("products.csv",))):
        for name in names:
            put(folder, day, "product_id\nP1\n", name)
    listing = spark.read.format("binaryFile").load(f"{folder}/*").select(
        source.folder_date(F.col("path")).alias("folder_date"), F.element_at(F.split("path", "/"), -1).alias("file_name"))
    names = ("products.csv", "new_products.csv")
    assert source.latest_complete_folder(listing, names).first()[0] == "2025-03-28"
    assert source.latest_complete_folder(listing.where("file_name <> 'new_products.csv'"), names).first()[0] is None


def test_stream_takes_each_file_once(spark, folder):
    """A repeat, a conflict and a broken file after a restart."""
    root, store, log, check = (f"{folder}/{n}" for n in ("landing", "store", "log", "check"))
    put(root, "2025-03-31", text(ROW))
    put(root, "2025-02-01", text(tuple(v.replace("2025-03-31", "2025-02-01") for v in ROW)))
    capture_stream(spark, root, store, log, check, now=lambda: NOON)
    put(root, "redelivered", text(ROW))
    put(root, "altered", text(change(new_product_id="KX99")))
    put(root, "broken", "<html>")
    capture_stream(spark, root, store, log, check, now=lambda: NOON)
    capture_stream(spark, root, store, log, check, now=lambda: NOON)  # nothing new
    assert sorted(r["order_date"] for r in spark.read.parquet(store).collect()) == ["2025-02-01", "2025-03-31"]
    assert bytes(spark.read.parquet(store).where("order_date = '2025-03-31'").first()["content"]).decode() == text(ROW)
    events = sink.read_audit_folder(spark, log).collect()
    assert sorted(r["status"] for r in events) == ["failure", "failure", "success", "success"]
    assert any("already has different contents" in r["error_message"] for r in events)


def test_a_batch_reads_the_dates_it_touches(spark, folder):
    """One of two months, and within it the parts of the files that may hold the date."""
    store, log = f"{folder}/store", f"{folder}/log"
    for day in ("2025-02-01", "2025-03-30", "2025-03-31"):
        plan.run_ingestion(delivery(spark, day, text(tuple(v.replace("2025-03-31", day) for v in ROW))), store, log, NOON)
    scan = plan.kept_on(spark, store, ["2025-03-31"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*order_month[^]]*2025-03", scan) and re.search(r"PushedFilters: \[[^]]*order_date,?[^]]*2025-03-31", scan)
    assert [r["order_date"] for r in plan.kept_on(spark, store, ["2025-03-31", "2025-04-01"]).collect()] == ["2025-03-31"]
    scan = sink.logged(spark, log, ["2025-02"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*log_month[^]]*2025-02", scan)
    assert [r["order_date"] for r in sink.logged(spark, log, ["2025-02"]).collect()] == ["2025-02-01"]


def test_no_event_of_a_stream_passes_twice(spark, folder):
    """Three batches; the last repeats an event of the first, long after."""
    landing, log = f"{folder}/landing", f"{folder}/log"
    schema = ", ".join(f"{c} string" for c in K.AUDIT_FIELDS)

    def event(day, sha, message=""):
        status = "failure" if message else "success"
        return (f"{day}T10:00:00", "" if message else day, status, "1", "9", sha, message, day)

    batches = [
        [event("2025-01-01", "a"), event("2025-01-01", "a"), event("2025-01-02", "b")],
        [event("2026-06-01", "a"), event("2026-06-01", "", "down"), (None,) * 8],
        [event("2025-01-01", "a"), event("2026-06-01", "", "down"), event("2025-01-01", "c"), (None,) * 8],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(landing, ignoreNullFields=False)
        audit_stream(spark.readStream.schema(schema).json(landing), log, f"{folder}/check")
    passed = sorted((r["order_date"], r["sha256"], r["error_message"]) for r in sink.read_audit_folder(spark, log).collect())
    assert passed == [("", "", ""), ("", "", "down"), ("2025-01-01", "a", ""), ("2025-01-01", "c", ""), ("2025-01-02", "b", ""), ("2026-06-01", "a", "")]


def test_folder_rule_leaves_undated_paths_alone(spark):
    checked = check_captures(delivery(spark, "a", text(ROW)))
    assert check_folder(checked).first()["error_message"] is None


def test_days_not_asked_for_and_large_files_are_never_opened(spark, folder):
    """Every file that is opened is counted."""
    from pyspark.sql import datasource as ds

    from storeledger.sources import capture_files as cf

    opened = []

    class Counting(cf.CaptureReader):
        def content(self, system, file):
            found = super().content(system, file)
            if found is not None:
                opened.append(file.path)
            return found

    for month in (1, 2, 3):
        for day in range(1, 6):
            put(folder, f"2025-{month:02d}-{day:02d}", "x" * (10 * day))
    put(folder, "notes", "no capture")
    put(folder, "2025-02-03", "another file", "other.csv")

    def read(filters, **options):
        opened.clear()
        reader = Counting({"path": folder, **options})
        left = list(reader.pushFilters(filters))
        rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        return rows, left

    rows, left = read([ds.GreaterThanOrEqual(("folder_date",), "2025-02-02"), ds.LessThan(("folder_date",), "2025-03-01"), ds.IsNotNull(("folder_date",))])
    assert not left and len(opened) == 4 and [r["folder_date"][-2:] for r in rows] == ["02", "03", "04", "05"]
    rows, left = read([ds.LessThanOrEqual(("length",), 20), ds.EqualTo(("path",), "x"), ds.Not(ds.In(("folder_date",), ("2025-01-01",)))])
    assert len(left) == 2 and len(opened) == 6 and {len(r["content"]) for r in rows} == {10, 20}
    rows, left = read([ds.In(("folder_date",), ("2025-01-04", "2025-01-05"))], maxbytes="40")
    assert len(opened) == 1 and [(r["length"], r["content"] is None) for r in rows] == [(40, False), (50, True)]

    months = source.read_captures(spark, folder, first="2025-03-01", most_bytes=30)
    assert sorted((r.length, r.content is None) for r in months.collect()) == [(10, False), (20, False), (30, False), (40, True), (50, True)]
    assert '2025-03-01' in months._jdf.queryExecution().toString()
    errors = {r["path"][-21:]: r["error_message"] for r in check_captures(months, 30).collect()}
    assert errors["2025-03-05/orders.csv"] == K.MSG_TOO_LARGE and errors["2025-03-01/orders.csv"] != K.MSG_TOO_LARGE
    assert source.read_captures(spark, folder, "nothing.csv").isEmpty()


def test_captures_are_written_once_with_sidecars(spark, folder):
    from pyspark.errors import PySparkException

    from storeledger.sources.capture_files import write_capture_files

    rows = [("2025-03-31", bytearray(text(ROW).encode())), ("2025-04-01", bytearray(b""))]
    files = spark.createDataFrame(rows, "folder_date string, content binary")
    write_capture_files(files, folder)
    write_capture_files(files, folder)  # the same bytes: nothing happens
    assert sorted(os.listdir(f"{folder}/2025-03-31")) == ["orders.csv", "orders.csv.sha256"]
    kept = source.verify_checksums(source.manifest(source.read_captures(spark, folder)), source.read_sidecars(spark, folder))
    assert {r["folder_date"]: r["checksum_state"] for r in kept.collect()} == {"2025-03-31": "match", "2025-04-01": "match"}
    other = spark.createDataFrame([("2025-03-31", bytearray(b"else"))], "folder_date string, content binary")
    with pytest.raises(PySparkException, match="not overwritten"):
        write_capture_files(other, folder)
    with pytest.raises(PySparkException, match="no folder date"):
        write_capture_files(other.withColumn("folder_date", F.lit("../x")), folder)
    assert open(f"{folder}/2025-03-31/orders.csv", "rb").read() == text(ROW).encode()


def method_sizes(df):
    """Bytes of the largest generated method of each stage; the JVM compiles none above 8,000."""
    spark, printed = df.sparkSession, io.StringIO()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows its code after a run only
    try:
        with contextlib.redirect_stdout(printed):
            df.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", printed.getvalue())]


@pytest.mark.parametrize("name", ["capture_rules", "capture_facts", "replay_summary", "ingestion_events", "schema_diff_message"])
def test_generated_methods_are_small_enough_to_be_compiled(spark, name):
    sizes = method_sizes(captures.QUERIES[name][0](spark, "/root/testdata/sf0.001"))
    assert sizes and max(sizes) < 8000


@pytest.mark.parametrize("name", ["capture_rules", "schema_diff_message"])
def test_a_file_is_made_once(spark, name):
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        captures.QUERIES[name][0](spark, "/root/testdata/sf0.001").explain()
    assert printed.getvalue().count("format_number(") == 1


def test_dates_and_headers_at_their_edges(spark):
    texts = ["2024-02-29", "2023-02-29", "0001-01-01", "2024-01-01\n", " 2024-01-01", "2024-1-01", "2024-01-01T00"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.iso_date(F.col("t")).alias("d")).collect()
    assert [r.t for r in rows if r.d] == ["2024-02-29", "0001-01-01"]
    legacy, new = list(K.LEGACY_ORDER_COLUMNS), list(K.MIGRATED_ORDER_COLUMNS)
    headers = [legacy, new[::-1], legacy + ["quantity"], legacy[1:], legacy + [K.MIGRATED_KEY], legacy[:-1] + ["other"], legacy[:-1] + [""], []]
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(headers)], "i int, h array<string>").select(
        "i", C.schema_variant(F.col("h")).alias("v"), C.schema_message(F.col("h")).alias("m")).orderBy("i").collect()
    assert [r.v for r in rows] == [K.LEGACY_KEY, K.MIGRATED_KEY, K.LEGACY_KEY, None, None, None, None, None]
    assert rows[4].m == K.MSG_BOTH_KEYS and rows[6].m.endswith("; Unexpected columns: ")
    assert rows[5].m == "Missing columns: loyalty_member, new_product_id; Unexpected columns: other"
    lines = spark.createDataFrame([("a,b\r\nc",), ("a\rb\nc",), ("",), ("\n",), ("a",)], "t string").select(C.header_line(F.col("t")).alias("h"))
    assert [r.h for r in lines.collect()] == ["a,b", "a", "", "", "a"]


def test_deliveries_are_not_shuffled_to_meet_their_dates(spark, folder):
    files = spark.createDataFrame(
        [(f"landing/2025-03-31/{i}.csv", text(ROW).encode()) for i in range(3)] + [("landing/x.csv", b"<html>")], "path string, content binary")
    checked = plan.staged(check_captures(files), "checked")
    outcome = plan._outcome(checked, f"{folder}/store")
    assert {r.path[-5:]: (r.capture_state, r.error_message) for r in outcome.collect()} == {
        "0.csv": ("new", None), "1.csv": ("unchanged", None), "2.csv": ("unchanged", None), "x.csv": (None, K.MSG_HTML)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        printed = io.StringIO()
        with contextlib.redirect_stdout(printed):
            plan._outcome(checked, f"{folder}/store").explain()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in printed.getvalue() and "hashpartitioning" not in printed.getvalue()
