"""Capture queries: rules, manifests, snapshots, audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import trim_ws
from ..operators import audit as A
from ..operators import capture_rules as C
from ..operators.capture_store import classify_captures, profile_captures
from ..sources import captures as S
from . import testbed as T

RUN_STAMP = "2026-07-31T02:37:00+00:00"


def capture_rules(spark, sf):
    return C.check_captures(T.captures(spark, sf)).select(
        "path", "sha256", "file_size_bytes", "row_count", "order_date", "product_id_column", "error_message")


def capture_facts(spark, sf):
    return C.split_captures(C.check_captures(T.order_captures(spark, sf)))[0]


def replay_summary(spark, sf):
    return A.replay_summary(C.check_folder(C.check_captures(T.captures(spark, sf))))


def ingestion_events(spark, sf):
    checked = C.check_captures(T.captures(spark, sf))
    return A.ingestion_events(checked, F.lit(RUN_STAMP), F.lit(RUN_STAMP[:10]))


def capture_manifest(spark, sf):
    return S.manifest(T.captures(spark, sf)).withColumn(
        "sidecar", S.sidecar_text(F.col("sha256")))


def checksum_verify(spark, sf):
    """Documents against sidecars recorded in upper case, of other text for German ones; those of French ones lie elsewhere."""
    docs = T.table(spark, sf, "documents").select(
        F.concat(F.lit("documents/"), "doc_id").alias("path"), "lang", "text")
    files = S.manifest(docs.select("path", F.encode("text", "UTF-8").alias("content")))
    recorded = F.when(F.col("lang") == "de", F.upper("text")).otherwise(F.col("text"))
    place = F.when(F.col("lang") == "fr", F.concat(F.lit("moved/"), "path")).otherwise(F.col("path"))
    sidecars = docs.select(place.alias("path"), S.recorded_hash(
        S.sidecar_text(F.upper(F.sha2(F.encode(recorded, "UTF-8"), 256)))).alias("recorded_sha256"))
    return S.verify_checksums(files, sidecars).select("path", "sha256", "checksum_state")


def html_payload_detect(spark, sf):
    texts = T.text_captures(spark, sf)
    return texts.select("path", C.is_html(C.decoded(F.col("content"))).alias("is_html"))


def _headers(spark, sf):
    texts = T.captures(spark, sf).select("path", C.decoded(F.col("content")).alias("text"))
    firsts = texts.select("path", C.header_line(F.col("text")).alias("header"), C.is_html(F.col("text")).alias("is_html"))
    # A filter is not pushed through a generator, where it would make and read every file several times over.
    return firsts.select("path", F.inline(F.array(F.struct(C.csv_fields(F.col("header")).alias("columns"), "is_html"))))


def schema_variant_detect(spark, sf):
    variant = C.schema_variant(F.col("columns"))
    return _headers(spark, sf).groupBy(variant.alias("product_id_column")).agg(
        F.count(F.lit(1)).alias("capture_count"))


def schema_diff_message(spark, sf):
    """What is wrong with each header; web pages were turned away before."""
    headers = _headers(spark, sf).where("not is_html")
    return headers.where(C.schema_variant(F.col("columns")).isNull()).select(
        "path", C.schema_message(F.col("columns")).alias("message"))


def reject_blank_key(spark, sf):
    """Rows whose key is blank: keys of customers out of credit are blanked."""
    key = F.when(F.col("c_acctbal") < 0, F.lit(" \t ")).otherwise(F.col("c_name"))
    rows = T.table(spark, sf, "customer").select("c_custkey", key.alias("order_id"))
    return rows.where(trim_ws(F.coalesce("order_id", F.lit(""))) == "").select("c_custkey")


def reject_bad_date(spark, sf):
    """Order dates written three ways; only ``yyyy-MM-dd`` is a date."""
    day = F.to_date("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "P", F.date_format(day, "MM/dd/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit(" "), F.date_format(day, "yyyy-MM-dd")))
        .otherwise(F.concat(F.date_format(day, "yyyy-MM-"), (F.dayofmonth(day) + 9).cast("string")))
    )
    rows = T.table(spark, sf, "orders").select("o_orderkey", trim_ws(text).alias("order_date"))
    return rows.where(C.iso_date(F.col("order_date")).isNull())


def single_date_per_capture(spark, sf):
    """Orders as captures of their lines: those whose lines ship on several days."""
    return (
        T.table(spark, sf, "lineitem").groupBy("l_orderkey")
        .agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"),
             F.count(F.lit(1)).alias("row_count"))
        .where("lo <> hi").select("l_orderkey", "row_count")
    )


def capture_profile(spark, sf):
    lines = T.landed_lines(spark, sf)
    lines = lines.withColumn("product", F.coalesce("product_id", "new_product_id")).withColumn(
        "order_id", F.regexp_extract("order_id", r"^(\d+-\d+)", 1)).drop("product_id", "new_product_id")
    # order_date is one of the file's nine columns and never missing.
    return profile_captures(lines, "order_date", "product").withColumn(
        "column_count", F.col("column_count") + 1)


def schema_cutover(spark, sf):
    facts = T.landed_lines(spark, sf).select(
        "order_date",
        F.when(F.col("product_id").isNotNull(), K.LEGACY_KEY).otherwise(K.MIGRATED_KEY).alias("product_id_column"),
        F.lit(1).alias("row_count"))
    return A.schema_cutover(facts)


def capture_classify(spark, sf):
    """Documents delivered again: English ones are kept as they are, German ones
    were kept with other text, Spanish folders lost their file, French ones were kept
    for dates of their own; two deliveries of one text stand for a date delivered twice."""
    docs = T.table(spark, sf, "documents")
    sha = F.sha2(F.encode("text", "UTF-8"), 256)
    incoming = docs.select(
        F.concat(F.lit("in/"), "doc_id").alias("path"),
        F.concat_ws("/", "lang", F.when(F.col("lang") == "fr", F.length("text"))
                    .otherwise(F.col("doc_id"))).alias("order_date"),
        sha.alias("sha256"))
    preserved = docs.select(
        F.concat_ws("/", F.when(F.col("lang") == "fr", "kept").otherwise(F.col("lang")), "doc_id").alias("order_date"),
        F.when(F.col("lang").isin("en", "fr"), sha)
        .when(F.col("lang") == "de", F.sha2(F.encode(F.upper("text"), "UTF-8"), 256)).alias("sha256"))
    return classify_captures(incoming, preserved).select("path", "order_date", "capture_state")


def latest_complete_snapshot(spark, sf):
    """Order dates as snapshot folders, order statuses as the files they must hold."""
    listing = T.table(spark, sf, "orders").select(
        T.text_day("o_orderdate").alias("folder_date"), F.col("o_orderstatus").alias("file_name"))
    return S.latest_complete_folder(listing, ("F", "O"))


def _events_as_log(spark, sf):
    ok = F.col("event_type") != "error"
    day = T.text_day("ts")
    return T.table(spark, sf, "events").select(
        F.format_string("%012d", "event_id").alias("timestamp_utc"),
        F.when(ok, day).alias("order_date"),
        F.when(ok, "success").otherwise("failure").alias("status"),
        F.when(ok, "1").alias("row_count"), F.when(ok, "10").alias("file_size_bytes"),
        F.when(ok, F.sha2("props", 256)).alias("sha256"),
        F.when(~ok, F.col("props")).alias("error_message"),
        day.alias("sort_date"), "event_type")


def _moved(events, known):
    """``events`` as a log: those that are not ``known`` stand under another day."""
    def day(column):
        return F.when(F.expr(known), F.col(column)).otherwise(F.concat(F.lit("0"), F.col(column)))

    return events.withColumns({"order_date": day("order_date"), "sort_date": day("sort_date")})


def audit_append(spark, sf):
    """All events arrive; clicks and errors of the first days are logged already, the others under other days."""
    events = _events_as_log(spark, sf)
    known = "event_type = 'click' or (event_type = 'error' and sort_date < '2024-01-05')"
    return A.events_to_append(events, _moved(events, known)).select("timestamp_utc", "status", "sort_date", "sha256", "error_message")


def audit_gaps(spark, sf):
    """Captures are all successful events; the log has those of sign-ups, and the others under other days."""
    events = _events_as_log(spark, sf)
    facts = events.where("status = 'success'").select("order_date", "sha256").distinct()
    return A.audit_gaps(facts, _moved(events, "event_type = 'signup'"))


_EVENTS = """
log_events AS (
  SELECT format('{:012d}', event_id) AS timestamp_utc, strftime(ts, '%Y-%m-%d') AS sort_date,
         CASE WHEN event_type <> 'error' THEN 'success' ELSE 'failure' END AS status,
         CASE WHEN event_type <> 'error' THEN sha256(props) ELSE '' END AS sha256,
         CASE WHEN event_type = 'error' THEN props ELSE '' END AS error_message, event_type
  FROM events)
"""

QUERIES = {
    "capture_rules": (capture_rules, f"WITH {T.CHECKED} SELECT path, sha256, file_size_bytes, row_count, order_date, product_id_column, error_message FROM checked"),
    "capture_facts": (capture_facts, f"""WITH {T.CHECKED} SELECT path, order_date, row_count, sha256, file_size_bytes, product_id_column
        FROM checked WHERE error_message IS NULL"""),
    "replay_summary": (replay_summary, f"""WITH {T.CHECKED} SELECT CASE WHEN error_message IS NULL AND folder = order_date THEN 'valid' ELSE 'failed' END AS status,
        count(*) AS capture_count FROM checked GROUP BY 1"""),
    "ingestion_events": (ingestion_events, f"""WITH {T.CHECKED} SELECT '{RUN_STAMP}' AS timestamp_utc,
        CASE WHEN error_message IS NULL THEN order_date ELSE '' END AS order_date,
        CASE WHEN error_message IS NULL THEN 'success' ELSE 'failure' END AS status,
        CASE WHEN error_message IS NULL THEN CAST(row_count AS VARCHAR) ELSE '' END AS row_count,
        CASE WHEN error_message IS NULL THEN CAST(file_size_bytes AS VARCHAR) ELSE '' END AS file_size_bytes,
        CASE WHEN error_message IS NULL THEN sha256 ELSE '' END AS sha256,
        coalesce(error_message, '') AS error_message,
        CASE WHEN error_message IS NULL THEN order_date ELSE '{RUN_STAMP[:10]}' END AS sort_date FROM checked"""),
    "capture_manifest": (capture_manifest, f"""WITH {T.CHECKED} SELECT path, folder AS folder_date, sha256, file_size_bytes,
        sha256 || '  orders.csv' || chr(10) AS sidecar FROM checked"""),
    "checksum_verify": (checksum_verify, """SELECT 'documents/' || doc_id AS path, sha256(text) AS sha256,
        CASE WHEN lang = 'fr' THEN 'unrecorded' WHEN lang = 'de' AND upper(text) <> text THEN 'mismatch' ELSE 'match' END AS checksum_state
        FROM documents"""),
    "html_payload_detect": (html_payload_detect, r"""SELECT path, regexp_matches(lower(body), '^\s*(<!doctype html|<html)') AS is_html FROM (
        SELECT 'pages/' || page_id AS path, html AS body FROM pages UNION ALL SELECT 'documents/' || doc_id, text FROM documents)"""),
    "schema_variant_detect": (schema_variant_detect, f"""WITH {T.CHECKED} SELECT product_id_column, count(*) AS capture_count FROM checked GROUP BY 1"""),
    "schema_diff_message": (schema_diff_message, f"""WITH {T.CHECKED}
        SELECT path, error_message AS message FROM checked WHERE product_id_column IS NULL AND path NOT LIKE 'pages/%'"""),
    "reject_blank_key": (reject_blank_key, "SELECT c_custkey FROM customer WHERE c_acctbal < 0"),
    "reject_bad_date": (reject_bad_date, """SELECT * FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN strftime(o_orderdate, '%m/%d/%Y')
        WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-') || (day(o_orderdate) + 9) END AS order_date FROM orders)
        WHERE length(order_date) <> 10 OR try_strptime(order_date, '%Y-%m-%d') IS NULL"""),
    "single_date_per_capture": (single_date_per_capture, """SELECT l_orderkey, count(*) AS row_count FROM lineitem
        GROUP BY 1 HAVING count(DISTINCT l_shipdate) <> 1"""),
    "capture_profile": (capture_profile, f"""WITH {T.LINES} SELECT order_date, count(*) AS row_count, 9 AS column_count,
        CAST(sum(CASE WHEN loyalty_member IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_values,
        count(*) - count(DISTINCT regexp_extract(order_id, '^(\\d+-\\d+)', 1)) AS duplicate_order_ids,
        count(DISTINCT store_id) AS distinct_stores,
        count(DISTINCT coalesce(product_id, new_product_id)) AS distinct_products FROM lines GROUP BY 1"""),
    "schema_cutover": (schema_cutover, f"""WITH {T.LINES}, f AS (SELECT order_date, CASE WHEN product_id IS NOT NULL THEN 'product_id' ELSE 'new_product_id' END AS product_id_column FROM lines)
        SELECT order_date, product_id_column, count(*) AS row_count, min(min(order_date)) OVER (PARTITION BY product_id_column) AS first_date
        FROM f GROUP BY 1, 2"""),
    "capture_classify": (capture_classify, """WITH incoming AS (
          SELECT 'in/' || doc_id AS path, lang, text, lang || '/' || CASE WHEN lang = 'fr' THEN length(text) ELSE doc_id END AS order_date FROM documents),
        firsts AS (SELECT *, first_value(text) OVER (PARTITION BY order_date ORDER BY path) AS first_text,
                   row_number() OVER (PARTITION BY order_date ORDER BY path) AS n FROM incoming)
        SELECT path, order_date, CASE lang WHEN 'es' THEN 'missing_file' WHEN 'en' THEN 'unchanged'
          WHEN 'de' THEN CASE WHEN upper(text) <> text THEN 'conflict' ELSE 'unchanged' END
          ELSE CASE WHEN n = 1 THEN 'new' WHEN text = first_text THEN 'unchanged' ELSE 'conflict' END END AS capture_state FROM firsts"""),
    "latest_complete_snapshot": (latest_complete_snapshot, """SELECT max(d) AS folder_date FROM (SELECT strftime(o_orderdate, '%Y-%m-%d') AS d
        FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 2)"""),
    "audit_append": (audit_append, f"""WITH {_EVENTS} SELECT min(timestamp_utc) AS timestamp_utc, status, sort_date, sha256, error_message
        FROM log_events e WHERE NOT EXISTS (SELECT 1 FROM log_events l
          WHERE CASE WHEN l.event_type = 'click' OR (l.event_type = 'error' AND l.sort_date < '2024-01-05') THEN '' ELSE '0' END || l.sort_date = e.sort_date
            AND l.status = e.status AND l.sha256 = e.sha256 AND l.error_message = e.error_message)
        GROUP BY 2, 3, 4, 5"""),
    "audit_gaps": (audit_gaps, f"""WITH {_EVENTS} SELECT DISTINCT sort_date AS order_date, sha256 FROM log_events e WHERE status = 'success'
        AND NOT EXISTS (SELECT 1 FROM log_events l WHERE l.status = 'success'
          AND CASE WHEN l.event_type = 'signup' THEN '' ELSE '0' END || l.sort_date = e.sort_date AND l.sha256 = e.sha256)"""),
}
