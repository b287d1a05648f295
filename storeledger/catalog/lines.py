"""Order-line queries: typing, resolution, dimension, silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import normalize_name, parse_currency, trim_ws, unknown_label
from ..operators import dimension as D
from ..operators import quality as Q
from ..operators import silver as S
from ..sources.orders import read_orders
from . import testbed as T


def _edge(df):
    """Dates as text and decimals as doubles, for comparison."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f.name)
        if kind == "date":
            c = T.text_day(f.name)
        elif kind == "decimal":
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


def _orders(spark, sf):
    return S.type_orders(T.landed_lines(spark, sf))


def _resolved(spark, sf):
    return S.resolve_canonical(_orders(spark, sf), T.crosswalk(spark, sf))


def _dimension(spark, sf):
    return D.product_dimension(
        T.crosswalk(spark, sf), T.legacy_products(spark, sf), T.new_products(spark, sf))


def src_orders_schema_drift(spark, sf):
    """Lines that were written as dated capture files under three kinds of header, read back from these."""
    root = T.written_captures(spark, sf)
    return read_orders(spark, root, "orders*.csv").select("order_id", "order_date", "product_id", "new_product_id", "sales_channel")


def silver_typed(spark, sf):
    return _edge(_orders(spark, sf))


def parse_prices(spark, sf):
    lines = T.landed_lines(spark, sf)
    return lines.select("order_id", parse_currency(F.col("unit_price")).cast("double").alias("unit_price"))


def trim_keys(spark, sf):
    """Names padded with several kinds of white space, stripped again."""
    padded = F.concat(F.lit(" \t "), "c_name", F.lit(" \r\n"))
    return T.table(spark, sf, "customer").select("c_custkey", trim_ws(padded).alias("c_name"))


def line_net_sales(spark, sf):
    return S.add_net_sales(_orders(spark, sf)).select("order_id", F.col("net_sales").cast("double").alias("net_sales"))


def exact_dedup(spark, sf):
    orders = S.type_orders(T.landed_with_copies(spark, sf))
    return _edge(S.drop_exact_duplicates(orders))


def duplicates_removed(spark, sf):
    """Rows of each date that exact_dedup takes out."""
    counts = S.duplicate_counts(S.type_orders(T.landed_with_copies(spark, sf)))
    return counts.withColumn("order_date", T.text_day("order_date"))


def conflicting_order_ids(spark, sf):
    return S.conflicting_ids(T.line_key_orders(spark, sf).distinct())


def canonical_id_resolve(spark, sf):
    return _resolved(spark, sf).select("order_id", "product_id", "new_product_id", "canonical_product_id")


def unresolved_ids(spark, sf):
    """Lines that lost both keys: those sold at the largest discount."""
    orders = _orders(spark, sf)
    keep = F.col("discount_pct") < 10
    lost = orders.withColumns({
        "product_id": F.when(keep, F.col("product_id")),
        "new_product_id": F.when(keep, F.col("new_product_id"))})
    return S.unresolved(S.resolve_canonical(lost, T.crosswalk(spark, sf))).select("order_id")


def unknown_member_fill(spark, sf):
    """Parts as dimension members with gaps; each gap is labelled on its own."""
    gap = F.col("p_size")
    members = T.table(spark, sf, "part").select(
        F.concat(F.lit("NP"), "p_partkey").alias("canonical_product_id"),
        F.when(gap > 10, F.col("p_name")).alias("canonical_product_name"),
        F.when(gap > 20, F.col("p_brand")).alias("canonical_brand"),
        F.when(gap > 30, F.col("p_type")).alias("canonical_category"),
        F.when(gap > 40, F.col("p_type")).alias("canonical_subcategory"))
    return S.fill_unknown(members)


def product_dimension(spark, sf):
    return _dimension(spark, sf)


def unmatched_legacy(spark, sf):
    return D.unmatched_legacy(T.crosswalk(spark, sf), T.legacy_products(spark, sf))


def silver_enrich(spark, sf):
    return _edge(S.enrich(_resolved(spark, sf), _dimension(spark, sf)))


def silver_invariants(spark, sf):
    return S.silver_invariants(S.enrich(_resolved(spark, sf), _dimension(spark, sf)))


def duplicate_keys(spark, sf):
    return Q.duplicate_keys(T.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def product_input_checks(spark, sf):
    """Part names as ids, blank for the smallest size."""
    names = T.table(spark, sf, "part").select(
        F.when(F.col("p_size") == 1, F.lit("  ")).otherwise(F.concat_ws(" ", "p_name", "p_brand", "p_size")).alias("id"))
    return Q.product_input_checks(names, "id")


def missing_dates(spark, sf):
    """Days without an order between the first and the last; orders of each month's 7th and 21st are entered a day late."""
    day = F.to_date("o_orderdate")
    entered = F.when(F.dayofmonth(day).isin(7, 21), F.date_add(day, 1)).otherwise(day)
    orders = T.table(spark, sf, "orders").select(entered.alias("entered"))
    return Q.missing_dates(orders, "entered").select(T.text_day("missing_date").alias("missing_date"))


def table_row_counts(spark, sf):
    names = ("lineitem", "orders", "part", "supplier", "customer", "events", "documents", "pages")
    return Q.table_row_counts({n: T.table(spark, sf, n) for n in names})


RENAMED = {"brand": "brand_name", "category": "department", "subcategory": "class"}


def schema_snapshot_diff(spark, sf):
    return D.schema_diff(T.legacy_products(spark, sf), T.new_products(spark, sf))


def attribute_value_diff(spark, sf):
    return D.attribute_value_diff(T.legacy_products(spark, sf), T.new_products(spark, sf), RENAMED)


def normalized_names(spark, sf):
    texts = T.table(spark, sf, "documents").select("doc_id", normalize_name(F.col("text")).alias("n"))
    return texts.select("doc_id", F.length("n").cast("bigint").alias("n_length"), F.sha2("n", 256).alias("n_sha256"))


def unknown_product_labels(spark, sf):
    return T.table(spark, sf, "part").select(
        "p_partkey", unknown_label(F.concat(F.lit("NP"), "p_partkey")).alias("label"),
    ).withColumn("is_unknown", F.startswith("label", F.lit("Unknown Product (")))


_LINE_OUT = """order_id, order_date, store_id, product_id, new_product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
    CAST(discount_pct AS DOUBLE) AS discount_pct, sales_channel, loyalty_member"""
_ENRICHED = f"""WITH {T.LINES}, {T.DIMENSION}, {T.RESOLVED}, enriched AS (
    SELECT r.order_id, r.order_date, r.store_id, r.product_id, r.new_product_id, r.canonical_product_id,
      coalesce(d.canonical_product_name, 'Unknown Product (' || r.canonical_product_id || ')') AS canonical_product_name,
      coalesce(d.canonical_brand, 'Unknown Brand') AS canonical_brand,
      coalesce(d.canonical_category, 'Unknown Category') AS canonical_category,
      coalesce(d.canonical_subcategory, 'Unknown Subcategory') AS canonical_subcategory,
      r.quantity, CAST(r.unit_price AS DOUBLE) AS unit_price, CAST(r.discount_pct AS DOUBLE) AS discount_pct,
      CAST(r.quantity * r.unit_price AS DOUBLE) AS net_sales, r.sales_channel, r.loyalty_member
    FROM resolved r LEFT JOIN dimension d USING (canonical_product_id))"""

QUERIES = {
    "src_orders_schema_drift": (src_orders_schema_drift, f"WITH {T.LINES} SELECT order_id, order_date, product_id, new_product_id, sales_channel FROM lines"),
    "silver_typed": (silver_typed, f"WITH {T.LINES} SELECT {_LINE_OUT} FROM lines"),
    "parse_currency": (parse_prices, f"WITH {T.LINES} SELECT order_id, CAST(unit_price AS DOUBLE) AS unit_price FROM lines"),
    "trim_keys": (trim_keys, "SELECT c_custkey, c_name FROM customer"),
    "line_net_sales": (line_net_sales, f"WITH {T.LINES} SELECT order_id, CAST(quantity * unit_price AS DOUBLE) AS net_sales FROM lines"),
    "exact_dedup": (exact_dedup, f"""WITH {T.LINES} SELECT {_LINE_OUT} FROM (SELECT DISTINCT * FROM (
        SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_returnflag = 'R'))"""),
    "duplicates_removed": (duplicates_removed, f"""WITH {T.LINES}, landed AS (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_returnflag = 'R')
        SELECT a.order_date, landed_rows, kept_rows, landed_rows - kept_rows AS removed_rows
        FROM (SELECT order_date, count(*) AS landed_rows FROM landed GROUP BY 1) a
        JOIN (SELECT order_date, count(*) AS kept_rows FROM (SELECT DISTINCT * FROM landed) GROUP BY 1) b ON a.order_date = b.order_date"""),
    "conflicting_order_ids": (conflicting_order_ids, """SELECT order_id, count(*) AS row_count FROM (SELECT DISTINCT l_orderkey || '-' || l_linenumber AS order_id,
        l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem) GROUP BY 1 HAVING count(*) > 1"""),
    "canonical_id_resolve": (canonical_id_resolve, f"WITH {T.LINES}, {T.PRODUCTS}, {T.RESOLVED} SELECT order_id, product_id, new_product_id, canonical_product_id FROM resolved"),
    "unresolved_ids": (unresolved_ids, f"WITH {T.LINES} SELECT order_id FROM lines WHERE discount_pct >= 10"),
    "unknown_member_fill": (unknown_member_fill, """SELECT 'NP' || p_partkey AS canonical_product_id,
        CASE WHEN p_size > 10 THEN p_name ELSE 'Unknown Product (NP' || p_partkey || ')' END AS canonical_product_name,
        CASE WHEN p_size > 20 THEN p_brand ELSE 'Unknown Brand' END AS canonical_brand,
        CASE WHEN p_size > 30 THEN p_type ELSE 'Unknown Category' END AS canonical_category,
        CASE WHEN p_size > 40 THEN p_type ELSE 'Unknown Subcategory' END AS canonical_subcategory FROM part"""),
    "product_dimension": (product_dimension, f"WITH {T.DIMENSION} SELECT * FROM dimension"),
    "unmatched_legacy": (unmatched_legacy, f"""WITH {T.PRODUCTS} SELECT product_id AS canonical_product_id, product_name AS canonical_product_name,
        brand AS canonical_brand, category AS canonical_category, subcategory AS canonical_subcategory FROM legacy_products
        WHERE product_id NOT IN (SELECT legacy_product_id FROM crosswalk WHERE legacy_product_id IS NOT NULL)"""),
    "silver_enrich": (silver_enrich, f"{_ENRICHED} SELECT * FROM enriched"),
    "silver_invariants": (silver_invariants, f"""{_ENRICHED} SELECT
        (SELECT count(*) FROM (SELECT order_id FROM enriched GROUP BY 1 HAVING count(*) > 1)) AS duplicate_order_ids,
        count(*) FILTER (WHERE canonical_product_name LIKE 'Unknown Product (%' AND canonical_product_id IS NULL) AS unknown_without_id,
        count(*) FILTER (WHERE canonical_product_name IS NULL) AS missing_names,
        count(*) FILTER (WHERE canonical_brand IS NULL OR canonical_category IS NULL OR canonical_subcategory IS NULL) AS missing_attributes
        FROM enriched"""),
    "duplicate_keys": (duplicate_keys, "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"),
    "product_input_checks": (product_input_checks, """WITH ids AS (SELECT CASE WHEN p_size = 1 THEN '  ' ELSE p_name || ' ' || p_brand || ' ' || p_size END AS id, count(*) AS n FROM part GROUP BY 1)
        SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(CASE WHEN trim(id) = '' THEN n ELSE 0 END) AS BIGINT) AS blank_ids,
        count(*) FILTER (WHERE n > 1) AS repeated_ids FROM ids"""),
    "missing_dates": (missing_dates, """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) + CASE WHEN day(o_orderdate) IN (7, 21) THEN 1 ELSE 0 END AS d FROM orders)
        SELECT strftime(s, '%Y-%m-%d') AS missing_date FROM (SELECT unnest(generate_series((SELECT min(d) FROM d)::TIMESTAMP, (SELECT max(d) FROM d)::TIMESTAMP, INTERVAL 1 DAY)) AS s)
        WHERE CAST(s AS DATE) NOT IN (SELECT d FROM d)"""),
    "table_row_counts": (table_row_counts, " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}"
        for n in ("lineitem", "orders", "part", "supplier", "customer", "events", "documents", "pages"))),
    "schema_snapshot_diff": (schema_snapshot_diff, f"""SELECT column_name, CASE WHEN count(*) = 2 THEN 'retained' WHEN min(side) = 'old' THEN 'removed' ELSE 'added' END AS change FROM (
        SELECT column_name, 'old' AS side FROM (DESCRIBE WITH {T.PRODUCTS} SELECT * FROM legacy_products)
        UNION ALL SELECT column_name, 'new' FROM (DESCRIBE WITH {T.PRODUCTS} SELECT * FROM new_products)) GROUP BY 1"""),
    "attribute_value_diff": (attribute_value_diff, "WITH " + T.PRODUCTS + " " + " UNION ALL ".join(
        f"""SELECT '{old}' AS attribute, v AS value, 'legacy_only' AS side FROM (SELECT {old} AS v FROM legacy_products EXCEPT SELECT {now} FROM new_products)
        UNION ALL SELECT '{old}', v, 'new_only' FROM (SELECT {now} AS v FROM new_products EXCEPT SELECT {old} FROM legacy_products)"""
        for old, now in RENAMED.items())),
    "normalize_name": (normalized_names, """SELECT doc_id, length(n) AS n_length, sha256(n) AS n_sha256 FROM (SELECT doc_id,
        array_to_string(regexp_extract_all(replace(replace(lower(text), 'ß', 'ss'), '&', ' and '), '[a-z0-9]+'), ' ') AS n FROM documents)"""),
    "unknown_product_label": (unknown_product_labels, "SELECT p_partkey, 'Unknown Product (NP' || p_partkey || ')' AS label, true AS is_unknown FROM part"),
}
