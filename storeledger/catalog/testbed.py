"""Retail concepts derived from the driver's tables, whole tables throughout.

The tables hold no order files, so order lines come from ``lineitem``, products
from ``part``, stores from ``supplier`` or ``nation``, weather from ``events``
and raw payloads from ``pages`` and ``documents``. Each function has its SQL
counterpart next to it.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..frames import spread
from ..functions.text import trim_ws
from ..session import configure, shared_folder
from ..sources.capture_files import write_capture_files
from ..sources.orders import union_variants

CUTOVER = "1998-07-01"


# Row keys of the tables whose rows take real work each.
_ROW_KEYS = {
    "lineitem": ("l_orderkey", "l_linenumber"), "events": ("event_id",),
    "documents": ("doc_id",), "pages": ("page_id",),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    rows = configure(spark).read.parquet(f"{sf.rstrip('/')}/{name}.parquet")
    return spread(rows, *_ROW_KEYS[name]) if name in _ROW_KEYS else rows


def money(column) -> F.Column:
    return F.col(column).cast("decimal(18,2)")


def text_day(column) -> F.Column:
    return F.date_format(column, "yyyy-MM-dd")


# ---------------------------------------------------------------- order lines

def _landed(spark, sf):
    """Order lines as landed text; the product key is still a bare number."""
    li = table(spark, sf, "lineitem")
    plain = money("l_extendedprice").cast("string")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("order_id"),
        text_day("l_shipdate").alias("order_date"),
        F.concat(F.lit("S"), "l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("key"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        F.when(F.col("l_linestatus") == "O",
               F.concat(F.lit(" $"), F.format_number("l_extendedprice", 2)))
        .otherwise(plain).alias("unit_price"),
        (F.col("l_discount").cast("decimal(9,2)") * 100).cast("int").cast("string").alias("discount_pct"),
        F.when(F.col("l_returnflag") == "R", "in_store").when(
            F.col("l_returnflag") == "A", "pickup").otherwise("ship_from_store").alias("sales_channel"),
        F.when(F.col("l_tax") > 0, F.when(F.col("l_tax") > 0.04, "Y").otherwise("N")).alias("loyalty_member"),
        "l_shipdate", "l_returnflag",
    )


def _variants(lines):
    day = F.col("l_shipdate") < F.lit(CUTOVER).cast("timestamp_ntz")
    legacy = lines.where(day).withColumn("product_id", F.concat(F.lit("P"), "key"))
    new = lines.where(~day).withColumn("new_product_id", F.concat(F.lit("NP"), "key"))
    return union_variants(legacy.drop("key", "l_shipdate", "l_returnflag"),
                          new.drop("key", "l_shipdate", "l_returnflag"))


def landed_lines(spark, sf) -> DataFrame:
    """Both header variants, united; ids are unique per line."""
    return _variants(_landed(spark, sf))


def landed_with_copies(spark, sf) -> DataFrame:
    """Landed lines plus a second delivery of the returned ones, prices written anew."""
    lines = _landed(spark, sf)
    copies = lines.where("l_returnflag = 'R'").withColumn(
        "unit_price", F.concat(F.lit("$"), F.translate(trim_ws(F.col("unit_price")), "$,", "")))
    return _variants(lines.unionByName(copies))


_CAPTURE_LINES = 50_000  # what a capture file holds at most, roughly: some four megabytes


def written_captures(spark, sf) -> str:
    """All lines as capture files of their days, in a new folder: legacy or migrated keys, half of the days with dates first."""
    rows = _variants(_landed(spark, sf))
    quoted = F.concat(F.lit('"'), "unit_price", F.lit('"'))
    key = F.coalesce("product_id", "new_product_id")
    rest = [F.col("store_id"), key, F.col("quantity"), quoted, F.col("discount_pct"), F.col("sales_channel"), F.coalesce("loyalty_member", F.lit(""))]
    dates_first = F.dayofmonth(F.to_date("order_date")) % 2 == 0
    line = F.when(dates_first, F.concat_ws(",", "order_date", "order_id", *rest)).otherwise(F.concat_ws(",", "order_id", "order_date", *rest))
    name = F.when(F.col("product_id").isNotNull(), "product_id").otherwise("new_product_id")
    first = F.when(dates_first, "order_date,order_id").otherwise("order_id,order_date")
    header = F.concat(first, F.lit(",store_id,"), name, F.lit(",quantity,unit_price,discount_pct,sales_channel,loyalty_member"))
    busiest = rows.groupBy("order_date").count().agg(F.max("count")).first()[0] or 0
    part = F.pmod(F.xxhash64("order_id"), F.lit(1 + busiest // _CAPTURE_LINES))
    files = rows.groupBy(F.col("order_date").alias("folder_date"), header.alias("header"), part.alias("part")).agg(F.collect_list(line).alias("lines"))
    root = f"{shared_folder(spark)}/storeledger/captures-{uuid4().hex}"
    content = F.concat(F.col("header"), F.lit("\n"), F.array_join("lines", "\n"), F.lit("\n"))
    write_capture_files(files.select(
        "folder_date", F.format_string("orders-%s-%d.csv", F.xxhash64("header").cast("string"), "part").alias("name"), F.encode(content, "UTF-8").alias("content")), root)
    return root


# One typed line per lineitem row.
LINES = f"""
lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_id,
         strftime(l_shipdate, '%Y-%m-%d') AS order_date,
         'S' || l_suppkey AS store_id,
         CASE WHEN l_shipdate < TIMESTAMP '{CUTOVER}' THEN 'P' || l_partkey END AS product_id,
         CASE WHEN l_shipdate >= TIMESTAMP '{CUTOVER}' THEN 'NP' || l_partkey END AS new_product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price,
         CAST(round(l_discount * 100) AS INTEGER) AS discount_pct,
         CASE l_returnflag WHEN 'R' THEN 'in_store' WHEN 'A' THEN 'pickup' ELSE 'ship_from_store' END AS sales_channel,
         CASE WHEN l_tax > 0.04 THEN 'Y' WHEN l_tax > 0 THEN 'N' END AS loyalty_member,
         l_returnflag
  FROM lineitem)
"""


def line_key_orders(spark, sf) -> DataFrame:
    """Lines under order-and-line-number ids, which several rows share."""
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        text_day("l_shipdate").alias("order_date"),
        "l_partkey", "l_suppkey", "l_quantity", money("l_extendedprice").alias("unit_price"))


# ------------------------------------------------------------------- products

def crosswalk(spark, sf) -> DataFrame:
    """Approved mappings: small sizes map other products, large ones have no predecessor."""
    other = F.when(F.col("p_size") <= 5, "Q").otherwise("P")
    return table(spark, sf, "part").select(
        F.when(F.col("p_size") <= 45, F.concat(other, "p_partkey")).alias("legacy_product_id"),
        F.concat(F.lit("N"), other, "p_partkey").alias("canonical_product_id"),
        F.initcap("p_name").alias("canonical_product_name"),
    )


def legacy_products(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        F.concat(F.when(F.col("p_size") == 10, "Q").otherwise("P"), "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("size "), "p_size").alias("subcategory"),
        F.col("p_retailprice").alias("base_price"),
    )


def new_products(spark, sf) -> DataFrame:
    """The migrated master: two sizes got ids of their own, some names and brands changed."""
    return table(spark, sf, "part").select(
        F.concat(F.when(F.col("p_size").isin(3, 20), "NR").otherwise("NP"), "p_partkey").alias("new_product_id"),
        F.when(F.col("p_type") == "PROMO", F.concat("p_name", F.lit(" Pro")))
        .when(F.col("p_type") == "LARGE", F.replace("p_name", F.lit(" "), F.lit("")))
        .otherwise(F.col("p_name")).alias("item_name"),
        F.when(F.col("p_type") == "SMALL", F.replace("p_brand", F.lit("Brand#"), F.lit("House ")))
        .otherwise(F.col("p_brand")).alias("brand_name"),
        F.when(F.col("p_type") == "MEDIUM", "MIDSIZE").otherwise(F.col("p_type")).alias("department"),
        F.concat(F.lit("size "), "p_size").alias("class"),
        (F.col("p_retailprice") + F.col("p_size")).alias("msrp"),
    )


PRODUCTS = """
crosswalk AS (
  SELECT CASE WHEN p_size <= 5 THEN 'Q' || p_partkey WHEN p_size <= 45 THEN 'P' || p_partkey END AS legacy_product_id,
         CASE WHEN p_size <= 5 THEN 'NQ' ELSE 'NP' END || p_partkey AS canonical_product_id,
         upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:] || ' '
           || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS canonical_product_name
  FROM part),
legacy_products AS (
  SELECT CASE WHEN p_size = 10 THEN 'Q' ELSE 'P' END || p_partkey AS product_id, p_name AS product_name, p_brand AS brand,
         p_type AS category, 'size ' || p_size AS subcategory, p_retailprice AS base_price
  FROM part),
new_products AS (
  SELECT CASE WHEN p_size IN (3, 20) THEN 'NR' ELSE 'NP' END || p_partkey AS new_product_id,
         CASE p_type WHEN 'PROMO' THEN p_name || ' Pro' WHEN 'LARGE' THEN replace(p_name, ' ', '') ELSE p_name END AS item_name,
         CASE WHEN p_type = 'SMALL' THEN replace(p_brand, 'Brand#', 'House ') ELSE p_brand END AS brand_name,
         CASE WHEN p_type = 'MEDIUM' THEN 'MIDSIZE' ELSE p_type END AS department,
         'size ' || p_size AS class, p_retailprice + p_size AS msrp
  FROM part)
"""

DIMENSION = PRODUCTS + """,
dimension AS (
  SELECT n.new_product_id AS canonical_product_id,
         coalesce(x.canonical_product_name, n.item_name) AS canonical_product_name,
         n.brand_name AS canonical_brand, n.department AS canonical_category, n.class AS canonical_subcategory
  FROM new_products n LEFT JOIN crosswalk x ON x.canonical_product_id = n.new_product_id
  UNION ALL
  SELECT x.canonical_product_id, x.canonical_product_name, 'Unknown Brand', 'Unknown Category', 'Unknown Subcategory'
  FROM crosswalk x WHERE NOT EXISTS (SELECT 1 FROM new_products n WHERE n.new_product_id = x.canonical_product_id)
  UNION ALL
  SELECT l.product_id, l.product_name, l.brand, l.category, l.subcategory
  FROM legacy_products l WHERE NOT EXISTS (SELECT 1 FROM crosswalk x WHERE x.legacy_product_id = l.product_id))
"""

RESOLVED = """
resolved AS (
  SELECT l.*, coalesce(x.canonical_product_id, l.new_product_id, l.product_id) AS canonical_product_id
  FROM lines l LEFT JOIN crosswalk x ON x.legacy_product_id = l.product_id)
"""

# --------------------------------------------------------------------- stores

def supplier_stores(spark, sf) -> DataFrame:
    """One store per supplier; those in debt have no coordinates."""
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    placed = F.col("s_acctbal") >= 0
    return (
        s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("S"), "s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"),
            F.col("n_name").alias("city"), F.concat(F.lit("N"), "n_nationkey").alias("state"),
            F.col("r_name").alias("region"),
            F.when(F.col("s_acctbal") > 5000, "flagship").otherwise("standard").alias("store_type"),
            F.when(placed, F.col("s_acctbal") / 200).alias("latitude"),
            F.when(placed, (F.col("n_nationkey") + 1) * -2.5).cast("double").alias("longitude"))
    )


SUPPLIER_STORES = """
stores AS (
  SELECT 'S' || s_suppkey AS store_id, s_name AS store_name, n_name AS city, 'N' || n_nationkey AS state,
         r_name AS region, CASE WHEN s_acctbal > 5000 THEN 'flagship' ELSE 'standard' END AS store_type,
         CASE WHEN s_acctbal >= 0 THEN s_acctbal / 200 END AS latitude,
         CASE WHEN s_acctbal >= 0 THEN CAST((n_nationkey + 1) * -2.5 AS DOUBLE) END AS longitude
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def nation_stores(spark, sf) -> DataFrame:
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.concat(F.when(F.col("r_name") == "EUROPE", "X").otherwise("N"), "n_nationkey", F.lit(" ")).alias("store_id"), F.col("n_name").alias("store_name"),
        F.lower("n_name").alias("city"), F.substring("n_name", 8, 2).alias("state"),
        F.col("r_name").alias("region"), F.lit("retail").alias("store_type"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        (-F.col("n_nationkey")).cast("double").alias("longitude"))


NATION_STORES = """
stores AS (
  SELECT CASE WHEN r_name = 'EUROPE' THEN 'X' ELSE 'N' END || n_nationkey AS store_id, n_name AS store_name, lower(n_name) AS city, substr(n_name, 8, 2) AS state,
         r_name AS region, 'retail' AS store_type, CAST(n_nationkey AS DOUBLE) AS latitude,
         CAST(-n_nationkey AS DOUBLE) AS longitude
  FROM nation JOIN region ON n_regionkey = r_regionkey)
"""

# -------------------------------------------------------------------- weather

def store_days(spark, sf) -> DataFrame:
    """Readings per nation and day of the month, from all events."""
    return table(spark, sf, "events").groupBy(
        F.concat(F.lit("N"), F.col("user_id") % 25).alias("store_id"),
        F.dayofmonth("ts").alias("day"),
    ).agg(
        F.max(F.col("value").cast("decimal(8,3)")).alias("temperature_2m_max_c"),
        F.min(F.col("value").cast("decimal(8,3)")).alias("temperature_2m_min_c"),
        F.sum(F.col("value").cast("decimal(10,3)")).cast("decimal(10,3)").alias("precipitation_sum_mm"),
    )


def weather(spark, sf) -> DataFrame:
    """Store weather on every date an order was placed, repeated month by month."""
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return store_days(spark, sf).join(days, F.dayofmonth("date") == F.col("day")).select(
        "store_id", "date", *K.WEATHER_MEASURES, F.lit(K.WEATHER_SOURCE).alias("source"))


WEATHER = f"""
store_days AS (
  SELECT 'N' || (user_id % 25) AS store_id, day(ts) AS day,
         max(CAST(value AS DECIMAL(8,3))) AS temperature_2m_max_c,
         min(CAST(value AS DECIMAL(8,3))) AS temperature_2m_min_c,
         CAST(sum(CAST(value AS DECIMAL(10,3))) AS DECIMAL(10,3)) AS precipitation_sum_mm
  FROM events GROUP BY 1, 2),
weather AS (
  SELECT store_id, CAST(o_orderdate AS DATE) AS date, temperature_2m_max_c, temperature_2m_min_c,
         precipitation_sum_mm, '{K.WEATHER_SOURCE}' AS source
  FROM store_days JOIN (SELECT DISTINCT o_orderdate FROM orders) ON day(o_orderdate) = day)
"""

# ------------------------------------------------------------- silver for gold

def silver_lines(spark, sf) -> DataFrame:
    """Silver order lines: nations as stores, part types as products, padded keys."""
    li, s, p = (table(spark, sf, t) for t in ("lineitem", "supplier", "part"))
    lines = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    return (
        lines.join(s.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(p.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.to_date("l_shipdate").alias("order_date"),
            F.concat(F.lit(" N"), "s_nationkey").alias("store_id"),
            F.concat(F.lit("T-"), "p_type", F.lit(" ")).alias("canonical_product_id"),
            F.concat(F.lit("Family "), "p_type").alias("canonical_product_name"),
            F.lower("p_type").alias("canonical_brand"),
            F.substring("p_type", 1, 1).alias("canonical_category"),
            F.when(F.col("p_type") != "PROMO", F.length("p_type").cast("string")).alias("canonical_subcategory"),
            F.col("l_quantity").cast("int").alias("quantity"),
            money("l_extendedprice").alias("net_sales"))
    )


SILVER = """
silver AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_shipdate AS DATE) AS order_date,
         'N' || s_nationkey AS store_id, 'T-' || p_type AS canonical_product_id,
         'Family ' || p_type AS canonical_product_name, lower(p_type) AS canonical_brand,
         substr(p_type, 1, 1) AS canonical_category,
         CASE WHEN p_type <> 'PROMO' THEN CAST(length(p_type) AS VARCHAR) END AS canonical_subcategory,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS net_sales
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)
"""

GOLD = SILVER + "," + NATION_STORES + "," + WEATHER + """,
daily AS (
  SELECT order_date, store_id, canonical_product_id, count(DISTINCT order_id) AS order_count,
         CAST(sum(quantity) AS BIGINT) AS units_sold, sum(net_sales) AS net_sales
  FROM silver GROUP BY 1, 2, 3),
attributes AS (
  SELECT DISTINCT canonical_product_id, canonical_product_name, canonical_brand, canonical_category,
         canonical_subcategory FROM silver),
gold AS (
  SELECT d.order_date, d.store_id, d.canonical_product_id, a.canonical_product_name, a.canonical_brand,
         a.canonical_category, a.canonical_subcategory, s.store_name, s.city, s.state, s.region, s.store_type,
         s.latitude, s.longitude, d.order_count, d.units_sold, d.net_sales, w.temperature_2m_max_c,
         w.temperature_2m_min_c, w.precipitation_sum_mm, w.source,
         s.store_id IS NOT NULL AS has_store, w.store_id IS NOT NULL AS has_weather
  FROM daily d
  LEFT JOIN attributes a ON a.canonical_product_id = d.canonical_product_id
  LEFT JOIN stores s ON s.store_id = d.store_id
  LEFT JOIN weather w ON w.store_id = d.store_id AND w.date = d.order_date)
"""

# ------------------------------------------------------------- capture files

_HEADERS = {
    "legacy": ",".join(K.LEGACY_ORDER_COLUMNS),
    "new": ",".join(K.MIGRATED_ORDER_COLUMNS),
    "reordered": ",".join((K.MIGRATED_ORDER_COLUMNS[1], K.MIGRATED_ORDER_COLUMNS[0],
                           *K.MIGRATED_ORDER_COLUMNS[2:])),
}


def order_captures(spark, sf) -> DataFrame:
    """One small capture per order line: three header forms, and the faults a
    capture can have, chosen by line number."""
    return captures_of(table(spark, sf, "lineitem"))


def captures_of(li: DataFrame) -> DataFrame:
    """The captures of some ``lineitem`` rows, batch or stream."""
    line, flag, faulty = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus") == "O"
    # Parts that several forms of a file share are columns of their own, so that each is made once.
    parts = li.select(
        "l_linenumber", "l_returnflag", "l_linestatus", "l_tax", "l_shipdate", text_day("l_shipdate").alias("day"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("oid"),
        F.when(flag == "A", _HEADERS["legacy"]).when(flag == "N", _HEADERS["new"]).otherwise(
            _HEADERS["reordered"]).alias("header"),
        F.concat(
            F.lit(",S"), F.col("l_suppkey"), F.when(flag == "A", ",P").otherwise(",NP"), F.col("l_partkey"), F.lit(","),
            F.col("l_quantity").cast("int"), F.lit(',"$'), F.format_number("l_extendedprice", 2),
            F.lit('",0,pickup,N')).alias("tail"))

    def row(order_id, date):
        first = F.when(flag == "R", F.concat_ws(",", date, order_id)).otherwise(
            F.concat_ws(",", order_id, date))
        return F.concat(first, F.col("tail"))

    day, oid, header, good = F.col("day"), F.col("oid"), F.col("header"), F.col("good")
    next_day = F.date_format(F.date_add(F.to_date("l_shipdate"), 1), "yyyy-MM-dd")
    body = (
        F.when(faulty & (line == 1), F.concat(header, F.lit("\n"), good, F.lit("\n"), row(oid, next_day), F.lit("\n")))
        .when(faulty & (line == 2), F.concat(header, F.lit("\n"), good, F.lit("\n\n"), good, F.lit(",\n")))
        .when(faulty & (line == 3), F.concat(header, F.lit("\n")))
        .when(faulty & (line == 4), F.concat(header, F.lit("\n"), good, F.lit("\n"), row(F.lit("  "), day)))
        .when(faulty & (line == 5), F.concat(header, F.lit("\n"), row(oid, F.date_format("l_shipdate", "MM/dd/yyyy"))))
        .when(faulty & (line == 6), F.concat(F.replace(header, F.lit("quantity"), F.lit("qty")), F.lit("\n"), good))
        .when(faulty & (line == 7), F.concat(F.lit("﻿"), header, F.lit("\r\n"), good, F.lit("\r\n")))
        .otherwise(F.concat(header, F.lit("\n"), good, F.lit("\n")))
    )
    folder = F.when(F.col("l_tax") == 0.08, next_day).otherwise(day)
    return parts.withColumn("good", row(oid, day)).select(
        F.concat(F.lit("landing/"), folder, F.lit("/"), oid, F.lit(".csv")).alias("path"),
        F.encode(body, "UTF-8").alias("content"))


def text_captures(spark, sf) -> DataFrame:
    """Payloads that are no order files at all: web pages and prose, whole."""
    pages = table(spark, sf, "pages").select(
        F.concat(F.lit("pages/"), "page_id").alias("path"), F.encode("html", "UTF-8").alias("content"))
    documents = table(spark, sf, "documents").select(
        F.concat(F.lit("documents/"), "doc_id").alias("path"), F.encode("text", "UTF-8").alias("content"))
    return pages.unionByName(documents)


def captures(spark, sf) -> DataFrame:
    return order_captures(spark, sf).unionByName(text_captures(spark, sf))


# Checked captures by construction: what the rules must find is known from how
# the files were made, so the SQL parses no CSV.
CHECKED = f"""
parts AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS oid,
         strftime(l_shipdate, '%Y-%m-%d') AS day,
         strftime(CAST(l_shipdate AS DATE) + 1, '%Y-%m-%d') AS next_day,
         strftime(l_shipdate, '%m/%d/%Y') AS us_day,
         CASE WHEN l_linestatus = 'O' THEN l_linenumber ELSE 0 END AS kind,
         l_returnflag AS flag, l_tax,
         CASE l_returnflag WHEN 'A' THEN '{_HEADERS["legacy"]}' WHEN 'N' THEN '{_HEADERS["new"]}'
              ELSE '{_HEADERS["reordered"]}' END AS header,
         ',S' || l_suppkey || CASE WHEN l_returnflag = 'A' THEN ',P' ELSE ',NP' END || l_partkey || ','
           || CAST(l_quantity AS INTEGER) || ',"$' || format('{{:,.2f}}', l_extendedprice) || '",0,pickup,N' AS tail
  FROM lineitem),
bodies AS (
  SELECT *, CASE WHEN flag = 'R' THEN day || ',' || oid ELSE oid || ',' || day END || tail AS good,
         CASE WHEN flag = 'R' THEN next_day || ',' || oid ELSE oid || ',' || next_day END || tail AS later,
         CASE WHEN flag = 'R' THEN day || ',  ' ELSE '  ,' || day END || tail AS blank,
         CASE WHEN flag = 'R' THEN us_day || ',' || oid ELSE oid || ',' || us_day END || tail AS bad
  FROM parts),
order_files AS (
  SELECT 'landing/' || CASE WHEN l_tax = 0.08 THEN next_day ELSE day END || '/' || oid || '.csv' AS path,
         CASE WHEN l_tax = 0.08 THEN next_day ELSE day END AS folder,
         CASE kind WHEN 1 THEN header || chr(10) || good || chr(10) || later || chr(10)
                   WHEN 2 THEN header || chr(10) || good || chr(10) || chr(10) || good || ',' || chr(10)
                   WHEN 3 THEN header || chr(10)
                   WHEN 4 THEN header || chr(10) || good || chr(10) || blank
                   WHEN 5 THEN header || chr(10) || bad
                   WHEN 6 THEN replace(header, 'quantity', 'qty') || chr(10) || good
                   WHEN 7 THEN chr(65279) || header || chr(13) || chr(10) || good || chr(13) || chr(10)
                   ELSE header || chr(10) || good || chr(10) END AS body,
         CASE kind WHEN 1 THEN '{K.MSG_MANY_DATES}'
                   WHEN 2 THEN 'Row 3 contains extra CSV fields.'
                   WHEN 3 THEN '{K.MSG_NO_ROWS}'
                   WHEN 4 THEN 'Row 3 has no order_id.'
                   WHEN 5 THEN 'Row 2 has an invalid order_date: ''' || us_day || '''.'
                   WHEN 6 THEN CASE WHEN flag = 'A' THEN 'Missing columns: new_product_id, quantity; Unexpected columns: qty'
                                    ELSE 'Missing columns: product_id, quantity; Unexpected columns: qty' END
              END AS error_message,
         CASE WHEN kind IN (1, 2, 4) THEN 2 WHEN kind IN (3, 6) THEN 0 ELSE 1 END AS row_count,
         CASE WHEN kind NOT IN (3, 6) THEN CASE WHEN kind = 5 THEN us_day ELSE day END END AS order_date,
         CASE WHEN kind <> 6 THEN CASE WHEN flag = 'A' THEN 'product_id' ELSE 'new_product_id' END END AS product_id_column
  FROM bodies),
document_files AS (
  SELECT 'documents/' || doc_id AS path, text AS body,
         list_sort(list_distinct(string_split(regexp_extract(text, '^([^\\r\\n]*)', 1), ','))) AS names
  FROM documents),
known AS (SELECT list_sort(['{"','".join(sorted(set(K.LEGACY_ORDER_COLUMNS) | set(K.MIGRATED_ORDER_COLUMNS)))}']) AS cols),
checked AS (
  SELECT path, sha256(body) AS sha256, octet_length(encode(body)) AS file_size_bytes, row_count, order_date,
         product_id_column, error_message, folder FROM order_files
  UNION ALL
  SELECT 'pages/' || page_id, sha256(html), octet_length(encode(html)), 0, NULL, NULL, '{K.MSG_HTML}', NULL FROM pages
  UNION ALL
  SELECT path, sha256(body), octet_length(encode(body)), 0, NULL, NULL,
         'Missing columns: ' || array_to_string([c FOR c IN cols IF NOT list_contains(names, c)], ', ')
         || '; Unexpected columns: ' || array_to_string([n FOR n IN names IF NOT list_contains(cols, n)], ', '), NULL
  FROM document_files, known)
"""
