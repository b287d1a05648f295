"""Store and weather queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..operators import weather as W
from ..plans.capture import weather_backfill
from ..sources.tables import cached_stores, stores_with_coordinates
from . import testbed as T
from .lines import _edge

TARGET = "1997-03-14"


def store_dim(spark, sf):
    return T.supplier_stores(spark, sf).select(*K.STORE_COLUMNS)


def stores_with_coords(spark, sf):
    return stores_with_coordinates(T.supplier_stores(spark, sf))


def weather_dim(spark, sf):
    return _edge(T.weather(spark, sf).select(*K.WEATHER_COLUMNS))


def _supplier_weather(spark, sf):
    """A cache that knows a store on the days it shipped returned goods, and other stores on other days."""
    owner = F.when(F.col("l_returnflag") == "R", "S").otherwise("Z")
    return T.table(spark, sf, "lineitem").select(
        F.concat(owner, "l_suppkey").alias("store_id"), F.to_date("l_shipdate").alias("date"))


def weather_missing_pairs(spark, sf):
    stores = stores_with_coordinates(T.supplier_stores(spark, sf))
    cached = cached_stores(_supplier_weather(spark, sf), TARGET)
    return W.missing_stores(stores, cached).select("store_id")


def _sold(spark, sf):
    return T.landed_lines(spark, sf).select("store_id", "order_date")


def weather_backfill_plan(spark, sf):
    """Every day on which a placed store sold something."""
    stores = stores_with_coordinates(T.supplier_stores(spark, sf))
    plan = W.backfill_plan(_sold(spark, sf), stores, _supplier_weather(spark, sf))
    return _edge(plan.select("store_id", "date"))


def weather_request_plan(spark, sf):
    plan = weather_backfill(_sold(spark, sf), T.supplier_stores(spark, sf), _supplier_weather(spark, sf))
    return _edge(plan.select("store_id", "date", "url"))


def _landed_payloads(spark, sf):
    """One payload per event, each broken in its own way by event type."""
    e = T.table(spark, sf, "events")
    day = T.text_day("ts")
    number = F.col("value").cast("decimal(10,2)").cast("string")

    def body(inner):
        return F.concat(F.lit('{"daily":{"time":["1999-01-01","'), day, F.lit('"],'), inner, F.lit("}}"))

    full = F.concat(
        F.lit('"temperature_2m_max":[null,'), number, F.lit('],"temperature_2m_min":[1.5,'),
        F.when(F.col("value") > 100, F.lit("null")).otherwise(number),
        F.lit('],"precipitation_sum":[0,'), number, F.lit("]"))
    payload = (
        F.when(F.col("event_type") == "error", F.col("props"))
        .when(F.col("event_type") == "signup", body(F.concat(F.lit('"temperature_2m_max":['), number, F.lit("]"))))
        .otherwise(body(full)))
    asked = F.when(F.col("event_type") == "view", F.date_add(F.to_date("ts"), 1)).otherwise(F.to_date("ts"))
    return e.select("event_id", F.col("event_id").cast("string").alias("store_id"),
                    asked.alias("date"), payload.alias("payload"))


def weather_json_parse(spark, sf):
    return _edge(W.parse_payloads(_landed_payloads(spark, sf)))


def json_extract(spark, sf):
    """The number inside each event's JSON properties."""
    parsed = F.from_json("props", "k bigint")
    return T.table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


def weather_insert_if_absent(spark, sf):
    """Readings per user and day arrive one by one; the cache has January's first week, and other stores' readings of later days."""
    events = T.table(spark, sf, "events")
    fetched = events.select(
        F.concat(F.lit("S"), "user_id").alias("store_id"), F.to_date("ts").alias("date"),
        F.col("value").alias("temperature_2m_max_c"))
    other = F.when(F.col("date") < F.lit("2024-01-08"), F.col("store_id")).otherwise(F.concat(F.lit("Z"), "store_id"))
    cached = fetched.withColumn("store_id", other)
    return _edge(W.rows_to_insert(fetched, cached))


_CACHE = """cache AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'S' ELSE 'Z' END || l_suppkey AS store_id, CAST(l_shipdate AS DATE) AS date FROM lineitem)"""
_PLAN = f"""WITH {T.SUPPLIER_STORES}, {_CACHE}, plan AS (
    SELECT DISTINCT s.store_id, CAST(l_shipdate AS DATE) AS date, s.latitude, s.longitude
    FROM lineitem JOIN stores s ON s.store_id = 'S' || l_suppkey
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM cache c WHERE c.store_id = s.store_id AND c.date = CAST(l_shipdate AS DATE)))"""

QUERIES = {
    "store_dim": (store_dim, f"WITH {T.SUPPLIER_STORES} SELECT * FROM stores"),
    "stores_with_coordinates": (stores_with_coords, f"WITH {T.SUPPLIER_STORES} SELECT store_id, latitude, longitude FROM stores WHERE latitude IS NOT NULL AND longitude IS NOT NULL"),
    "weather_dim": (weather_dim, f"""WITH {T.WEATHER} SELECT store_id, strftime(date, '%Y-%m-%d') AS date, CAST(temperature_2m_max_c AS DOUBLE) AS temperature_2m_max_c,
        CAST(temperature_2m_min_c AS DOUBLE) AS temperature_2m_min_c, CAST(precipitation_sum_mm AS DOUBLE) AS precipitation_sum_mm, source FROM weather"""),
    "weather_missing_pairs": (weather_missing_pairs, f"""WITH {T.SUPPLIER_STORES}, {_CACHE} SELECT store_id FROM stores WHERE latitude IS NOT NULL AND longitude IS NOT NULL
        AND store_id NOT IN (SELECT store_id FROM cache WHERE date = DATE '{TARGET}')"""),
    "weather_backfill_plan": (weather_backfill_plan, f"{_PLAN} SELECT store_id, strftime(date, '%Y-%m-%d') AS date FROM plan"),
    "weather_request_plan": (weather_request_plan, f"""{_PLAN} SELECT store_id, strftime(date, '%Y-%m-%d') AS date,
        '{K.WEATHER_URL}?latitude=' || CAST(latitude AS VARCHAR) || '&longitude=' || CAST(longitude AS VARCHAR)
        || '&start_date=' || strftime(date, '%Y-%m-%d') || '&end_date=' || strftime(date, '%Y-%m-%d')
        || '&daily=temperature_2m_max%2Ctemperature_2m_min%2Cprecipitation_sum&timezone=auto' AS url FROM plan"""),
    "weather_json_parse": (weather_json_parse, f"""WITH p AS (SELECT *, event_type IN ('purchase', 'click') AS ok,
          CASE WHEN event_type = 'view' THEN CAST(ts AS DATE) + 1 ELSE CAST(ts AS DATE) END AS asked FROM events)
        SELECT CAST(event_id AS VARCHAR) AS store_id, strftime(asked, '%Y-%m-%d') AS date,
          CAST(CASE WHEN ok THEN CAST(value AS DECIMAL(8,3)) END AS DOUBLE) AS temperature_2m_max_c,
          CAST(CASE WHEN ok AND value <= 100 THEN CAST(value AS DECIMAL(8,3)) END AS DOUBLE) AS temperature_2m_min_c,
          CAST(CASE WHEN ok THEN CAST(value AS DECIMAL(10,3)) END AS DOUBLE) AS precipitation_sum_mm,
          '{K.WEATHER_SOURCE}' AS source,
          CASE event_type WHEN 'error' THEN 'Open-Meteo response has no daily weather object.'
            WHEN 'signup' THEN 'Open-Meteo response is missing temperature_2m_max.'
            WHEN 'view' THEN 'Open-Meteo returned no weather for ' || strftime(asked, '%Y-%m-%d') || '.' END AS error_message
        FROM p"""),
    "json_extract": (json_extract, "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"),
    "weather_insert_if_absent": (weather_insert_if_absent, """SELECT 'S' || user_id AS store_id, strftime(ts, '%Y-%m-%d') AS date, min(value) AS temperature_2m_max_c
        FROM events WHERE NOT EXISTS (SELECT 1 FROM events c WHERE CASE WHEN c.ts < TIMESTAMP '2024-01-08' THEN 'S' ELSE 'ZS' END || c.user_id = 'S' || events.user_id
          AND CAST(c.ts AS DATE) = CAST(events.ts AS DATE)) GROUP BY 1, 2"""),
}
