"""Weather cache: what is missing, what a payload says, what to append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DAILY_VARIABLES, WEATHER_COLUMNS, WEATHER_MEASURES, WEATHER_SOURCE
from ..functions import weather_json as J
from ..schemas import WEATHER


def missing_stores(stores: DataFrame, cached: DataFrame) -> DataFrame:
    """Stores with coordinates that have no cached weather among ``cached`` store ids."""
    return stores.join(cached.select("store_id"), "store_id", "left_anti")


def backfill_plan(sold: DataFrame, stores: DataFrame, weather: DataFrame) -> DataFrame:
    """Every (store, order date) of ``sold`` without cached weather, for stores with coordinates.

    Gold needs weather where something was sold; planning from the sales grows
    with the data, where stores times dates would not.
    """
    pairs = sold.select("store_id", F.col("order_date").cast("date").alias("date")).distinct()
    pending = pairs.join(weather.select("store_id", "date"), ["store_id", "date"], "left_anti")
    return pending.join(stores.select("store_id", "latitude", "longitude"), "store_id")


def request_plan(pending: DataFrame) -> DataFrame:
    """One request URL per pending (store, date)."""
    return pending.withColumn(
        "url", J.request_url(F.col("latitude"), F.col("longitude"), F.col("date")))


def parse_payloads(landed: DataFrame) -> DataFrame:
    """Landed JSON (``store_id``, ``date``, ``payload``) -> readings and an error text."""
    day = F.date_format("date", "yyyy-MM-dd")
    # Parsed behind a generator, so that a filter on the error does not parse again.
    parsed = landed.select(
        "store_id", "date", F.explode(F.array(F.from_json("payload", J.PAYLOAD))).alias("_p"))
    readings = [
        J.reading(F.col("_p"), variable, day).cast(WEATHER[measure].dataType).alias(measure)
        for variable, measure in zip(DAILY_VARIABLES, WEATHER_MEASURES)
    ]
    return parsed.select(
        "store_id", "date", *readings, F.lit(WEATHER_SOURCE).alias("source"),
        F.when(F.col("_p").isNull(), "Open-Meteo response has no daily weather object.")
        .otherwise(J.payload_error(F.col("_p"), day)).alias("error_message"),
    )


def usable_weather(parsed: DataFrame) -> DataFrame:
    return parsed.where("error_message is null").select(*WEATHER_COLUMNS)


def rows_to_insert(fetched: DataFrame, cached: DataFrame) -> DataFrame:
    """Rows whose (store, date) is not cached yet, one per key.

    Of several rows for one key the smallest by its values is kept, so a rerun
    keeps the same one; the choice is an aggregate that combines before the shuffle.
    """
    columns = [c for c in fetched.columns if c not in ("store_id", "date")]
    fresh = fetched.join(cached.select("store_id", "date"), ["store_id", "date"], "left_anti")
    row = F.struct(*columns)
    return fresh.groupBy("store_id", "date").agg(F.min(row).alias("r")).select(
        "store_id", "date", "r.*")
