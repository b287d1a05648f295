"""Weather requests and payloads as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DAILY_VARIABLES, WEATHER_URL

PAYLOAD = T.StructType([T.StructField("daily", T.StructType(
    [T.StructField("time", T.ArrayType(T.StringType()))]
    + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in DAILY_VARIABLES]
))])


def request_url(latitude: Column, longitude: Column, day: Column) -> Column:
    """Request for one store and one day, parameters URL-encoded."""
    text = F.date_format(day, "yyyy-MM-dd")
    parameters = {
        "latitude": latitude.cast("string"), "longitude": longitude.cast("string"),
        "start_date": text, "end_date": text,
        "daily": F.lit(",".join(DAILY_VARIABLES)), "timezone": F.lit("auto"),
    }
    pairs = [F.concat(F.lit(f"{k}="), F.url_encode(v)) for k, v in parameters.items()]
    return F.concat(F.lit(f"{WEATHER_URL}?"), F.concat_ws("&", *pairs))


def payload_position(payload: Column, day: Column) -> Column:
    """Place of the day in the payload's time list; 0 when absent."""
    return F.coalesce(F.array_position(payload["daily"]["time"], day), F.lit(0)).cast("int")


def payload_error(payload: Column, day: Column) -> Column:
    """Why a payload cannot be used; null when it can. Null readings are legal."""
    at = payload_position(payload, day)
    missing = F.lit(None).cast("string")
    for name in reversed(DAILY_VARIABLES):
        values = payload["daily"][name]
        missing = F.when(values.isNull() | (F.size(values) < at),
                         F.lit(f"Open-Meteo response is missing {name}.")).otherwise(missing)
    return (
        F.when(payload["daily"].isNull(), F.lit("Open-Meteo response has no daily weather object."))
        .when(at == 0, F.format_string("Open-Meteo returned no weather for %s.", day))
        .otherwise(missing)
    )


def reading(payload: Column, name: str, day: Column) -> Column:
    at = payload_position(payload, day)
    return F.when(at > 0, F.get(payload["daily"][name], at - 1))
