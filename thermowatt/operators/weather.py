"""Landed weather responses to readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import once, round_half_even, text_number

# Fixed values: (device_id, room, lat, lon) of the known stations, and the
# defaults and the power formula of the readings made from them.
STATIONS = [
    ("sensor-nyc", "NewYork-Central", 40.71, -74.00),
    ("sensor-ldn", "London-City", 51.50, -0.12),
    ("sensor-tko", "Tokyo-Shinjuku", 35.68, 139.76),
    ("sensor-bom", "Mumbai-BKC", 19.07, 72.87),
    ("sensor-syd", "Sydney-Harbor", -33.86, 151.20),
]
DEFAULT_TEMPERATURE_C = 20.0
DEFAULT_WIND = 2.0
BASE_POWER_KW = 0.8
POWER_PER_WIND = 0.15

RESPONSE_SCHEMA = "lat double, lon double, current variant"


def default_stations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATIONS, "device_id string, room string, lat double, lon double")


def _measure(field: str, default: float) -> str:
    """Number at ``current.<field>``: the default when absent, null when unusable."""
    raw = f"try_variant_get(current, '$.{field}', 'variant')"
    text = f"try_variant_get({raw}, '$', 'string')"
    number = f"if(schema_of_variant({raw}) = 'STRING', {text_number(text)}, try_variant_get({raw}, '$', 'double'))"
    return f"""CASE WHEN {raw} IS NOT NULL THEN {number}
        WHEN current IS NULL OR schema_of_variant(current) LIKE 'OBJECT%' THEN {default}D END"""


def weather_to_readings(
    responses: DataFrame, stations: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """Readings from responses ``(lat, lon, current variant)`` of known stations.

    A response whose temperature or wind is null or not a number is skipped.
    ``event_ts`` is now unless ``as_of`` is given. Works on batch and streams.
    Spark knows the size of the station table and chooses the join.
    """
    ts = F.current_timestamp() if as_of is None else as_of
    found = (
        f"named_struct('temp', {_measure('temperature_2m', DEFAULT_TEMPERATURE_C)}, "
        f"'wind', {_measure('wind_speed_10m', DEFAULT_WIND)})"
    )
    measured = (
        responses.select("lat", "lon", ts.cast("timestamp").alias("event_ts"), F.expr(found).alias("_found"))
        .selectExpr("lat", "lon", "event_ts", f"{once('_found')} AS _m")
        .where("_m.temp IS NOT NULL AND _m.wind IS NOT NULL")
    )
    places = stations.select("device_id", "room", "lat", "lon")
    power = f"{BASE_POWER_KW}D + _m.wind * {POWER_PER_WIND}D"
    return measured.join(places, ["lat", "lon"]).selectExpr(
        "device_id",
        "room",
        "event_ts",
        f"{round_half_even('_m.temp', 2)} AS temperature_c",
        f"{round_half_even(power, 3)} AS power_kw",
    )
