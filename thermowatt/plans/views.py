"""The engine's input tables as views of the given ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from ..functions import once
from ..operators.validation import valid_readings, validate
from ..operators.weather import STATIONS

ORDER = ["event_ts", "event_id"]

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


_K = "cast(get_json_object(props, '$.k') AS int)"


def readings_of(ev: DataFrame) -> DataFrame:
    """Readings contract plus ``event_id``; power is a multiple of 1/8."""
    return ev.selectExpr(
        "concat('sensor-', user_id) AS device_id",
        "concat('Room-', 200 + user_id % 8) AS room",
        "cast(ts AS timestamp) AS event_ts",
        "value AS temperature_c",
        f"{_K} / 8D AS power_kw",
        "event_id",
    )


def in_range_of(readings: DataFrame) -> DataFrame:
    """Readings the contract check lets through; power cannot be negative in this view."""
    return readings.where("temperature_c BETWEEN -50D AND 120D")


def raw_messages_of(ev: DataFrame) -> DataFrame:
    """``(event_id, ts, value)``: each event as a raw JSON message, 7 in 16 of them with a defect."""
    stamped = readings_of(ev).selectExpr(
        "event_id",
        "event_ts AS ts",
        """concat('{"device_id":"', device_id, '","room":"', room, '","event_ts":"') AS head""",
        "concat(date_format(event_ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), 'Z\",') AS stamp",
        """concat('"temperature_c":', temperature_c) AS temp""",
        """concat('"power_kw":', power_kw) AS power""",
        "temperature_c",
        "power_kw",
    )
    return stamped.selectExpr(
        "event_id",
        "ts",
        """CASE event_id % 16
            WHEN 0 THEN concat(head, stamp, '"temp": BROKEN_SYNTAX}')
            WHEN 1 THEN concat(head, stamp, power, '}')
            WHEN 2 THEN concat(head, stamp, temp, ',"power_kw":null}')
            WHEN 3 THEN concat(head, stamp, temp, ',"power_kw":-99.9}')
            WHEN 4 THEN concat(head, stamp, '"temperature_c":"abc",', power, '}')
            WHEN 5 THEN concat('\\n[', temperature_c, ',', power_kw, ']')
            WHEN 6 THEN concat(head, 'bad",', temp, ',', power, '}')
            ELSE concat(head, stamp, temp, ',', power, '}') END AS value""",
    )


def weather_lines_of(ev: DataFrame) -> DataFrame:
    """``(event_id, ts, line)``: each event as a landed weather response of one of the stations.

    The shape of ``current`` depends on the event type, so absent, null and
    unusable measurements all occur.
    """
    lat = ", ".join(f"{s[2]}D" for s in STATIONS)
    lon = ", ".join(f"{s[3]}D" for s in STATIONS)
    station = f"int(user_id % {len(STATIONS)}) + 1"
    temp, wind = """'"temperature_2m":', value""", f"""'"wind_speed_10m":', {_K} / 10D"""
    current = f"""CASE event_type
        WHEN 'view' THEN concat(',"current":{{', {temp}, '}}')
        WHEN 'error' THEN ',"current":{{"temperature_2m":null}}'
        WHEN 'signup' THEN ''
        WHEN 'purchase' THEN concat(',"current":{{', {wind}, '}}')
        ELSE concat(',"current":{{', {temp}, ',', {wind}, '}}') END"""
    place = f"""'{{"lat":', element_at(array({lat}), {station}), ',"lon":', element_at(array({lon}), {station})"""
    return ev.selectExpr("event_id", "cast(ts AS timestamp) AS ts", f"concat({place}, {current}, '}}') AS line")


def weather_responses_of(lines: DataFrame) -> DataFrame:
    """Weather lines parsed to ``(lat, lon, current variant)`` and ``ts``."""
    return lines.selectExpr("ts", f"{once('try_parse_json(line)')} AS _doc").selectExpr(
        "ts",
        "try_variant_get(_doc, '$.lat', 'double') AS lat",
        "try_variant_get(_doc, '$.lon', 'double') AS lon",
        "try_variant_get(_doc, '$.current', 'variant') AS current",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(events(spark, sf_dir))


def in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_range_of(readings(spark, sf_dir))


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(raw_messages_of(events(spark, sf_dir)))


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that came through the raw-message check, with ``event_id``."""
    return valid_readings(validated(spark, sf_dir), ("event_id",))
