"""Tumbling-window rollups per device."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import mean_of_units, round_half_even, to_units

_KEYS = ["device_id", "window_start"]


def _parts(decimals: int | None) -> list[Column]:
    """Mergeable partial aggregates of one window."""
    temp, power = "temperature_c", "power_kw"
    if decimals is not None:
        temp, power = to_units(temp, decimals), to_units(power, decimals)
    parts = {"temp_sum": f"sum({temp})", "temp_max": "max(temperature_c)", "power_sum": f"sum({power})", "n": "count(1)"}
    return [F.expr(e).alias(name) for name, e in parts.items()]


def _finish(parts: DataFrame, decimals: int | None, start: str = "window_start") -> DataFrame:
    def mean(total: str, digits: int) -> str:
        if decimals is not None:
            return mean_of_units(total, "n", decimals, digits)
        return round_half_even(f"{total} / n", digits)

    return parts.selectExpr(
        "device_id",
        f"{start} AS window_start",
        f"{mean('temp_sum', 2)} AS avg_temp",
        f"{round_half_even('temp_max', 2)} AS max_temp",
        f"{mean('power_sum', 3)} AS avg_power",
        "cast(n AS int) AS n",
    )


def rollup(
    readings: DataFrame, size: str = "1 minute", watermark: str | None = None, decimals: int | None = None
) -> DataFrame:
    """Average and maximum temperature, average power and count per device and window.

    Windows are aligned to the epoch. One row per device and window; a late
    reading updates its row. On a stream, ``watermark`` bounds the state and
    drops readings later than it; without one nothing is ever dropped.

    With ``decimals`` the readings are taken to have that many places and are
    added up as whole numbers: exact, and the same however the rows are
    partitioned. Without it they are added as doubles.
    """
    rows = readings if watermark is None else readings.withWatermark("event_ts", watermark)
    # Group by the window itself: grouping by its start would lose the watermark.
    parts = rows.groupBy("device_id", F.window("event_ts", size)).agg(*_parts(decimals))
    return _finish(parts, decimals, "window.start")


def rollup_parts(readings: DataFrame, size: str = "1 minute", decimals: int | None = None) -> DataFrame:
    """Partial rollups that can be merged later with others of the same window."""
    parts = readings.groupBy("device_id", F.window("event_ts", size)).agg(*_parts(decimals))
    return parts.select(
        "device_id", F.col("window.start").alias("window_start"), "temp_sum", "temp_max", "power_sum", "n"
    )


def parts_schema(decimals: int | None) -> T.StructType:
    """Columns of partial rollups as a table."""
    total = T.DoubleType() if decimals is None else T.LongType()
    return T.StructType([
        T.StructField("device_id", T.StringType(), False),
        T.StructField("window_start", T.TimestampType(), False),
        T.StructField("temp_sum", total, False),
        T.StructField("temp_max", T.DoubleType(), False),
        T.StructField("power_sum", total, False),
        T.StructField("n", T.LongType(), False),
    ])


def merge_rollup_parts(parts: DataFrame, decimals: int | None = None, apart: tuple[str, ...] = ()) -> DataFrame:
    """Final rollups from any number of partial ones: one row per device and window, and per value of the columns ``apart``."""
    merged = parts.groupBy(*_KEYS, *apart).agg(
        F.sum("temp_sum").alias("temp_sum"),
        F.max("temp_max").alias("temp_max"),
        F.sum("power_sum").alias("power_sum"),
        F.sum("n").alias("n"),
    )
    return _finish(merged, decimals)
