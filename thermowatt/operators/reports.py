"""Historical reports over the readings table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import contract as c
from ..functions import day_of, hour_of, mean_of_units, sum_of_units, to_units
from .anomalies import anomalous_readings


def room_hourly_temperature(readings: DataFrame, decimals: int | None = None) -> DataFrame:
    """Average and maximum temperature per room and UTC hour, in that order.

    ``decimals`` switches to exact whole-number sums, see ``rollup``.
    """
    if decimals is None:
        average = "round(avg(temperature_c), 2)"
    else:
        total = f"sum({to_units('temperature_c', decimals)})"
        average = mean_of_units(total, "count(temperature_c)", decimals, 2)
    return (
        readings.groupBy("room", F.expr(hour_of("event_ts")).alias("hour_window"))
        .agg(F.expr(average).alias("avg_temp"), F.expr("round(max(temperature_c), 2)").alias("max_temp"))
        .orderBy("room", "hour_window")
    )


def room_daily_power(readings: DataFrame, decimals: int | None = None) -> DataFrame:
    """Sum of the power readings per room and UTC day, in that order."""
    if decimals is None:
        total = "round(sum(power_kw), 2)"
    else:
        total = sum_of_units(f"sum({to_units('power_kw', decimals)})", decimals, 2)
    return (
        readings.groupBy("room", F.expr(day_of("event_ts")).alias("day_window"))
        .agg(F.expr(total).alias("total_power_kw"))
        .orderBy("room", "day_window")
    )


def top_anomalous_devices(
    readings: DataFrame, n: int = 10, temp_max: float = c.TEMP_LIMIT_C, power_max: float = c.POWER_LIMIT_KW
) -> DataFrame:
    """The ``n`` devices with most readings over a hard limit."""
    return (
        anomalous_readings(readings, temp_max, power_max)
        .groupBy("device_id")
        .agg(F.count(F.lit(1)).alias("anomaly_count"))
        .orderBy(F.desc("anomaly_count"), F.asc("device_id"))
        .limit(n)
    )


def readings_per_device(readings: DataFrame) -> DataFrame:
    """Reading count of every device, most first."""
    return (
        readings.groupBy("device_id")
        .agg(F.count(F.lit(1)).alias("reading_count"))
        .orderBy(F.desc("reading_count"), F.asc("device_id"))
    )


def anomaly_count(
    readings: DataFrame, temp_max: float = c.TEMP_LIMIT_C, power_max: float = c.POWER_LIMIT_KW
) -> DataFrame:
    """Number of readings over a hard limit."""
    return anomalous_readings(readings, temp_max, power_max).agg(F.count(F.lit(1)).alias("anomaly_count"))
