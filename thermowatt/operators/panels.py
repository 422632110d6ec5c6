"""Monitoring queries over readings, alerts and rejected rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def since(df: DataFrame, interval: str, as_of: Column | datetime | None = None, ts: str = "event_ts") -> DataFrame:
    """Rows from the last ``interval`` before ``as_of`` (default now). A literal ``as_of`` reaches the scan."""
    now = F.current_timestamp() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.where(F.col(ts) >= now - F.expr(f"INTERVAL {interval}"))


def count_since(
    df: DataFrame,
    interval: str = "1 minute",
    as_of: Column | datetime | None = None,
    ts: str = "event_ts",
    name: str = "n",
) -> DataFrame:
    """Number of rows from the last ``interval``."""
    return row_count(since(df, interval, as_of, ts), name)


def count_by(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per value of ``column``, in its order."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(column)


def series(
    readings: DataFrame,
    column: str,
    start: Column | datetime | None = None,
    end: Column | datetime | None = None,
) -> DataFrame:
    """Time series ``(time, value, metric)`` of ``column`` with the room as metric, oldest first.

    Both ends of the range are included; an absent end is open.
    """
    rows = readings
    if start is not None:
        rows = rows.where(F.col("event_ts") >= (start if isinstance(start, Column) else F.lit(start)))
    if end is not None:
        rows = rows.where(F.col("event_ts") <= (end if isinstance(end, Column) else F.lit(end)))
    return rows.select(
        F.col("event_ts").alias("time"), F.col(column).alias("value"), F.col("room").alias("metric")
    ).orderBy("time")


def recent(df: DataFrame, ts: str, n: int, columns: list[str], tie_break: list[str] | None = None) -> DataFrame:
    """The ``n`` newest rows; equal times are ordered by ``tie_break`` (default: all columns)."""
    ties = columns if tie_break is None else tie_break
    return (
        df.orderBy(F.desc(ts), *[F.asc(t) for t in ties if t != ts]).limit(n).select(*columns)
    )
