"""Physical hints: placement by device and caching."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def by_device(df: DataFrame, n: int | None = None) -> DataFrame:
    """Partition by device: by hash into ``n`` partitions, or into even ones of as many as fit.

    Even partitions may share a device that is too large for one of them.
    """
    return df.hint("rebalance", "device_id") if n is None else df.repartition(n, "device_id")


def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Persist and fill the cache. The caller unpersists."""
    kept = df.persist(level)
    kept.count()
    return kept
