"""Rollups on a stream of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contract import ROLLUPS
from ..operators.windows import merge_rollup_parts, rollup
from ..sinks.external import BatchSink
from ..sinks.tables import BatchTable


def versions_table(path: str) -> BatchTable:
    return BatchTable(path, ROLLUPS, "window_start", rebalance=True)


def stream_rollup(
    readings: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    size: str = "1 minute",
    watermark: str | None = None,
    decimals: int | None = None,
    trigger: dict | None = None,
    closed_only: bool = False,
) -> StreamingQuery:
    """Hand rollups of a stream to ``sink``.

    Each batch hands over the windows it changed, open ones included; keep them
    in a ``versions_table`` and read the newest with ``latest_rollups``. With
    ``closed_only`` every window comes once, when the watermark has passed it,
    as a table without keys needs it.

    Set ``watermark`` on an endless stream, or the state grows with every
    window ever seen. With the settings of ``session.configure`` the state is
    kept in RocksDB, off the heap.
    """
    if closed_only and watermark is None:
        raise ValueError("a window closes by the watermark, and there is none")
    return (
        rollup(readings, size, watermark, decimals)
        .writeStream.outputMode("append" if closed_only else "update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def latest_rollups(spark: SparkSession, table: BatchTable) -> DataFrame:
    """One row per device and window: the version of the latest batch."""
    keys = ["device_id", "window_start"]
    values = [n for n in ROLLUPS.names if n not in keys]
    newest = table.read(spark).groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_row"))
    return newest.select(*keys, "_row.*")


def open_rollups(spark: SparkSession, checkpoint: str, decimals: int | None = None) -> DataFrame:
    """Rollups of the windows that a stopped ``stream_rollup`` holds in its state, from its checkpoint.

    With ``closed_only`` these are the windows the watermark has not passed:
    what is left to hand over when a stream ends for good. A stream that goes
    on hands them over itself.
    """
    state = spark.read.format("statestore").load(checkpoint)
    # The aggregates' buffers, in the order of the aggregates: names repeat there.
    total = "double" if decimals is None else "bigint"
    sums = F.col("value").cast(f"struct<temp_sum:{total},temp_max:double,power_sum:{total},n:bigint>")
    return merge_rollup_parts(
        state.select("key.device_id", F.col("key.window.start").alias("window_start"), sums.alias("_sums")).select(
            "device_id", "window_start", "_sums.*"
        ),
        decimals,
    )
