"""Stateless streams into tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sinks.external import BatchSink


def stream_into(df: DataFrame, sink: BatchSink, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Hand every micro-batch of ``df`` to ``sink``."""
    return (
        df.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
