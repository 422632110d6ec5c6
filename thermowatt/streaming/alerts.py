"""Alerts on a stream of readings."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .. import contract as c
from ..operators.anomalies import all_alerts, sigma_alerts
from ..operators.hot_groups import SplitPolicy
from ..sinks.external import BatchSink
from .tails import DeviceTails, tune_batches


def stream_alerts(
    readings: DataFrame,
    sink: BatchSink,
    tails: DeviceTails,
    checkpoint: str,
    order_by: list[str],
    trigger: dict | None = None,
    hard_limits: bool = True,
    policy: SplitPolicy = SplitPolicy(),
    **limits: float,
) -> StreamingQuery:
    """Write alerts of each micro-batch to ``sink``; same rules and limits as the batch operators.

    A device's readings are taken in batch order, and by ``order_by`` inside a
    batch. Without ``hard_limits`` only the three-sigma rule runs.
    """
    rules = all_alerts if hard_limits else sigma_alerts

    def handle(batch: DataFrame, batch_id: int) -> None:
        tune_batches(batch.sparkSession)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seeds = tails.seeds(batch, batch_id)
            stats = tails.stats(batch, order_by, seeds, policy)
            try:
                sink(rules(batch, order_by, history=tails.history, stats=stats.given, **limits), batch_id)
                tails.advance(batch, batch_id, order_by, seeds, stats)
            finally:
                stats.drop()
        finally:
            batch.unpersist()

    return (
        readings.select(*c.READINGS.names, *[o for o in order_by if o not in c.READINGS.names])
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
