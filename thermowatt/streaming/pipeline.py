"""Raw messages to readings, rejected rows, alerts and rollups in one streaming query."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import contract as c
from ..operators.anomalies import all_alerts
from ..operators.audit import total_counters
from ..operators.hot_groups import SplitPolicy
from ..operators.windows import merge_rollup_parts, parts_schema, rollup_parts
from ..operators.validation import rejected_rows, valid_readings, validate
from ..sinks.external import BatchSink
from ..sinks.tables import BatchTable
from .tails import DeviceTails, tune_batches

_COUNTERS = ["received", "readings", "rejected", "alerts"]

@dataclass(frozen=True)
class PipelineTables:
    """The tables a pipeline writes, all below one folder.

    Rollups are stored as partial sums per batch and merged when read. That
    needs no window state, and a late reading is never lost.
    """

    root: str
    decimals: int | None = None
    readings: BatchTable = field(init=False)
    rejected: BatchTable = field(init=False)
    alerts: BatchTable = field(init=False)
    parts: BatchTable = field(init=False)
    tails: DeviceTails = field(init=False)

    def __post_init__(self) -> None:
        tables = {
            "readings": BatchTable(f"{self.root}/readings", c.READINGS, "event_ts"),
            "rejected": BatchTable(f"{self.root}/rejected", c.REJECTED, "ts"),
            "alerts": BatchTable(f"{self.root}/alerts", c.ALERTS, "event_ts", rebalance=True),
            "parts": BatchTable(
                f"{self.root}/rollup_parts", parts_schema(self.decimals), "window_start", rebalance=True
            ),
            "tails": DeviceTails(f"{self.root}/tails"),
        }
        for name, table in tables.items():
            object.__setattr__(self, name, table)

    def rollups(self, spark: SparkSession) -> DataFrame:
        """One row per device and window."""
        return merge_rollup_parts(self.parts.rows(spark), self.decimals)

    def counters(self, spark: SparkSession) -> DataFrame:
        """One row: received, readings, rejected, alerts and rollup windows so far.

        Readings, rejected rows and alerts are counted from the tables' footers; no batch writes counters.
        """

        def counted(rows: DataFrame, *names: str) -> DataFrame:
            return rows.selectExpr(*[f"{int(n in names)} AS {n}" for n in [*_COUNTERS, "aggregates"]])

        parts = [
            counted(self.readings.rows(spark), "received", "readings"), counted(self.rejected.rows(spark), "received", "rejected"),
            counted(self.alerts.rows(spark), "alerts"), counted(self.rollups(spark), "aggregates"),
        ]
        return total_counters(reduce(DataFrame.unionByName, parts))

    def compact(self, spark: SparkSession, before: int) -> None:
        """Fold the batches below ``before``, of which none may run again."""
        for table in (self.readings, self.rejected, self.alerts, self.parts):
            table.compact(spark, before)


def run_pipeline(
    raw: DataFrame,
    tables: PipelineTables,
    checkpoint: str,
    order_by: list[str],
    payload: str = "value",
    size: str = "1 minute",
    trigger: dict | None = None,
    also: dict[str, BatchSink] | None = None,
    rejected_at: str | None = None,
    policy: SplitPolicy = SplitPolicy(),
    compact_every: int = 100,
) -> StreamingQuery:
    """Start the pipeline on a stream of raw messages.

    Every message is parsed once; the checked batch is persisted while its
    outputs are written. ``order_by`` gives the arrival order inside a batch
    from the contract columns and the columns of ``raw``, for Kafka
    ``["offset", "partition"]``. ``also`` names further sinks of the
    ``readings``, ``rejected`` rows and ``alerts``, such as a topic or a
    database. Rejected rows are stamped with the batch time, or the column
    ``rejected_at``. Every ``compact_every`` batches the tables' earlier
    batches are folded, so that files do not pile up.
    """
    others = also or {}
    if unknown := others.keys() - {"readings", "rejected", "alerts"}:
        raise ValueError(f"no such output: {sorted(unknown)}")
    extra = tuple(o for o in order_by if o not in c.READINGS.names)
    stamp = F.current_timestamp() if rejected_at is None else F.col(rejected_at).cast("timestamp")
    checked = validate(raw.withColumn("_received_at", stamp), payload)
    # The text of a good message is not needed any more.
    checked = checked.withColumn("raw_payload", F.expr("if(reason_code IS NULL, NULL, raw_payload)"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id and batch_id % compact_every == 0:
            tables.compact(spark, batch_id)
        tune_batches(spark)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            readings = valid_readings(batch, extra)

            def put(name: str, rows: DataFrame) -> None:
                if name in others:
                    rows.persist(StorageLevel.MEMORY_AND_DISK)
                getattr(tables, name).add(rows, batch_id)
                if name in others:
                    others[name](rows, batch_id)
                    rows.unpersist()

            put("readings", readings)
            put("rejected", rejected_rows(batch, F.col("_received_at")))
            # Only now, as this counts the devices, and the batch is persisted by then.
            seeds = tables.tails.seeds(readings, batch_id)
            stats = tables.tails.stats(readings, order_by, seeds, policy)
            try:
                put("alerts", all_alerts(readings, order_by, history=tables.tails.history, stats=stats.given))
                tables.tails.advance(readings, batch_id, order_by, seeds, stats)
            finally:
                stats.drop()
            tables.parts.add(rollup_parts(readings, size, tables.decimals), batch_id)
        finally:
            batch.unpersist()

    return (
        checked.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
