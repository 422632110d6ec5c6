"""Rollups of closed windows, each once, with late readings beside them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from .. import contract as c
from ..operators.windows import merge_rollup_parts, parts_schema, rollup_parts
from ..sinks.external import BatchSink
from ..sinks.tables import BatchTable

_MARKS = T.StructType([T.StructField("newest", T.LongType(), False)])


@dataclass(frozen=True)
class ClosedRollups:
    """What a stream of readings leaves behind, all below one folder.

    The watermark of a batch is the newest event time of the batches before
    it, less ``delay``. A reading whose window had ended by then is late: it
    opens its window again, in a rollup of its own for that batch. All others
    go into partial sums, from which a window's rollup is made once, by the
    batch that takes the watermark past its end. Windows still open can be read
    at any time, as at a shutdown. Closed, open and late rollups together hold
    every reading once.

    No state is kept but tables: a batch overwrites only its own folders and
    reads only older ones, so it can run again. One hot device is summed up by
    many tasks.
    """

    root: str
    size: str = "1 minute"
    delay: str = "1 minute"
    decimals: int | None = None
    parts: BatchTable = field(init=False)
    late: BatchTable = field(init=False)
    closed: BatchTable = field(init=False)
    marks: BatchTable = field(init=False)

    def __post_init__(self) -> None:
        sums = parts_schema(self.decimals)
        for name, schema, ts in (
            ("parts", sums, "window_start"), ("late", sums, "window_start"), ("closed", c.ROLLUPS, "window_start"), ("marks", _MARKS, None),
        ):
            object.__setattr__(self, name, BatchTable(f"{self.root}/{name}", schema, ts, rebalance=ts is not None))

    def _watermark(self, spark: SparkSession, before: int | None = None) -> Column | None:
        """The watermark from the batches below ``before``, else from all; None if there were no readings."""
        rows = self.marks.read(spark)
        newest = (rows if before is None else rows.where(F.col("batch_id") < before)).agg(F.max("newest")).first()[0]
        return None if newest is None else F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {self.delay}")

    def _end(self) -> Column:
        return F.col("window_start") + F.expr(f"INTERVAL {self.size}")

    def _between(self, spark: SparkSession, after: Column | None, upto: Column | None) -> DataFrame:
        """Partial sums of windows that end in (after, upto]; folders of other days are not read."""
        rows = self.parts.read(spark)
        if after is not None:
            rows = rows.where((self._end() > after) & (F.col("event_date") >= F.to_date(after - F.expr(f"INTERVAL {self.size}"))))
        if upto is not None:
            rows = rows.where((self._end() <= upto) & (F.col("event_date") <= F.to_date(upto)))
        return rows

    def take(self, batch: DataFrame, batch_id: int, late_sink: BatchSink | None = None) -> None:
        """One batch of readings."""
        spark = batch.sparkSession
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = self._watermark(spark, batch_id) if batch_id else None
            is_late = F.lit(False) if before is None else F.window("event_ts", self.size)["end"] <= before
            flagged = batch.withColumn("_late", F.coalesce(is_late, F.lit(False)))
            in_time, late = (flagged.where(x).drop("_late") for x in (~F.col("_late"), F.col("_late")))
            self.parts.add(rollup_parts(in_time, self.size, self.decimals), batch_id)
            self.late.add(rollup_parts(late, self.size, self.decimals), batch_id)
            if late_sink is not None:
                late_sink(late, batch_id)
            newest = batch.agg(F.max(F.unix_micros("event_ts")).alias("newest")).where("newest IS NOT NULL")
            self.marks.add(newest, batch_id)
            now = self._watermark(spark)
            done = self.parts.read(spark).where("false") if now is None else self._between(spark, before, now)
            self.closed.add(merge_rollup_parts(done.where(F.col("batch_id") <= batch_id), self.decimals), batch_id)
        finally:
            batch.unpersist()

    def closed_rollups(self, spark: SparkSession) -> DataFrame:
        """One row per device and window that the watermark has passed."""
        return self.closed.rows(spark)

    def open_rollups(self, spark: SparkSession) -> DataFrame:
        """Rows of windows that the watermark has not passed, as they are now."""
        return merge_rollup_parts(self._between(spark, self._watermark(spark), None), self.decimals)

    def late_rollups(self, spark: SparkSession) -> DataFrame:
        """A row per device and window for each batch that had late readings of it."""
        return merge_rollup_parts(self.late.read(spark), self.decimals, ("batch_id",))

    def compact(self, spark: SparkSession, before: int) -> None:
        """Fold the batches below ``before``, of which none may run again."""
        for table in (self.parts, self.late, self.closed, self.marks):
            table.compact(spark, before)


def stream_closed_rollups(
    readings: DataFrame,
    tables: ClosedRollups,
    checkpoint: str,
    trigger: dict | None = None,
    late_sink: BatchSink | None = None,
    compact_every: int = 100,
) -> StreamingQuery:
    """Keep ``tables`` up to date from a stream of readings; ``late_sink`` gets the late ones as they are."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            tables.compact(batch.sparkSession, batch_id)
        tables.take(batch, batch_id, late_sink)

    return (
        readings.select(*c.READINGS.names)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
