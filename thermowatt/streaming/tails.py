"""The last readings of every device, kept between micro-batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..contract import HISTORY_LENGTH
from ..operators.history import GIVEN, NEWEST, last_rows, stats_and_newest
from ..operators.hot_groups import SplitPolicy

_SIGNALS = ["temperature_c", "power_kw"]
_SCHEMA = (
    "device_id string, "
    "tail array<struct<_position: int, temperature_c: double, power_kw: double>>, "
    "version bigint"
)


def tune_batches(spark: SparkSession) -> None:
    """Settings for what a batch persists, in the session of a batch, which is the stream's own copy of the caller's."""
    # A batch lives too shortly for its columns to be worth compressing.
    spark.conf.set("spark.sql.inMemoryColumnarStorage.compressed", "false")
    # Small shuffle partitions are joined below persisted rows as well.
    spark.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")


@dataclass(frozen=True)
class BatchStats:
    """A batch's readings with their statistics, and the seeds that stay; persisted until ``drop``."""

    rows: DataFrame
    cut_keys: DataFrame | None

    @property
    def given(self) -> DataFrame:
        """The readings alone."""
        return self.rows.where(GIVEN)

    def drop(self) -> None:
        self.rows.unpersist()


@dataclass(frozen=True)
class DeviceTails:
    """At most ``history`` readings per device, in Parquet under ``path``.

    Batch N writes ``version=N`` with the devices it touched; every
    ``full_every`` batches it writes all devices, and older versions go. A
    batch only reads versions before its own, so it can be run again.

    Unlike keyed streaming state, this lets one micro-batch of a hot device be
    worked on by many tasks.
    """

    path: str
    history: int = HISTORY_LENGTH
    full_every: int = 20

    def _folder(self, version: int) -> str:
        return f"{self.path}/version_{version}"

    def _oldest_needed(self, batch_id: int) -> int:
        return (batch_id - 1) // self.full_every * self.full_every

    def _latest(self, spark: SparkSession, batch_id: int, only: DataFrame | None = None) -> DataFrame | None:
        """Newest tail of every device, or of those in ``only``; devices are picked before versions are compared."""
        if batch_id == 0:
            return None
        folders = [self._folder(v) for v in range(self._oldest_needed(batch_id), batch_id)]
        stored = spark.read.schema(_SCHEMA).parquet(*folders)
        if only is not None:
            stored = stored.join(only, "device_id", "left_semi")
        return stored.groupBy("device_id").agg(F.max_by("tail", "version").alias("tail"))

    def seeds(self, readings: DataFrame, batch_id: int) -> DataFrame | None:
        """Stored rows ``(device_id, _position, signals...)`` of the devices in this batch."""
        touched = readings.select("device_id").distinct()
        latest = self._latest(readings.sparkSession, batch_id, touched)
        return None if latest is None else latest.select("device_id", F.inline("tail"))

    def stats(
        self, readings: DataFrame, order_by: list[str], seeds: DataFrame | None, policy: SplitPolicy = SplitPolicy()
    ) -> BatchStats:
        """What the alerts and the tails of a batch are read from, shuffled and sorted once for both."""
        rows, cut_keys = stats_and_newest(readings, "device_id", order_by, _SIGNALS, self.history, seeds, policy)
        unread = [c for c in readings.columns if c not in ("device_id", "event_ts", *_SIGNALS)]
        return BatchStats(rows.drop(*unread).persist(StorageLevel.MEMORY_AND_DISK), cut_keys)

    def _newest(
        self, readings: DataFrame, order_by: list[str], seeds: DataFrame | None, stats: BatchStats | None
    ) -> DataFrame:
        """The last rows per device, of cut devices from the readings."""
        if stats is None:
            return last_rows(readings, "device_id", order_by, _SIGNALS, self.history, seeds)
        place = (self.history - F.col(NEWEST)).cast("int").alias("_position")
        newest = stats.rows.where(F.col(NEWEST) <= self.history).select("device_id", place, *_SIGNALS)
        if stats.cut_keys is None:
            return newest
        cut = F.broadcast(stats.cut_keys)
        of_cut = [None if rows is None else rows.join(cut, "device_id", "left_semi") for rows in (readings, seeds)]
        hot = last_rows(of_cut[0], "device_id", order_by, _SIGNALS, self.history, of_cut[1])
        return newest.join(cut, "device_id", "left_anti").unionByName(hot)

    def advance(
        self, readings: DataFrame, batch_id: int, order_by: list[str], seeds: DataFrame | None, stats: BatchStats | None = None
    ) -> None:
        """Store the state after this batch."""
        spark = readings.sparkSession
        newest = self._newest(readings, order_by, seeds, stats)
        rows = newest.groupBy("device_id").agg(
            F.collect_list(F.struct("_position", *_SIGNALS)).alias("tail")
        )
        latest = self._latest(spark, batch_id)
        if latest is not None and batch_id % self.full_every == 0:
            touched = readings.select("device_id").distinct()
            rows = rows.unionByName(latest.join(touched, "device_id", "left_anti"))
        rows.withColumn("version", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            self._folder(batch_id)
        )
        oldest = self._oldest_needed(batch_id)
        if batch_id > 1 and oldest == batch_id - 1:
            for version in range(oldest - self.full_every, oldest):
                self._remove(spark, self._folder(version))

    @staticmethod
    def _remove(spark: SparkSession, folder: str) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
