"""Parquet tables written by batches and streams."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..contract import enforce
from ..sources.workspace import drop_folder, list_folder


def write_parquet(df: DataFrame, path: str) -> bool:
    """Write snappy Parquet in the readings' own columns; no rows, no file. Tells whether it wrote.

    Rows are counted as they are written, so nothing is computed twice.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.option("compression", "snappy").mode("overwrite").parquet(path)
    if not seen.get["n"]:
        drop_folder(df.sparkSession, path)
        return False
    return True


@dataclass(frozen=True)
class BatchTable:
    """A Parquet table that streaming batches add rows to.

    Rows lie under ``event_date=…/batch_id=…`` (``batch_id=…`` without a time
    column). A batch overwrites only its own folders, so running it again after
    a failure leaves the table as if it had run once. Readers filter by
    ``event_date`` to prune folders. With ``rebalance`` the rows are first
    spread by date into files of even size: for rows that come out of a
    shuffle, where every task would write a file for every date.

    ``compact`` folds batches that are closed into one folder per date, beside
    the table. Folded parts cover ranges of batches and double in length, so
    there are only as many as the logarithm of the number of batches. Readers
    take the complete parts and the batches after them.
    """

    path: str
    schema: T.StructType
    ts: str | None = None
    rebalance: bool = False

    def add(self, df: DataFrame, batch_id: int) -> None:
        self._write(self._laid_out(df, batch_id))

    def _laid_out(self, df: DataFrame, batch_id: int) -> DataFrame:
        rows = enforce(df, self.schema).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        if self.ts is not None:
            rows = rows.withColumn("event_date", F.to_date(self.ts))
            if self.rebalance:
                rows = rows.hint("rebalance", "event_date")
        return rows

    def _write(self, rows: DataFrame) -> None:
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy(*([] if self.ts is None else ["event_date"]), "batch_id")
            .parquet(self.path)
        )

    def _columns(self) -> T.StructType:
        folders = [T.StructField("batch_id", T.LongType())]
        if self.ts is not None:
            folders.insert(0, T.StructField("event_date", T.DateType()))
        return T.StructType([*self.schema.fields, *folders])

    def _fold(self, start: int, stop: int) -> str:
        return f"{self.path}-folded/{start}-{stop}"

    def _folds(self, spark: SparkSession) -> list[tuple[int, int]]:
        """Complete folded parts, [start, stop) in batches."""
        done = list_folder(spark, f"{self.path}-folded/*/_SUCCESS")
        return [tuple(map(int, path.split("/")[-2].split("-"))) for path in done]

    def _cover(self, spark: SparkSession) -> list[tuple[int, int]]:
        """The longest complete parts, one after the other from batch 0 on."""
        folds, cover, at = self._folds(spark), [], 0
        while own := [f for f in folds if f[0] == at]:
            cover.append(max(own))
            at = cover[-1][1]
        return cover

    def _parts(self, spark: SparkSession, cover: list[tuple[int, int]]) -> list[DataFrame]:
        columns = self._columns()
        return [spark.read.schema(columns).parquet(self._fold(*f)).select(*columns.names) for f in cover]

    def _batches(self, spark: SparkSession, start: int) -> DataFrame:
        return spark.read.schema(self._columns()).parquet(self.path).where(F.col("batch_id") >= start)

    def compact(self, spark: SparkSession, before: int) -> None:
        """Fold all batches with an id below ``before``; none of them may run again.

        What an earlier call has folded is deleted first, so readers that began
        before this call keep their files. A call that fails can be repeated.
        """
        cover = self._cover(spark)
        at = cover[-1][1] if cover else 0
        for path in list_folder(spark, f"{self.path}/{'' if self.ts is None else 'event_date=*/'}batch_id=*"):
            if int(path.rsplit("=", 1)[1]) < at:
                drop_folder(spark, path)
        for own in self._folds(spark):
            if own not in cover and own[1] <= at:
                drop_folder(spark, self._fold(*own))
        if before <= at:
            return
        start, rows = at, [self._batches(spark, at).where(F.col("batch_id") < before)]
        while cover and cover[-1][1] - cover[-1][0] <= before - start:
            start = cover[-1][0]
            rows += self._parts(spark, [cover.pop()])
        folded = reduce(DataFrame.unionByName, rows)
        if self.ts is not None:
            folded = folded.hint("rebalance", "event_date")
        writer = folded.write.mode("overwrite").option("compression", "snappy")
        (writer if self.ts is None else writer.partitionBy("event_date")).parquet(self._fold(start, before))

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows; ``batch_id`` and ``event_date`` are kept for pruning."""
        cover = self._cover(spark)
        newer = self._batches(spark, cover[-1][1] if cover else 0)
        return reduce(DataFrame.unionByName, self._parts(spark, cover), newer)

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows in the table's own columns."""
        return self.read(spark).select(*self.schema.names)
