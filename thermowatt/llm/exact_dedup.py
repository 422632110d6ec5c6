"""Exact deduplication by a stateful stream.

The stream keeps disk-backed state (RocksDB) without expiry. Per digest it
retains the stable identifier of the row that stays, a content locator (file
and row index) and the number of rows seen. Rows are reduced per digest before
they are shuffled to the state, so a digest that a third of all rows share
costs each task one row. Afterwards the full bytes of every hit are compared
with the bytes of the row its locator names.

Defined results: a null text is the empty text. Of equal texts the smallest
``doc_id`` stays, a null id only if all are null; among rows with the same id
the first by file and row index. Extra columns are ignored. An empty table
gives an empty result. Texts whose digests are equal but whose bytes differ
form groups of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources import shared_folder
from .common import BLANKS, private_session, stored

#: A group gets one copy of its text per so many hits to compare with, so a large group is compared by many tasks.
HITS_PER_COPY = 1000

_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Many small stores: only changes are saved after a batch, and no disk is set aside for files in advance.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{BLANKS}]+", " ")


def _rows(source: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, path, row, text, digest) of a batch or stream over Parquet files."""
    rows = source.select(
        F.col("doc_id"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.row_index").alias("row"),
        normalised(F.col("text")).alias("text"),
    )
    return rows.withColumn("digest", digest(F.col("text")))


def _keep_state(spark: SparkSession, path: str, batches: int, digest: Callable[[Column], Column]) -> DataFrame:
    """Run the stream; its final state as (digest, kept(no_id, doc_id, path, row), n)."""
    own = private_session(spark, **_STATE)
    found = own.read.parquet(path)
    size = int(str(found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    root = shared_folder(spark, "exact-dedup")
    # The last character is bracketed so that the path is a pattern, which may name a file or a folder.
    stream = (
        own.readStream.schema(found.schema)
        .option("maxBytesPerTrigger", str(max(1, -(-size // batches))))
        .parquet(f"{path[:-1]}[{path[-1]}]")
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "path", "row"))
    state = _rows(stream, digest).groupBy("digest").agg(first.alias("kept"), F.count(F.lit(1)).alias("n"))

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")

    query = (
        state.writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).foreachBatch(save).start()
    )
    query.awaitTermination()
    schema = "digest string, kept struct<no_id: boolean, doc_id: bigint, path: string, row: bigint>, n bigint"
    changes = spark.read.schema(schema).parquet(f"{root}/changes/*") if query.lastProgress else spark.createDataFrame([], schema)
    # A later batch has seen at least as many rows of the digest.
    return stored(changes.groupBy("digest").agg(F.max_by("kept", "n").alias("kept"), F.max("n").alias("n")), "exact-dedup-state")


def exact_dedup(
    spark: SparkSession,
    path: str,
    batches: int = 4,
    digest: Callable[[Column], Column] = lambda text: F.sha2(text, 256),
) -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one per row of the Parquet table at ``path``.

    The stream takes the table in about ``batches`` micro-batches by size; they share one state.
    """
    state = _keep_state(spark, path, batches, digest)
    at = F.struct("path", "row")
    marked = (
        _rows(spark.read.parquet(path), digest)
        .join(state, "digest")
        .select(
            "doc_id", "digest", "n", "path", "row",
            F.col("kept.doc_id").alias("keep_id"),
            (at == F.struct(F.col("kept.path").alias("path"), F.col("kept.row").alias("row"))).alias("kept"),
            F.sha2("text", 256).alias("text_sha256"),
            F.when(F.col("n") > 1, F.col("text")).alias("text"),
        )
    )
    marked = stored(marked, "exact-dedup-marked")
    plain = ["doc_id", "keep_id", F.col("n").alias("group_size"), "kept", "text_sha256"]

    copies = F.ceil(F.col("n") / HITS_PER_COPY)
    hits = marked.where("n > 1 AND NOT kept").withColumn("slot", F.pmod(F.xxhash64("path", "row"), copies))
    originals = marked.where("n > 1 AND kept").select(
        "digest", F.col("text").alias("original"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1)).alias("slot"),
    )
    compared = hits.join(originals, ["digest", "slot"]).withColumn("same", F.col("text") == F.col("original"))
    compared = stored(compared.withColumn("text", F.when(~F.col("same"), F.col("text"))).drop("original", "slot"), "exact-dedup-hits")

    # Normally empty: equal digests of different bytes.
    odd = compared.where("NOT same")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "path", "row"))
    odd_groups = odd.groupBy("digest", "text").agg(first.alias("first"), F.count(F.lit(1)).alias("m"))
    odd_rows = odd.join(odd_groups, ["digest", "text"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("m").alias("group_size"),
        (at == F.struct(F.col("first.path").alias("path"), F.col("first.row").alias("row"))).alias("kept"),
        "text_sha256",
    )
    fewer = stored(odd.groupBy("digest").agg(F.count(F.lit(1)).alias("odd")), "exact-dedup-odd")
    same = marked.where("n > 1 AND kept").drop("text").unionByName(compared.where("same").drop("text", "same"))
    same = same.join(fewer, "digest", "left").withColumn("n", F.col("n") - F.coalesce(F.col("odd"), F.lit(0)))
    return marked.where("n = 1").select(*plain).unionAll(same.select(*plain)).unionAll(odd_rows)
