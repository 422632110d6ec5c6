"""Session settings the engine is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings and why they matter here.
SETTINGS = {
    # Hours, days and naive timestamps are UTC.
    "spark.sql.session.timeZone": "UTC",
    # Shuffle sizes and skewed joins are settled at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state lies on disk, off the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Building expressions does not record where each was written.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """Put the settings on a session builder.

    ``shuffle_partitions`` is the number adaptive execution starts from; take a
    few times the number of cores on a large cluster.
    """
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder
