"""Kafka source. Needs the spark-sql-kafka package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.validation import decode

# Topic names.
RAW_TOPIC = "sensors.raw"
ALERT_TOPIC = "sensors.alerts"


def source_options(
    servers: str,
    topic: str = RAW_TOPIC,
    starting: str = "earliest",
    group: str | None = None,
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a subscription that starts at the oldest message.

    The checkpoint keeps the offsets afterwards. ``min_partitions`` splits a
    large topic partition over several tasks.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group is not None:
        options["kafka.group.id"] = group
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def messages(df: DataFrame) -> DataFrame:
    """Kafka rows with key and value as text; a tombstone becomes the empty text."""
    return df.select(
        F.col("key").cast("string").alias("key"), decode(F.col("value")).alias("value"), "partition", "offset", "timestamp"
    )


def stream_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return messages(spark.readStream.format("kafka").options(**options).load())


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The topic's present content as a batch."""
    return messages(spark.read.format("kafka").options(**options).load())
