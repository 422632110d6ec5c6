"""Sinks outside Spark: databases and Kafka."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, types as T

from ..contract import enforce
from ..operators.messages import to_messages

BatchSink = Callable[[DataFrame, int], None]


def jdbc_sink(url: str, table: str, schema: T.StructType, properties: dict[str, str] | None = None) -> BatchSink:
    """Append to a database table in batches of inserts. At least once: a repeated batch is appended again."""
    props = {"batchsize": "10000", **(properties or {})}

    def add(df: DataFrame, batch_id: int) -> None:
        enforce(df, schema).write.mode("append").jdbc(url, table, properties=props)

    return add


def kafka_sink_options(servers: str, topic: str, client: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if client is not None:
        options["kafka.client.id"] = client
    return options


def kafka_sink(options: dict[str, str], key: str = "device_id") -> BatchSink:
    """Publish each row as JSON under its key. At least once."""

    def add(df: DataFrame, batch_id: int) -> None:
        to_messages(df, key).write.format("kafka").options(**options).save()

    return add
