"""Sinks."""

from .external import BatchSink, jdbc_sink, kafka_sink, kafka_sink_options
from .tables import BatchTable, write_parquet

__all__ = ["BatchSink", "BatchTable", "jdbc_sink", "kafka_sink", "kafka_sink_options", "write_parquet"]
