"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from ..contract import READINGS
from ..operators.weather import RESPONSE_SCHEMA


def read_readings(spark: SparkSession, path: str, schema: T.StructType = READINGS) -> DataFrame:
    """Readings from Parquet with the fixed schema; filters and columns reach the scan."""
    return spark.read.schema(schema).parquet(path)


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Parquet files under ``path`` (globs allowed) as a stream, ``max_files`` per batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_text(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed raw messages, one per line, as a stream with column ``value``."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Landed weather responses, one JSON object per line with the station's ``lat`` and ``lon``."""
    return spark.read.schema(RESPONSE_SCHEMA).json(path)


def stream_weather(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(RESPONSE_SCHEMA).json(path)
