"""JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..contract import READINGS, conform


def postgres_url(host: str, port: int, dbname: str) -> str:
    return f"jdbc:postgresql://{host}:{port}/{dbname}"


def read_readings_jdbc(
    spark: SparkSession,
    url: str,
    table: str = "readings",
    partitions: int = 32,
    properties: dict[str, str] | None = None,
    predicates: list[str] | None = None,
) -> DataFrame:
    """The five contract columns of a database table, read in parallel.

    By equal time ranges between the first and the last time, which a
    sub-select makes the database find; or, where rows are uneven in time, by
    one task for each of the caller's ``predicates``.
    """
    props = {"fetchsize": "10000", **(properties or {})}
    if predicates is not None:
        return conform(spark.read.jdbc(url, table, predicates=predicates, properties=props), READINGS)
    bounds = f"(SELECT MIN(\"event_ts\") AS lo, MAX(\"event_ts\") AS hi FROM {table}) b"
    lowest, highest = spark.read.jdbc(url, bounds, properties=props).select(
        F.col("lo").cast("string"), F.col("hi").cast("string")
    ).first()
    if lowest is None:
        return conform(spark.read.jdbc(url, table, properties=props), READINGS)
    ranges = {
        "partitionColumn": "event_ts", "lowerBound": lowest, "upperBound": highest, "numPartitions": str(partitions)
    }
    split = spark.read.format("jdbc").options(url=url, dbtable=table, **ranges, **props).load()
    return conform(split, READINGS)
