import uuid
from datetime import datetime

import pytest

from thermowatt.contract import ALERTS, READINGS, breaks_contract, conform, enforce
from thermowatt.sinks import jdbc_sink, kafka_sink_options, write_parquet
from thermowatt.sources import postgres_url, read_readings, read_readings_jdbc, shared_folder, source_options
from thermowatt.sources.kafka import messages

from .helpers import bag, numbered, random_readings


def test_parquet_export_keeps_the_contract(spark, tmp_path):
    df = conform(numbered(spark, random_readings(50, 3, seed=1)), READINGS)
    assert write_parquet(df, str(tmp_path / "out"))
    assert bag(read_readings(spark, str(tmp_path / "out"))) == bag(df)
    assert all(".snappy." in p.name for p in (tmp_path / "out").glob("*.parquet"))


def test_no_rows_no_file(spark, tmp_path):
    df = conform(numbered(spark, random_readings(5, 3, seed=1)), READINGS)
    assert not write_parquet(df.where("temperature_c > 1000"), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    write_parquet(conform(numbered(spark, random_readings(50, 3, seed=1)), READINGS), str(tmp_path / "out"))
    df = read_readings(spark, str(tmp_path / "out")).where("temperature_c > 45").select("device_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(temperature_c,45.0)" in plan
    assert "ReadSchema: struct<device_id:string,temperature_c:double>" in plan


def test_database_export_and_append(spark):
    """Embedded database inside this process; nothing listens on a port."""
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    df = conform(numbered(spark, random_readings(80, 4, seed=2)), READINGS)
    jdbc_sink(url, "readings", READINGS, {"createTableColumnTypes": "device_id VARCHAR(64), room VARCHAR(64)"})(df, 0)
    found = read_readings_jdbc(spark, url, partitions=5)
    assert found.rdd.getNumPartitions() == 5
    assert bag(found) == bag(df)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in READINGS]
    jdbc_sink(url, "readings", READINGS)(df.limit(1), 1)
    assert read_readings_jdbc(spark, url, partitions=1).count() == 81


def test_empty_database_table(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    df = conform(numbered(spark, random_readings(5, 3, seed=1)), READINGS)
    jdbc_sink(url, "readings", READINGS, {"createTableColumnTypes": "device_id VARCHAR(64), room VARCHAR(64)"})(df.limit(0), 0)
    assert read_readings_jdbc(spark, url).count() == 0


def test_database_address():
    assert postgres_url("db", 5432, "telemetry") == "jdbc:postgresql://db:5432/telemetry"


def test_kafka_options():
    assert source_options("broker:9092") == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "sensors.raw", "startingOffsets": "earliest",
    }
    full = source_options("b:1", "t", "latest", "group-1", 500, 12)
    assert full["kafka.group.id"] == "group-1"
    assert (full["maxOffsetsPerTrigger"], full["minPartitions"]) == ("500", "12")
    assert kafka_sink_options("b:1", "sensors.alerts", "alerts") == {
        "kafka.bootstrap.servers": "b:1", "topic": "sensors.alerts", "kafka.client.id": "alerts",
    }


def test_kafka_rows_are_decoded(spark):
    rows = [(bytearray(b"k"), bytearray("é{".encode()), 0, 5, datetime(2026, 1, 1)), (None, None, 1, 6, datetime(2026, 1, 1))]
    df = spark.createDataFrame(rows, "key binary, value binary, partition int, offset long, timestamp timestamp")
    assert [(r["key"], r["value"], r["offset"]) for r in messages(df).collect()] == [("k", "é{", 5), (None, "", 6)]


def test_contract_is_enforced(spark):
    df = spark.createDataFrame([("d", datetime(2026, 1, 1), "t", 1.0, "extra")], "device_id string, event_ts timestamp, type string, value double, x string")
    assert enforce(df, ALERTS).columns == ALERTS.names
    broken = df.selectExpr("device_id", "event_ts", "cast(null as string) as type", "value")
    assert broken.where(breaks_contract(ALERTS)).count() == 1
    with pytest.raises(Exception, match="NOT NULL"):
        enforce(broken, ALERTS).collect()


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(base) and one != two
