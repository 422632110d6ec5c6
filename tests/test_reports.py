from collections import Counter, defaultdict

from thermowatt import (
    anomaly_count, by_device, cached, count_by, count_since, readings_per_device, recent, room_daily_power,
    room_hourly_temperature, row_count, series, since, to_messages, top_anomalous_devices,
)
from pyspark.sql import functions as F

from .helpers import at, bag, numbered, reading


def table(spark):
    return numbered(spark, [
        reading("b", 0, 20, 1, "R2"), reading("a", 10, 50, 1, "R1"), reading("a", 3700, 40, 11, "R1"),
        reading("c", 20, 46, 12, "R2"), reading("b", 80000, 46, 2.5, "R2"),
    ])


def test_hourly_temperature(spark):
    rows = [(r[0], r[1].strftime("%d %H"), r[2], r[3]) for r in room_hourly_temperature(table(spark)).collect()]
    assert rows == [("R1", "08 12", 50.0, 50.0), ("R1", "08 13", 40.0, 40.0), ("R2", "08 12", 33.0, 46.0), ("R2", "09 10", 46.0, 46.0)]
    assert bag(room_hourly_temperature(table(spark), decimals=2)) == bag(room_hourly_temperature(table(spark)))


def test_daily_power(spark):
    rows = [(r[0], r[1].day, r[2]) for r in room_daily_power(table(spark)).collect()]
    assert rows == [("R1", 8, 12.0), ("R2", 8, 13.0), ("R2", 9, 2.5)]
    assert bag(room_daily_power(table(spark), decimals=3)) == bag(room_daily_power(table(spark)))


def test_top_devices_break_ties_by_name(spark):
    assert [tuple(r) for r in top_anomalous_devices(table(spark), 2).collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in readings_per_device(table(spark)).collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert anomaly_count(table(spark)).first()[0] == 4


def test_counts(spark):
    df = table(spark)
    assert row_count(df).first()[0] == 5
    assert count_since(df, "1 minute", at(70)).first()[0] == 4
    assert count_since(df, "1 minute", F.lit("2026-10-09 10:13:20").cast("timestamp")).first()[0] == 1
    assert [r["device_id"] for r in since(df, "1 hour", at(80000)).collect()] == ["b"]
    assert [tuple(r) for r in count_by(df, "room").collect()] == [("R1", 2), ("R2", 3)]


def test_series_and_recent(spark):
    df = table(spark)
    found = series(df, "power_kw", at(10), at(3700))
    assert found.columns == ["time", "value", "metric"]
    assert [(r["value"], r["metric"]) for r in found.collect()] == [(1.0, "R1"), (12.0, "R2"), (11.0, "R1")]
    assert series(df, "temperature_c").count() == 5
    same = numbered(spark, [reading(d, 0, 20, 1) for d in "dbca"])
    assert [r[0] for r in recent(same, "event_ts", 3, ["device_id", "event_ts"]).collect()] == ["a", "b", "c"]


def test_messages(spark):
    rows = to_messages(table(spark).limit(1), columns=["device_id", "event_ts", "power_kw"]).collect()
    assert [tuple(r) for r in rows] == [
        ("b", '{"device_id":"b","event_ts":"2026-10-08T12:00:00+00:00","power_kw":1.0}')
    ]
    raw = spark.createDataFrame([("k", "{broken")], "device_id string, payload string")
    assert tuple(to_messages(raw, text="payload").first()) == ("k", "{broken")


def test_layout_hints_keep_the_rows(spark):
    df = table(spark)
    placed = by_device(df, 4)
    homes = defaultdict(set)
    for r in placed.select("device_id", F.spark_partition_id().alias("p")).collect():
        homes[r["device_id"]].add(r["p"])
    assert placed.rdd.getNumPartitions() == 4 and all(len(p) == 1 for p in homes.values())
    assert bag(by_device(df)) == bag(df)
    kept = cached(df)
    assert kept.is_cached and Counter(kept.collect()) == Counter(df.collect())
    kept.unpersist()
