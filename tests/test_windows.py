from collections import Counter

import pytest

from thermowatt import merge_rollup_parts, rollup, rollup_parts
from thermowatt.contract import ROLLUPS
from thermowatt.sinks import BatchTable
from thermowatt.streaming import latest_rollups, stream_rollup, versions_table

from .helpers import READING, bag, numbered, random_readings, reading


def by_window(df):
    return {(r["device_id"], r["window_start"].strftime("%H:%M")): tuple(r)[2:] for r in df.collect()}


def test_three_readings_in_one_minute(spark):
    df = numbered(spark, [reading("s", i * 10, 20 + i, 1 + i) for i in range(3)])
    assert by_window(rollup(df)) == {("s", "12:00"): (21.0, 22.0, 2.0, 3)}
    assert by_window(rollup(df, decimals=3)) == {("s", "12:00"): (21.0, 22.0, 2.0, 3)}
    assert [(f.name, f.dataType) for f in rollup(df).schema] == [(f.name, f.dataType) for f in ROLLUPS]


def test_window_borders_and_sizes(spark):
    df = numbered(spark, [reading("s", 59.999, 1, 1), reading("s", 60, 2, 1), reading("t", 60, 3, 1)])
    assert {k: v[3] for k, v in by_window(rollup(df)).items()} == {("s", "12:00"): 1, ("s", "12:01"): 1, ("t", "12:01"): 1}
    assert {k: v[3] for k, v in by_window(rollup(df, "1 hour")).items()} == {("s", "12:00"): 2, ("t", "12:00"): 1}


def test_averages_round_like_the_stored_ones(spark):
    rows = random_readings(600, 3, seed=5)
    groups = {}
    for device, _, ts, temp, power in rows:
        groups.setdefault((device, ts.strftime("%H:%M")), []).append((temp, power))
    expected = {
        k: (round(sum(t for t, _ in v) / len(v), 2), max(t for t, _ in v), round(sum(p for _, p in v) / len(v), 3), len(v))
        for k, v in groups.items()
    }
    found = by_window(rollup(numbered(spark, rows).coalesce(1)))
    assert found.keys() == expected.keys()
    close = [found[k] == pytest.approx(expected[k], abs=1.1e-2) for k in expected]
    equal = [found[k] == expected[k] for k in expected]
    assert all(close) and sum(equal) >= len(equal) - 1


def test_parts_merge_to_the_same_rollup(spark):
    df = numbered(spark, random_readings(600, 4, seed=6))
    parts = rollup_parts(df.where("seq % 3 = 0"), decimals=3).union(rollup_parts(df.where("seq % 3 <> 0"), decimals=3))
    assert bag(merge_rollup_parts(parts, decimals=3)) == bag(rollup(df, decimals=3))


LATE = [[10, 20], [30, 70], [600], [40, 570]]


@pytest.mark.parametrize("watermark, first", [(None, 4), ("60 seconds", 3)])
def test_late_readings_over_restarts(spark, tmp_path, watermark, first):
    """One file per batch; the query is stopped and started again in between."""
    table = versions_table(str(tmp_path / "out"))
    for i, seconds in enumerate(LATE):
        rows = spark.createDataFrame([reading("s", s, 20, 1) for s in seconds], READING)
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        stream_rollup(
            stream, table.add, str(tmp_path / "checkpoint"), watermark=watermark, trigger={"availableNow": True}
        ).awaitTermination()
    found = {k[1]: v[3] for k, v in by_window(latest_rollups(spark, table)).items()}
    assert found == {"12:00": first, "12:01": 1, "12:09": 1, "12:10": 1}


def test_repeated_batch_leaves_one_copy(spark, tmp_path):
    table = BatchTable(str(tmp_path / "t"), ROLLUPS, "window_start")
    rows = rollup(numbered(spark, [reading("s", 0, 20, 1), reading("s", 90000, 20, 1)]))
    table.add(rows, 0)
    table.add(rows, 0)
    table.add(rows.where("window_start > '2026-10-09'"), 1)
    assert table.rows(spark).count() == 3
    assert table.read(spark).where("event_date = '2026-10-09'").count() == 2
    assert Counter(r["batch_id"] for r in table.read(spark).collect()) == {0: 2, 1: 1}


def test_closed_windows_come_once(spark, tmp_path):
    table = versions_table(str(tmp_path / "out"))
    with pytest.raises(ValueError, match="watermark"):
        stream_rollup(numbered(spark, []), table.add, "unused", closed_only=True)
    for seconds in LATE:
        rows = spark.createDataFrame([reading("s", s, 20, 1) for s in seconds], READING)
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        stream_rollup(
            stream, table.add, str(tmp_path / "checkpoint"), watermark="60 seconds", closed_only=True,
            trigger={"availableNow": True},
        ).awaitTermination()
    found = [(r["window_start"].strftime("%H:%M"), r["n"]) for r in table.rows(spark).orderBy("window_start").collect()]
    assert found == [("12:00", 3), ("12:01", 1)]
