"""Closed, open and late rollups of streams."""

from collections import Counter

import pytest

from thermowatt import rollup
from thermowatt.streaming import ClosedRollups, open_rollups, stream_closed_rollups, stream_rollup

from .helpers import at, bag, numbered, random_readings, reading

ONCE = {"availableNow": True}


def land(df, folder, low, high):
    df.where(f"seq >= {low} and seq < {high}").coalesce(1).write.mode("append").parquet(folder)


def stream(spark, df, folder):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


# Four batches, windows of a minute, delay a minute: 12:00 closes in the third one and opens again in the last.
BATCHES = [[10, 20], [30, 70], [600], [40, 570, 45]]


def test_late_readings_open_their_window_again(spark, tmp_path):
    rows = [reading("s", at, 20.0, 1.0) for batch in BATCHES for at in batch]
    df, folder, seq, lates = numbered(spark, rows), str(tmp_path / "in"), 0, []
    tables = ClosedRollups(str(tmp_path / "out"), decimals=3)
    for batch in BATCHES:
        land(df, folder, seq, seq + len(batch))
        seq += len(batch)
        stream_closed_rollups(
            stream(spark, df, folder), tables, str(tmp_path / "check"), ONCE, lambda late, _: lates.extend(late.collect()), compact_every=2
        ).awaitTermination()
    start = lambda r: r.window_start.timestamp() - at(0).timestamp()
    assert sorted((start(r), r.n) for r in tables.closed_rollups(spark).collect()) == [(0, 3), (60, 1)]
    assert sorted((start(r), r.n) for r in tables.late_rollups(spark).collect()) == [(0, 2)]
    assert sorted((start(r), r.n) for r in tables.open_rollups(spark).collect()) == [(540, 1), (600, 1)]
    assert len(lates) == 2


def test_every_reading_once_over_batches_failures_and_folds(spark, tmp_path):
    rows = random_readings(300, 4, seed=21)
    df, folder = numbered(spark, rows), str(tmp_path / "in")
    tables, failing = ClosedRollups(str(tmp_path / "out"), "10 seconds", "5 seconds", 3), {"left": 1}

    def sink(late, batch_id):
        if batch_id == 2 and failing["left"]:
            failing["left"] = 0
            raise RuntimeError("lost")

    def run():
        stream_closed_rollups(stream(spark, df, folder), tables, str(tmp_path / "check"), ONCE, sink, compact_every=2).awaitTermination()

    for low, high in ((0, 90), (150, 200), (90, 150), (200, 300)):
        land(df, folder, low, high)
        try:
            run()
        except Exception as e:
            assert "lost" in str(e)
            run()
    assert not failing["left"]
    parts = [tables.closed_rollups(spark), tables.open_rollups(spark), tables.late_rollups(spark)]
    counts = Counter()
    for part in parts:
        for r in part.collect():
            counts[r.device_id, r.window_start] += r.n
    assert counts == Counter({(r.device_id, r.window_start): r.n for r in rollup(df, "10 seconds").collect()})
    closed = [(r.device_id, r.window_start) for r in parts[0].collect()]
    assert len(closed) == len(set(closed)) and parts[2].count()


def test_nothing_yet(spark, tmp_path):
    df = numbered(spark, [reading("s", 0, 20.0, 1.0)])
    tables = ClosedRollups(str(tmp_path / "out"))
    tables.take(df.where("seq > 5"), 0)
    assert tables.open_rollups(spark).count() == tables.closed_rollups(spark).count() == tables.late_rollups(spark).count() == 0
    tables.take(df, 1)
    assert tables.open_rollups(spark).count() == 1


@pytest.mark.parametrize("decimals", [3, None])
def test_open_windows_from_a_checkpoint(spark, tmp_path, decimals):
    df, folder, got = numbered(spark, random_readings(200, 3, seed=22)), str(tmp_path / "in"), []
    land(df, folder, 0, 200)
    stream_rollup(
        stream(spark, df, folder), lambda rows, _: got.extend(rows.collect()), str(tmp_path / "check"), "10 seconds", "10 seconds", decimals,
        ONCE, closed_only=True,
    ).awaitTermination()
    left = open_rollups(spark, str(tmp_path / "check"), decimals).collect()
    assert left and got
    # Sums of doubles depend on the order they are added in.
    exact = ("device_id", "window_start", "max_temp", "n", *(("avg_temp", "avg_power") if decimals else ()))
    assert Counter(tuple(r[c] for c in exact) for r in got + left) == bag(rollup(df, "10 seconds", decimals=decimals), *exact)
