import json
from collections import Counter

import pytest

from thermowatt import SplitPolicy, hard_limit_alerts, rollup
from thermowatt.contract import ALERTS
from thermowatt.sinks import BatchTable
from thermowatt.streaming import DeviceTails, PipelineTables, run_pipeline, stream_alerts, stream_alerts_keyed, stream_into

from .helpers import bag, expected_alerts, numbered, random_readings, reading

SPLIT = SplitPolicy(rows_per_slice=10)
ONCE = {"availableNow": True}
ORDER = ["event_ts", "seq"]


def feed(df, folder, cut):
    """Land the rows of ``df`` in several files, one after the other."""
    for low, high in zip(cut, cut[1:]):
        part = df.where(f"seq >= {low} and seq < {high}")
        part.coalesce(1).write.mode("append").parquet(folder)


def as_stream(spark, df, folder, per_batch=1):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def by_value(rows, **kwargs):
    """Expected alerts without the sequence number."""
    out = Counter()
    for (device, _, kind, value), n in expected_alerts(rows, **kwargs).items():
        out[(device, kind, value)] += n
    return out


@pytest.mark.parametrize("policy", [SplitPolicy(), SPLIT])
def test_alerts_over_batches_and_restarts(spark, tmp_path, policy):
    rows = random_readings(900, 6, seed=3, hot=0.4)
    df = numbered(spark, rows)
    table = BatchTable(str(tmp_path / "alerts"), ALERTS, "event_ts")
    tails = DeviceTails(str(tmp_path / "tails"), full_every=2)
    for cut in ([0, 3, 200], [200, 450, 451], [451, 700, 900]):
        feed(df, str(tmp_path / "in"), cut)
        stream = as_stream(spark, df, str(tmp_path / "in"))
        stream_alerts(stream, table.add, tails, str(tmp_path / "check"), ORDER, ONCE, policy=policy).awaitTermination()
    assert bag(table.rows(spark), "device_id", "type", "value") == by_value(rows)
    assert sorted(p.name for p in (tmp_path / "tails").iterdir()) == ["version_4", "version_5"]


def test_keyed_alerts_over_restarts(spark, tmp_path):
    from thermowatt.session import SETTINGS

    name = "spark.sql.streaming.stateStore.providerClass"
    rows = random_readings(500, 5, seed=5, hot=0.4)
    df = numbered(spark, rows)
    table, own = BatchTable(str(tmp_path / "alerts"), ALERTS, "event_ts"), spark.newSession()
    own.conf.set(name, SETTINGS[name])
    own.conf.set("spark.sql.shuffle.partitions", 3)
    for cut in ([0, 3, 200], [200, 500]):
        feed(df, str(tmp_path / "in"), cut)
        stream = as_stream(own, df, str(tmp_path / "in"))
        stream_alerts_keyed(stream, table.add, str(tmp_path / "check"), ORDER, ONCE, history=9).awaitTermination()
    assert bag(table.rows(spark), "device_id", "type", "value") == by_value(rows, history=9)


def test_three_sigma_only_and_other_limits(spark, tmp_path):
    rows = random_readings(300, 3, seed=4)
    df = numbered(spark, rows)
    feed(df, str(tmp_path / "in"), [0, 100, 300])
    table = BatchTable(str(tmp_path / "alerts"), ALERTS, "event_ts")
    tails = DeviceTails(str(tmp_path / "tails"), history=7)
    stream = as_stream(spark, df, str(tmp_path / "in"))
    stream_alerts(stream, table.add, tails, str(tmp_path / "check"), ORDER, ONCE, hard_limits=False).awaitTermination()
    assert bag(table.rows(spark), "device_id", "type", "value") == by_value(rows, history=7, hard=False)


def test_failed_batch_runs_again_without_double_alerts(spark, tmp_path):
    rows = random_readings(400, 3, seed=8)
    df = numbered(spark, rows)
    feed(df, str(tmp_path / "in"), [0, 150, 400])
    table = BatchTable(str(tmp_path / "alerts"), ALERTS, "event_ts")
    tails = DeviceTails(str(tmp_path / "tails"))
    failing = {"left": 1}

    def sink(batch, batch_id):
        table.add(batch, batch_id)
        if batch_id == 1 and failing["left"]:
            failing["left"] = 0
            raise RuntimeError("lost after the write")

    def run():
        stream = as_stream(spark, df, str(tmp_path / "in"))
        stream_alerts(stream, sink, tails, str(tmp_path / "check"), ORDER, ONCE).awaitTermination()

    with pytest.raises(Exception, match="lost after the write"):
        run()
    run()
    assert bag(table.rows(spark), "device_id", "type", "value") == by_value(rows)


def test_hard_limits_need_no_state(spark, tmp_path):
    df = numbered(spark, [reading("s", i, 40 + i, 1) for i in range(10)])
    feed(df, str(tmp_path / "in"), [0, 5, 10])
    table = BatchTable(str(tmp_path / "out"), ALERTS, "event_ts")
    stream = hard_limit_alerts(as_stream(spark, df, str(tmp_path / "in")))
    stream_into(stream, table.add, str(tmp_path / "check"), ONCE).awaitTermination()
    assert bag(table.rows(spark)) == bag(hard_limit_alerts(df))


def message(row):
    device, room, ts, temp, power = row
    return json.dumps({"device_id": device, "room": room, "event_ts": ts.isoformat(), "temperature_c": temp, "power_kw": power})


@pytest.mark.parametrize("policy", [SplitPolicy(), SPLIT])
def test_pipeline_over_batches_and_restart(spark, tmp_path, policy):
    rows = random_readings(400, 4, seed=9, hot=0.3)
    texts = [message(r) for r in rows]
    broken = {50: "", 51: "{", 120: "[1]", 399: message(rows[399]).replace("power_kw", "kw")}
    raw = spark.createDataFrame([(broken.get(i, t), i) for i, t in enumerate(texts)], "value string, seq long")
    kept = [r for i, r in enumerate(rows) if i not in broken]
    tables = PipelineTables(str(tmp_path / "out"), decimals=3)
    published = []
    for cut in ([0, 60, 130], [130, 400]):
        feed(raw, str(tmp_path / "in"), cut)
        run_pipeline(
            as_stream(spark, raw, str(tmp_path / "in")), tables, str(tmp_path / "check"), ORDER, trigger=ONCE,
            also={"alerts": lambda df, batch_id: published.extend(df.collect())}, policy=policy,
        ).awaitTermination()
    assert tables.readings.rows(spark).count() == len(kept)
    assert bag(tables.rejected.rows(spark), "raw_payload") == Counter((t,) for t in broken.values())
    assert bag(tables.alerts.rows(spark), "device_id", "type", "value") == by_value(kept)
    assert len(published) == sum(by_value(kept).values())
    assert bag(tables.rollups(spark)) == bag(rollup(numbered(spark, kept), decimals=3))
    assert tables.counters(spark).first().asDict() == {
        "received": 400, "readings": 396, "rejected": 4, "alerts": sum(by_value(kept).values()),
        "aggregates": tables.rollups(spark).count(),
    }


def test_pipeline_folds_its_tables(spark, tmp_path):
    rows = random_readings(120, 4, seed=10)
    raw = spark.createDataFrame([(message(r), i) for i, r in enumerate(rows)], "value string, seq long")
    feed(raw, str(tmp_path / "in"), range(0, 121, 15))
    tables = PipelineTables(str(tmp_path / "out"), decimals=3)
    stream = as_stream(spark, raw, str(tmp_path / "in"))
    run_pipeline(stream, tables, str(tmp_path / "check"), ORDER, trigger=ONCE, compact_every=3).awaitTermination()
    # Eight batches, folded when the fourth and the seventh began.
    for table in (tables.readings, tables.rejected, tables.alerts, tables.parts):
        assert [p.name for p in sorted((tmp_path / "out").glob(f"{table.path.rsplit('/', 1)[1]}-folded/*"))] == ["0-3", "0-6"]
    assert {p.name for p in (tmp_path / "out" / "readings").glob("event_date=*/batch_id=*")} == {f"batch_id={n}" for n in range(3, 8)}
    assert bag(tables.rollups(spark)) == bag(rollup(numbered(spark, rows), decimals=3))
    assert tables.counters(spark).first()["received"] == 120
    assert bag(tables.alerts.rows(spark), "device_id", "type", "value") == by_value(rows)


def test_pipeline_with_nothing_good_or_nothing_bad(spark, tmp_path):
    for name, value in (("bad", "{"), ("good", message(reading("s", 0, 20, 1)))):
        raw = spark.createDataFrame([(value, 0)], "value string, seq long")
        feed(raw, str(tmp_path / name), [0, 1])
        tables = PipelineTables(str(tmp_path / f"{name}-out"))
        run_pipeline(as_stream(spark, raw, str(tmp_path / name)), tables, str(tmp_path / f"{name}-check"), ORDER, trigger=ONCE).awaitTermination()
        counts = tables.counters(spark).first().asDict()
        good = int(name == "good")
        assert counts == {"received": 1, "readings": good, "rejected": 1 - good, "alerts": 0, "aggregates": good}
        assert tables.alerts.rows(spark).count() == 0


def test_unknown_output_is_refused(spark, tmp_path):
    raw = spark.createDataFrame([("x", 0)], "value string, seq long")
    with pytest.raises(ValueError, match="no such output"):
        run_pipeline(raw, PipelineTables(str(tmp_path)), "unused", ORDER, also={"alert": print})


def test_table_folder_as_stream(spark, tmp_path):
    """The given table may be one file or a folder of files."""
    from thermowatt.plans import registered
    from thermowatt.plans.views import events

    query, sf = registered()["stream_hard_limit_alerts"], "/root/testdata/sf0.001"
    events(spark, sf).repartition(3).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    assert bag(query(spark, str(tmp_path / "sf"))) == bag(query(spark, sf))


def test_batches_of_one_row_group_have_many_tasks(spark, tmp_path, monkeypatch):
    from thermowatt.plans import queries, views

    sf, seen, tasks = str(tmp_path / "sf"), [], []
    views.events(spark, "/root/testdata/sf0.001").coalesce(1).orderBy("ts").write.parquet(f"{sf}/events.parquet")
    monkeypatch.setattr(queries, "_FILE_ROWS", 50, raising=False)

    def sink(batch, batch_id):
        tasks.append(batch.rdd.getNumPartitions())
        seen.extend(tuple(r) for r in batch.collect())

    queries._in_parts(spark, sf, str(tmp_path / "root"), lambda ev, checkpoint: stream_into(ev, sink, checkpoint, ONCE))
    assert len(tasks) == 4 and min(tasks) >= 4
    assert Counter(seen) == bag(views.events(spark, sf))
    assert not any((tmp_path / "root").iterdir())


@pytest.mark.parametrize("part", ["_in_time", "_interleaved"])
def test_all_parts_are_written_in_one_pass(spark, tmp_path, monkeypatch, part):
    from datetime import datetime, timedelta

    from thermowatt.plans import queries, views

    sf, left, seen = str(tmp_path / "sf"), [], []
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=i * 7 % 100), i % 5, "view", 1.0, '{"k": 8}') for i in range(100)]
    rows += [rows[3], (3, None, None, None, None, None)]
    spark.createDataFrame(rows, views.EVENTS).coalesce(1).write.parquet(f"{sf}/events.parquet")
    monkeypatch.setattr(queries, "_FILE_ROWS", 10)

    def start(ev, checkpoint):
        left.append({p.name for p in (tmp_path / "root" / "spread").glob("_part=*")})
        return stream_into(ev, lambda batch, batch_id: seen.append([tuple(r) for r in batch.collect()]), checkpoint, ONCE)

    queries._in_parts(spark, sf, str(tmp_path / "root"), start, getattr(queries, part))
    assert left == [{f"_part={i}" for i in range(n, 4)} for n in (1, 2, 3, 4)]
    assert Counter(r for batch in seen for r in batch) == Counter(rows)
    if part == "_in_time":
        times = [[r[1] for r in batch if r[1] is not None] for batch in seen]
        assert all(max(a) < min(b) for a, b in zip(times, times[1:]))
    else:
        assert [{r[0] % 4 for r in batch} for batch in seen] == [{0}, {1}, {2}, {3}]


@pytest.mark.parametrize("policy", [SplitPolicy(), SPLIT])
def test_tails_come_from_the_rows_of_the_alerts(spark, tmp_path, policy):
    from thermowatt.operators.history import last_rows

    df, signals = numbered(spark, random_readings(300, 6, seed=12, hot=0.4)), ["temperature_c", "power_kw"]
    tails, seeds = DeviceTails(str(tmp_path / "tails")), None
    for batch_id, rows in enumerate((df.where("seq < 40"), df.where("seq >= 40 AND device_id <> 'd3'"))):
        expected = bag(last_rows(rows, "device_id", ORDER, signals, 20, seeds))
        stats = tails.stats(rows, ORDER, seeds, policy)
        assert (stats.cut_keys is not None) == (policy is SPLIT)
        assert stats.rows.is_cached and stats.given.count() == rows.count()
        newest = tails._newest(rows, ORDER, seeds, stats)
        assert bag(newest) == expected
        if policy is not SPLIT:
            # Nothing is shuffled again: device by device the rows lie where the alerts' window has put them.
            plan = newest.groupBy("device_id").count()._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan.split("InMemoryRelation")[0]
        seeds = spark.createDataFrame(newest.collect(), newest.schema)
        stats.drop()


def test_settings_of_batches_stay_in_the_stream(spark, tmp_path):
    name = "spark.sql.inMemoryColumnarStorage.compressed"
    df, seen, tails = numbered(spark, random_readings(30, 2, seed=1)), [], DeviceTails(str(tmp_path / "tails"))
    feed(df, str(tmp_path / "in"), [0, 30])
    stream = as_stream(spark, df, str(tmp_path / "in"))
    sink = lambda rows, batch_id: seen.append((rows.count(), rows.sparkSession.conf.get(name)))
    stream_alerts(stream, sink, tails, str(tmp_path / "check"), ORDER, ONCE).awaitTermination()
    assert [s[1] for s in seen] == ["false"] and spark.conf.get(name) == "true"
