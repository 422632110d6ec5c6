"""Registered queries: name -> function of (spark, folder of the given tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from .. import contract as c
from ..operators import (
    SplitPolicy, all_alerts, anomalous_readings, anomaly_count, by_device, count_by, count_since, delivery_audit,
    duplicated_keys, default_stations, hard_limit_alerts, latency_summary, missing_keys, missing_ranges, parity_by_digest, parity_check,
    pipeline_stats, processed_keys, readings_per_device, recent, rejected_rows, rollup, room_daily_power,
    room_hourly_temperature, row_count, series, sigma_alerts, timing_comparison, to_messages,
    top_anomalous_devices, valid_readings, validate, weather_to_readings,
)
from ..session import SETTINGS
from ..sinks import BatchTable, write_parquet
from ..sources import drop_folder, move_folder, read_readings, shared_folder, stream_parquet
from ..streaming import (
    ClosedRollups, DeviceTails, PipelineTables, latest_rollups, open_rollups, run_pipeline, stream_alerts,
    stream_alerts_keyed, stream_closed_rollups, stream_into, stream_rollup, versions_table,
)
from . import views
from .views import ORDER

Query = Callable[[SparkSession, str], DataFrame]

_READING_COLUMNS = c.READINGS.names
_ALERT_COLUMNS = c.ALERTS.names
_BOUNDED = {"availableNow": True}
_TEMP_DECIMALS, _POWER_DECIMALS = 2, 3


def _plain(df: DataFrame) -> DataFrame:
    """Instants as UTC timestamps without zone."""
    return df.select([
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema
    ])


def _newest(spark: SparkSession, sf_dir: str) -> Column:
    """Time of the newest event, as a literal."""
    text = views.events(spark, sf_dir).agg(F.max("ts").cast("string")).first()[0]
    return F.lit(text).cast("timestamp")


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_alerts(views.in_range(spark, sf_dir), ORDER)


def _rejected(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return rejected_rows(views.validated(spark, sf_dir), F.col("ts"), extra)


# Sources and sinks

def scan_readings(spark, sf_dir):
    return views.readings(spark, sf_dir).select(*_READING_COLUMNS)


def parquet_export(spark, sf_dir):
    path = shared_folder(spark, "export")
    rows = scan_readings(spark, sf_dir)
    return read_readings(spark, path) if write_parquet(rows, path) else rows


def weather(spark, sf_dir):
    lines = views.weather_lines_of(views.events(spark, sf_dir))
    return weather_to_readings(views.weather_responses_of(lines), default_stations(spark), F.col("ts"))


def alert_messages(spark, sf_dir):
    return to_messages(_alerts(spark, sf_dir), columns=_ALERT_COLUMNS)


def reading_messages(spark, sf_dir):
    return to_messages(views.readings(spark, sf_dir), columns=_READING_COLUMNS)


def readings_by_device(spark, sf_dir):
    """What a hash placement by device leads to: in how many partitions a device lies."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = by_device(scan_readings(spark, sf_dir), n).withColumn("at", F.spark_partition_id())
    return placed.groupBy("device_id").agg(F.count_distinct("at").alias("partitions"), F.count(F.lit(1)).alias("n"))


# Validation

def validate_reasons(spark, sf_dir):
    return views.validated(spark, sf_dir).select("event_id", "reason_code", "reason")


def accepted_readings(spark, sf_dir):
    return views.accepted(spark, sf_dir)


def rejected(spark, sf_dir):
    return _rejected(spark, sf_dir, ("event_id",))


def rejects_by_reason(spark, sf_dir):
    return count_by(_rejected(spark, sf_dir), "reason")


# Reports

def anomalous(spark, sf_dir):
    return anomalous_readings(views.readings(spark, sf_dir)).select(*_READING_COLUMNS)


def q1(spark, sf_dir):
    return room_hourly_temperature(views.readings(spark, sf_dir), _TEMP_DECIMALS)


def q2(spark, sf_dir):
    return room_daily_power(views.readings(spark, sf_dir), _POWER_DECIMALS)


def q3(spark, sf_dir):
    return top_anomalous_devices(views.readings(spark, sf_dir))


def q4(spark, sf_dir):
    return readings_per_device(views.readings(spark, sf_dir))


def anomalies_counted(spark, sf_dir):
    return anomaly_count(views.readings(spark, sf_dir))


# Alerts and rollups

def hard_alerts(spark, sf_dir):
    return hard_limit_alerts(views.in_range(spark, sf_dir))


def three_sigma(spark, sf_dir):
    return sigma_alerts(views.in_range(spark, sf_dir), ORDER)


def every_alert(spark, sf_dir):
    return _alerts(spark, sf_dir)


def hot_device_alerts(spark, sf_dir):
    """All events as readings of three devices, each cut into slices of a 64th of all rows."""
    rows = views.in_range(spark, sf_dir).withColumn(
        "device_id", F.concat(F.lit("sensor-"), F.pmod(F.substring_index("device_id", "-", -1).cast("long"), F.lit(3)))
    )
    return all_alerts(rows, ORDER, policy=SplitPolicy(max(1, rows.count() // 64)))


def alerts_by_type(spark, sf_dir):
    return count_by(_alerts(spark, sf_dir), "type")


def _rollup(size: str) -> Query:
    return lambda spark, sf_dir: rollup(views.in_range(spark, sf_dir), size, decimals=_POWER_DECIMALS)


# Panels

def total_readings(spark, sf_dir):
    return row_count(views.in_range(spark, sf_dir), "total_readings")


def alert_count(spark, sf_dir):
    return row_count(_alerts(spark, sf_dir), "alert_count")


def rejected_count(spark, sf_dir):
    return row_count(_rejected(spark, sf_dir), "rejected_count")


def rollup_count(spark, sf_dir):
    return row_count(rollup(views.in_range(spark, sf_dir)), "minute_rollups")


def throughput(spark, sf_dir):
    rows = views.in_range(spark, sf_dir)
    return count_since(rows, "1 minute", _newest(spark, sf_dir), name="msgs_last_min")


def temp_series(spark, sf_dir):
    end = _newest(spark, sf_dir)
    return series(views.in_range(spark, sf_dir), "temperature_c", end - F.expr("INTERVAL 15 DAYS"), end)


def power_series(spark, sf_dir):
    end = _newest(spark, sf_dir)
    return series(views.in_range(spark, sf_dir), "power_kw", end - F.expr("INTERVAL 15 DAYS"), end)


def _recent_alerts(n: int) -> Query:
    return lambda spark, sf_dir: recent(
        _alerts(spark, sf_dir), "event_ts", n, ["event_ts", "device_id", "type", "value"]
    )


def _recent_rejects(n: int) -> Query:
    return lambda spark, sf_dir: recent(_rejected(spark, sf_dir), "ts", n, ["ts", "reason", "raw_payload"])


def _recent_readings(n: int) -> Query:
    return lambda spark, sf_dir: recent(views.in_range(spark, sf_dir), "event_ts", n, _READING_COLUMNS)


# Audits and summaries

def _deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Event ids as sequence numbers: a run that crashed, and one that restarted six hours further back.

    The second run also lost the out-of-range rows.
    """
    ev = views.events(spark, sf_dir).withColumnRenamed("event_id", "seq")
    before = ev.where(F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    after = ev.where((F.col("ts") >= F.lit("2024-01-14 18:00:00").cast("timestamp_ntz")) & (F.col("value") <= 120))
    return ev, {"before": before, "after": after}


def audit(spark, sf_dir):
    return delivery_audit(*_deliveries(spark, sf_dir))


def processed_sequences(spark, sf_dir):
    return processed_keys(list(_deliveries(spark, sf_dir)[1].values()))


def missing_sequences(spark, sf_dir):
    expected, runs = _deliveries(spark, sf_dir)
    return missing_keys(expected, list(runs.values()))


def duplicated_sequences(spark, sf_dir):
    return duplicated_keys(*_deliveries(spark, sf_dir)[1].values())


def missing_sequence_ranges(spark, sf_dir):
    ev, runs = _deliveries(spark, sf_dir)
    first, last = ev.agg(F.min("seq"), F.max("seq")).first()
    return missing_ranges(runs, first or 0, last or 0, width=1 << 10)


def parity(spark, sf_dir):
    return parity_check(
        views.in_range(spark, sf_dir).select(*_READING_COLUMNS),
        views.accepted(spark, sf_dir).select(*_READING_COLUMNS),
    )


def parity_digests(spark, sf_dir):
    return parity_by_digest(
        views.in_range(spark, sf_dir).select(*_READING_COLUMNS),
        views.accepted(spark, sf_dir).select(*_READING_COLUMNS),
    )


def stats(spark, sf_dir):
    return pipeline_stats(views.validated(spark, sf_dir), ORDER)


def latencies(spark, sf_dir):
    return latency_summary(views.events(spark, sf_dir), "event_type", "value", "ts", _TEMP_DECIMALS)


def timings(spark, sf_dir):
    engine = F.when(F.hour("ts") < 12, "morning").otherwise("evening")
    runs = views.events(spark, sf_dir).select(
        F.col("event_type").alias("query"), engine.alias("engine"), F.col("value").alias("sec")
    )
    return timing_comparison(runs, ["morning", "evening"])


# Streams. The events are landed in the shared folder in four parts, one after
# the other. After each, the query is started again from its checkpoint, runs
# until it has taken what is new, and stops.

_PARTS = 4
_PART = "_part"
#: Events to a landed file: a row group is one task's work, and the given table may have just one.
_FILE_ROWS = 25_000


def _spread(ev: DataFrame) -> DataFrame:
    """The same events dealt by whole rows, to tasks that each write a file of every part."""
    n = ev.count()
    files, cores = -(-n // _FILE_ROWS), ev.sparkSession.sparkContext.defaultParallelism
    return ev.repartition(max(1, -(-files // _PARTS), min(files, cores)), *ev.columns)


def _in_time(ev: DataFrame) -> DataFrame:
    """Part number by event time, so that a device's readings arrive in order.

    The cuts come from the rows as dealt: both sides of the join read one shuffle. They are off by a thousandth of
    the rows at most, and what a query returns does not depend on where they lie.
    """
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = ev.agg(F.percentile_approx(at, [i / _PARTS for i in range(1, _PARTS)], 1_000).alias("_cuts"))
    number = sum((F.when(at > F.get("_cuts", F.lit(i)), 1).otherwise(0) for i in range(_PARTS - 1)), F.lit(0))
    return ev.crossJoin(F.broadcast(cuts)).withColumn(_PART, number).drop("_cuts")


def _interleaved(ev: DataFrame) -> DataFrame:
    """Part number by event id: every part but the first is full of late readings."""
    return ev.withColumn(_PART, F.pmod("event_id", F.lit(_PARTS)))


def _in_parts(
    spark: SparkSession, sf_dir: str, root: str, start: Callable[[DataFrame, str], StreamingQuery],
    part: Callable[[DataFrame], DataFrame] = _in_time, at_end: Callable[[str], None] = lambda checkpoint: None,
) -> None:
    part(_spread(views.events(spark, sf_dir))).write.partitionBy(_PART).parquet(f"{root}/spread")
    for i in range(_PARTS):
        landed = f"{root}/landed/part-{i}"
        # All parts are written at once, and one after the other is moved to where the stream looks.
        if not move_folder(spark, f"{root}/spread/{_PART}={i}", landed):
            spark.createDataFrame([], views.EVENTS).write.parquet(landed)
        start(stream_parquet(spark, f"{root}/landed/*", views.EVENTS), f"{root}/checkpoint").awaitTermination()
    at_end(f"{root}/checkpoint")
    for used in ("spread", "landed", "checkpoint"):
        drop_folder(spark, f"{root}/{used}")


def _in_range_stream(ev: DataFrame) -> DataFrame:
    return views.in_range_of(views.readings_of(ev))


def streamed_rollup(spark, sf_dir):
    root = shared_folder(spark, "rollup")
    table = versions_table(f"{root}/table")

    def start(ev: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream_rollup(
            _in_range_stream(ev), table.add, checkpoint, "1 hour", decimals=_POWER_DECIMALS, trigger=_BOUNDED
        )

    _in_parts(spark, sf_dir, root, start, _interleaved)
    return latest_rollups(spark, table)


def _streamed_closed_rollup(flush: bool) -> Query:
    """Windows that the watermark has passed; with ``flush`` the open ones as well, at the end of the stream."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_folder(spark, "closed")
        table = BatchTable(f"{root}/table", c.ROLLUPS, "window_start", rebalance=True)
        left = BatchTable(f"{root}/left", c.ROLLUPS, "window_start", rebalance=True)

        def start(ev: DataFrame, checkpoint: str) -> StreamingQuery:
            return stream_rollup(
                _in_range_stream(ev), table.add, checkpoint, "1 hour", "30 minutes", _POWER_DECIMALS, _BOUNDED, closed_only=True
            )

        def at_end(checkpoint: str) -> None:
            if flush:
                left.add(open_rollups(spark, checkpoint, _POWER_DECIMALS), 0)

        _in_parts(spark, sf_dir, root, start, at_end=at_end)
        return table.rows(spark).unionAll(left.rows(spark)) if flush else table.rows(spark)

    return run


def streamed_late_rollup(spark, sf_dir):
    """Closed, open and late rollups of a stream full of late readings; together they hold every reading once."""
    root = shared_folder(spark, "late")
    tables = ClosedRollups(f"{root}/tables", "1 hour", "30 minutes", _POWER_DECIMALS)

    def start(ev: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream_closed_rollups(_in_range_stream(ev), tables, checkpoint, _BOUNDED, compact_every=2)

    _in_parts(spark, sf_dir, root, start, _interleaved)
    kinds = {"closed": tables.closed_rollups(spark), "open": tables.open_rollups(spark), "late": tables.late_rollups(spark)}
    closed, opened, late = (rows.withColumn("kind", F.lit(kind)) for kind, rows in kinds.items())
    return closed.unionAll(opened).unionAll(late)


def _streamed_alerts(hard_limits: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_folder(spark, "alerts")
        table = BatchTable(f"{root}/table", c.ALERTS, "event_ts", rebalance=True)
        tails = DeviceTails(f"{root}/tails")

        def start(ev: DataFrame, checkpoint: str) -> StreamingQuery:
            rows = _in_range_stream(ev)
            return stream_alerts(rows, table.add, tails, checkpoint, ORDER, _BOUNDED, hard_limits=hard_limits)

        _in_parts(spark, sf_dir, root, start)
        return table.rows(spark)

    return run


def streamed_keyed_alerts(spark, sf_dir):
    root = shared_folder(spark, "keyed-alerts")
    table = BatchTable(f"{root}/table", c.ALERTS, "event_ts", rebalance=True)
    # State lists need the RocksDB store; the caller's session keeps its own setting.
    own = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.checkpoint.dir"):
        if (value := spark.conf.get(name, None)) is not None and own.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", SETTINGS["spark.sql.streaming.stateStore.providerClass"])

    def start(ev: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream_alerts_keyed(_in_range_stream(ev), table.add, checkpoint, ORDER, _BOUNDED)

    _in_parts(own, sf_dir, root, start)
    return table.rows(spark)


def _streamed(purpose: str, schema: T.StructType, build: Callable[[SparkSession, DataFrame], DataFrame]) -> Query:
    """A stateless operator run over the event stream into a table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_folder(spark, purpose)
        table = BatchTable(f"{root}/table", schema)
        _in_parts(spark, sf_dir, root, lambda ev, checkpoint: stream_into(build(spark, ev), table.add, checkpoint, _BOUNDED))
        return table.rows(spark)

    return run


def _with_event(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("event_id", T.LongType(), nullable=False)])


streamed_reasons = _streamed(
    "reasons",
    T.StructType([
        T.StructField("event_id", T.LongType(), nullable=False),
        T.StructField("reason_code", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]),
    lambda spark, ev: validate(views.raw_messages_of(ev)),
)
streamed_readings = _streamed(
    "accepted",
    _with_event(c.READINGS),
    lambda spark, ev: valid_readings(validate(views.raw_messages_of(ev)), ("event_id",)),
)
streamed_rejects = _streamed(
    "rejected",
    _with_event(c.REJECTED),
    lambda spark, ev: rejected_rows(validate(views.raw_messages_of(ev)), F.col("ts"), ("event_id",)),
)
streamed_hard_alerts = _streamed("hard", c.ALERTS, lambda spark, ev: hard_limit_alerts(_in_range_stream(ev)))
streamed_weather = _streamed(
    "weather",
    c.READINGS,
    lambda spark, ev: weather_to_readings(
        views.weather_responses_of(views.weather_lines_of(ev)), default_stations(spark), F.col("ts")
    ),
)


def _streamed_pipeline(output: Callable[[PipelineTables, SparkSession], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_folder(spark, "pipeline")
        tables = PipelineTables(root, decimals=_POWER_DECIMALS)

        def start(ev: DataFrame, checkpoint: str) -> StreamingQuery:
            return run_pipeline(views.raw_messages_of(ev), tables, checkpoint, ORDER, trigger=_BOUNDED, rejected_at="ts")

        _in_parts(spark, sf_dir, root, start)
        return output(tables, spark)

    return run


_QUERIES: dict[str, Query] = {
    "q1_room_hourly_temp": q1,
    "q2_room_daily_power": q2,
    "q3_top_anomalous_devices": q3,
    "q4_readings_per_device": q4,
    "scan_readings": scan_readings,
    "parquet_export": parquet_export,
    "readings_by_device": readings_by_device,
    "weather_to_readings": weather,
    "alert_messages": alert_messages,
    "reading_messages": reading_messages,
    "validate_reasons": validate_reasons,
    "valid_readings": accepted_readings,
    "rejected_rows": rejected,
    "rejects_by_reason": rejects_by_reason,
    "anomalous_readings": anomalous,
    "anomaly_count": anomalies_counted,
    "hard_limit_alerts": hard_alerts,
    "three_sigma_alerts": three_sigma,
    "all_alerts": every_alert,
    "hot_device_alerts": hot_device_alerts,
    "alerts_by_type": alerts_by_type,
    "rollup_1m": _rollup("1 minute"),
    "rollup_1h": _rollup("1 hour"),
    "rollup_1d": _rollup("1 day"),
    "rollup_count": rollup_count,
    "panel_total_readings": total_readings,
    "panel_throughput": throughput,
    "panel_alert_count": alert_count,
    "panel_rejected_count": rejected_count,
    "panel_temp_series": temp_series,
    "panel_power_series": power_series,
    "panel_recent_alerts": _recent_alerts(50),
    "panel_recent_rejects": _recent_rejects(50),
    "recent_readings": _recent_readings(10),
    "recent_alerts": _recent_alerts(10),
    "recent_rejects": _recent_rejects(10),
    "processed_sequences": processed_sequences,
    "missing_sequences": missing_sequences,
    "duplicated_sequences": duplicated_sequences,
    "missing_ranges": missing_sequence_ranges,
    "delivery_audit": audit,
    "parity_check": parity,
    "parity_by_digest": parity_digests,
    "pipeline_stats": stats,
    "latency_summary": latencies,
    "timing_comparison": timings,
    "stream_rollup": streamed_rollup,
    "stream_rollup_closed": _streamed_closed_rollup(flush=False),
    "stream_rollup_flushed": _streamed_closed_rollup(flush=True),
    "stream_rollup_late": streamed_late_rollup,
    "stream_alerts": _streamed_alerts(hard_limits=False),
    "stream_all_alerts": _streamed_alerts(hard_limits=True),
    "stream_alerts_keyed": streamed_keyed_alerts,
    "stream_hard_limit_alerts": streamed_hard_alerts,
    "stream_validate_reasons": streamed_reasons,
    "stream_valid_readings": streamed_readings,
    "stream_rejected_rows": streamed_rejects,
    "stream_weather_to_readings": streamed_weather,
    "stream_pipeline_stats": _streamed_pipeline(lambda tables, spark: tables.counters(spark)),
    "stream_pipeline_alerts": _streamed_pipeline(lambda tables, spark: tables.alerts.rows(spark)),
    "stream_pipeline_rollups": _streamed_pipeline(lambda tables, spark: tables.rollups(spark)),
}


def _contract(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _plain(query(spark, sf_dir))

    return run


def registered() -> dict[str, Query]:
    return {name: _contract(query) for name, query in _QUERIES.items()}
