"""The registered queries in ANSI SQL over the same tables."""

from __future__ import annotations

# Views of `events`, as in `views.py`.
_R = """r AS (
  SELECT 'sensor-' || user_id AS device_id, 'Room-' || (200 + user_id % 8) AS room, ts AS event_ts,
         value AS temperature_c, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) / 8 AS power_kw, event_id
  FROM events)"""
_V = _R + """, v AS (SELECT * FROM r WHERE temperature_c BETWEEN -50 AND 120)"""

_STAMP = "strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f')"
_HEAD = "'{\"device_id\":\"' || device_id || '\",\"room\":\"' || room || '\",\"event_ts\":\"'"
_GOOD = f"{_HEAD} || {_STAMP} || 'Z\",'"
_TEMP = "'\"temperature_c\":' || CAST(temperature_c AS VARCHAR)"
_POWER = "'\"power_kw\":' || CAST(power_kw AS VARCHAR)"

# What the check says follows from the defect number and the value alone.
_J = _R + f""", j AS (
  SELECT *,
    CASE event_id % 16
      WHEN 0 THEN {_GOOD} || '"temp": BROKEN_SYNTAX}}'
      WHEN 1 THEN {_GOOD} || {_POWER} || '}}'
      WHEN 2 THEN {_GOOD} || {_TEMP} || ',"power_kw":null}}'
      WHEN 3 THEN {_GOOD} || {_TEMP} || ',"power_kw":-99.9}}'
      WHEN 4 THEN {_GOOD} || '"temperature_c":"abc",' || {_POWER} || '}}'
      WHEN 5 THEN chr(10) || '[' || CAST(temperature_c AS VARCHAR) || ',' || CAST(power_kw AS VARCHAR) || ']'
      WHEN 6 THEN {_HEAD} || 'bad",' || {_TEMP} || ',' || {_POWER} || '}}'
      ELSE {_GOOD} || {_TEMP} || ',' || {_POWER} || '}}' END AS raw_payload,
    CASE event_id % 16
      WHEN 0 THEN 'malformed' WHEN 1 THEN 'missing:temperature_c' WHEN 2 THEN 'null:power_kw'
      WHEN 3 THEN 'negative_power' WHEN 4 THEN 'type_cast' WHEN 5 THEN 'not_object' WHEN 6 THEN 'type_cast'
      ELSE CASE WHEN temperature_c > 120 THEN 'temperature_range' END END AS reason_code,
    CASE event_id % 16
      WHEN 0 THEN 'Malformed JSON syntax: not one JSON value'
      WHEN 1 THEN 'Missing required field ''temperature_c'''
      WHEN 2 THEN 'Field ''power_kw'' cannot be null'
      WHEN 3 THEN 'power_kw cannot be negative (-99.9)'
      WHEN 4 THEN 'Field type cast error: temperature_c'
      WHEN 5 THEN 'Expected JSON object, got list'
      WHEN 6 THEN 'Field type cast error: event_ts'
      ELSE CASE WHEN temperature_c > 120
        THEN 'temperature_c out of physical range (' || CAST(temperature_c AS VARCHAR) || ')' END END AS reason
  FROM r)"""


def _sigma(source: str) -> str:
    """Prior statistics over the last 20 rows of ``source``."""
    return f"""s AS (
  SELECT *, count(*) OVER w AS k, avg(temperature_c) OVER w AS tm, stddev_pop(temperature_c) OVER w AS td,
         avg(power_kw) OVER w AS pm, stddev_pop(power_kw) OVER w AS pd
  FROM {source} WINDOW w AS (PARTITION BY device_id ORDER BY event_ts, event_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))"""


_HARD = """SELECT device_id, event_ts, 'temp_spike_hard_limit' AS type, temperature_c AS value FROM {0} WHERE temperature_c > 45
  UNION ALL SELECT device_id, event_ts, 'power_surge_hard_limit', power_kw FROM {0} WHERE power_kw > 10"""
_SIGMA = """SELECT device_id, event_ts, 'temp_3_sigma_anomaly' AS type, temperature_c AS value FROM s
  WHERE k >= 5 AND td > 0.05 AND abs(temperature_c - tm) > 3 * td
  UNION ALL SELECT device_id, event_ts, 'power_3_sigma_anomaly', power_kw FROM s
  WHERE k >= 5 AND pd > 0.05 AND abs(power_kw - pm) > 3 * pd"""
_A = f"{_V}, {_sigma('v')}, a AS ({_HARD.format('v')} UNION ALL {_SIGMA})"


def _iso(ts: str) -> str:
    return (
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || "
        f"CASE WHEN microsecond({ts}) % 1000000 = 0 THEN '' ELSE strftime({ts}, '.%f') END || '+00:00'"
    )


def _mean(total: str, n: str, decimals: int, digits: int) -> str:
    """Half-up mean of non-negative values summed in units of ``decimals`` places."""
    up, down = 10 ** max(digits - decimals, 0), 10 ** max(decimals - digits, 0)
    return f"CAST((2 * {up} * ({total}) + {down} * ({n})) // (2 * {down} * ({n})) AS DOUBLE) / {10**digits}"


def _units(column: str, decimals: int) -> str:
    return f"CAST(round({column} * {10**decimals}) AS BIGINT)"


def _rollup(unit: str, views: str = _V) -> str:
    temp, power = f"sum({_units('temperature_c', 3)})", f"sum({_units('power_kw', 3)})"
    return f"""WITH {views}
SELECT device_id, date_trunc('{unit}', event_ts) AS window_start, {_mean(temp, 'count(*)', 3, 2)} AS avg_temp,
       max(temperature_c) AS max_temp, {_mean(power, 'count(*)', 3, 3)} AS avg_power, CAST(count(*) AS INTEGER) AS n
FROM v GROUP BY 1, 2"""


def _late_rollup() -> str:
    """Rollups of the events as they come in four parts, told apart by the watermark of the part before."""
    temp, power = f"sum({_units('temperature_c', 3)})", f"sum({_units('power_kw', 3)})"
    return f"""WITH {_V}, m AS (
  SELECT event_id % 4 AS part, max(max(event_ts)) OVER (ORDER BY event_id % 4) - INTERVAL 30 MINUTE AS mark FROM v GROUP BY 1),
x AS (
  SELECT v.*, event_id % 4 AS part, date_trunc('hour', event_ts) AS window_start,
         coalesce(date_trunc('hour', event_ts) + INTERVAL 1 HOUR <= mark, false) AS late
  FROM v LEFT JOIN m ON m.part = event_id % 4 - 1)
SELECT CASE WHEN late THEN 'late' WHEN window_start + INTERVAL 1 HOUR <= (SELECT max(mark) FROM m) THEN 'closed' ELSE 'open' END AS kind,
       device_id, window_start, {_mean(temp, 'count(*)', 3, 2)} AS avg_temp, max(temperature_c) AS max_temp,
       {_mean(power, 'count(*)', 3, 3)} AS avg_power, CAST(count(*) AS INTEGER) AS n
FROM x GROUP BY 1, 2, 3, CASE WHEN late THEN part END"""


_READING_COLUMNS = "device_id, room, event_ts, temperature_c, power_kw"
_ANOMALOUS = "temperature_c > 45 OR power_kw > 10"

_WEATHER = """WITH w AS (
  SELECT ts, user_id % 5 AS station, event_type AS kind, value AS t,
         CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) / 10 AS wind FROM events)
SELECT CASE station WHEN 0 THEN 'sensor-nyc' WHEN 1 THEN 'sensor-ldn' WHEN 2 THEN 'sensor-tko'
                    WHEN 3 THEN 'sensor-bom' ELSE 'sensor-syd' END AS device_id,
       CASE station WHEN 0 THEN 'NewYork-Central' WHEN 1 THEN 'London-City' WHEN 2 THEN 'Tokyo-Shinjuku'
                    WHEN 3 THEN 'Mumbai-BKC' ELSE 'Sydney-Harbor' END AS room,
       ts AS event_ts,
       CASE WHEN kind IN ('signup', 'purchase') THEN CAST(20 AS DOUBLE) ELSE t END AS temperature_c,
       CASE WHEN kind IN ('signup', 'view') THEN CAST(1.1 AS DOUBLE)
            ELSE round(CAST(0.8 AS DOUBLE) + wind * CAST(0.15 AS DOUBLE), 3) END AS power_kw
FROM w WHERE kind <> 'error'"""

_RUNS = """b AS (SELECT event_id AS seq FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'),
c AS (SELECT event_id AS seq FROM events WHERE ts >= TIMESTAMP '2024-01-14 18:00:00' AND value <= 120)"""


def _at(q: str) -> str:
    return f"max(CASE WHEN i = floor(n * CAST({q} AS DOUBLE)) THEN value END)"


_LATENCY = f"""WITH x AS (
  SELECT event_type, value, ts, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i,
         count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, count(*) AS messages,
       round(count(*) / greatest(0.0001, (epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(1e6 AS DOUBLE)), 2) AS throughput_msg_sec,
       round((max(CASE WHEN i = (n - 1) // 2 THEN value END) + max(CASE WHEN i = n // 2 THEN value END)) / 2, 4) AS p50_ms,
       {_at('0.90')} AS p90_ms, {_at('0.95')} AS p95_ms, {_at('0.99')} AS p99_ms,
       {_mean(f"sum({_units('value', 2)})", 'count(*)', 2, 4)} AS avg_ms
FROM x GROUP BY event_type"""

_TIMING = """WITH t AS (
  SELECT event_type AS query, CASE WHEN hour(ts) < 12 THEN 'morning' ELSE 'evening' END AS engine, value AS sec FROM events),
x AS (
  SELECT *, row_number() OVER (PARTITION BY query, engine ORDER BY sec) - 1 AS i,
         count(*) OVER (PARTITION BY query, engine) AS n FROM t),
m AS (
  SELECT query, max(CASE WHEN engine = 'morning' AND i = n // 2 THEN sec END) AS morning_sec,
         max(CASE WHEN engine = 'evening' AND i = n // 2 THEN sec END) AS evening_sec
  FROM x GROUP BY query)
SELECT query, morning_sec, evening_sec,
       CASE WHEN morning_sec < evening_sec THEN 'morning' ELSE 'evening' END AS winner,
       greatest(morning_sec, evening_sec) / greatest(CAST(0.0001 AS DOUBLE), least(morning_sec, evening_sec)) AS speedup
FROM m"""

_PIPELINE = f"""WITH {_J}, v AS (SELECT * FROM j WHERE reason_code IS NULL), {_sigma('v')},
a AS ({_HARD.format('v')} UNION ALL {_SIGMA})
SELECT (SELECT count(*) FROM j) AS received, (SELECT count(*) FROM v) AS readings,
       (SELECT count(*) FROM j WHERE reason_code IS NOT NULL) AS rejected,
       CAST((SELECT count(*) FROM a) AS BIGINT) AS alerts,
       (SELECT count(*) FROM (SELECT DISTINCT device_id, date_trunc('minute', event_ts) FROM v)) AS aggregates"""


def _recent(source: str, ts: str, n: int, columns: str, ties: str) -> str:
    return f"SELECT {columns} FROM {source} ORDER BY {ts} DESC, {ties} LIMIT {n}"


def _series(column: str, where: str = "") -> str:
    return f"WITH {_V} SELECT event_ts AS time, {column} AS value, room AS metric FROM v {where} ORDER BY time"


_LAST_DAYS = "WHERE event_ts BETWEEN (SELECT max(ts) FROM events) - INTERVAL 15 DAY AND (SELECT max(ts) FROM events)"
_ACCEPTED = f"{_J}, v AS (SELECT * FROM j WHERE reason_code IS NULL)"


def oracle() -> dict[str, str]:
    batch = {
        "q1_room_hourly_temp": f"""WITH {_R}
SELECT room, date_trunc('hour', event_ts) AS hour_window,
       {_mean(f"sum({_units('temperature_c', 2)})", 'count(*)', 2, 2)} AS avg_temp, max(temperature_c) AS max_temp
FROM r GROUP BY 1, 2 ORDER BY 1, 2""",
        "q2_room_daily_power": f"""WITH {_R}
SELECT room, CAST(date_trunc('day', event_ts) AS TIMESTAMP) AS day_window,
       {_mean(f"sum({_units('power_kw', 3)})", '1', 3, 2)} AS total_power_kw
FROM r GROUP BY 1, 2 ORDER BY 1, 2""",
        "q3_top_anomalous_devices": f"""WITH {_R}
SELECT device_id, count(*) AS anomaly_count FROM r WHERE {_ANOMALOUS}
GROUP BY device_id ORDER BY anomaly_count DESC, device_id LIMIT 10""",
        "q4_readings_per_device": f"""WITH {_R}
SELECT device_id, count(*) AS reading_count FROM r GROUP BY device_id ORDER BY reading_count DESC, device_id""",
        "scan_readings": f"WITH {_R} SELECT {_READING_COLUMNS} FROM r",
        "weather_to_readings": _WEATHER,
        "alert_messages": f"""WITH {_A}
SELECT device_id AS key, '{{"device_id":"' || device_id || '","event_ts":"' || {_iso('event_ts')} || '","type":"' || type
       || '","value":' || CAST(value AS VARCHAR) || '}}' AS value FROM a""",
        "reading_messages": f"""WITH {_R}
SELECT device_id AS key, '{{"device_id":"' || device_id || '","room":"' || room || '","event_ts":"' || {_iso('event_ts')}
       || '",' || {_TEMP} || ',' || {_POWER} || '}}' AS value FROM r""",
        "validate_reasons": f"WITH {_J} SELECT event_id, reason_code, reason FROM j",
        "valid_readings": f"WITH {_J} SELECT {_READING_COLUMNS}, event_id FROM j WHERE reason_code IS NULL",
        "rejected_rows": f"WITH {_J} SELECT raw_payload, reason, event_ts AS ts, event_id FROM j WHERE reason_code IS NOT NULL",
        "rejects_by_reason": f"""WITH {_J}
SELECT reason, count(*) AS n FROM j WHERE reason_code IS NOT NULL GROUP BY reason ORDER BY reason""",
        "anomalous_readings": f"WITH {_R} SELECT {_READING_COLUMNS} FROM r WHERE {_ANOMALOUS}",
        "anomaly_count": f"WITH {_R} SELECT count(*) AS anomaly_count FROM r WHERE {_ANOMALOUS}",
        "hard_limit_alerts": f"WITH {_V} {_HARD.format('v')}",
        "three_sigma_alerts": f"WITH {_V}, {_sigma('v')} {_SIGMA}",
        "all_alerts": f"WITH {_A} SELECT * FROM a",
        "hot_device_alerts": f"WITH {_A} SELECT * FROM a".replace("'sensor-' || user_id", "'sensor-' || (user_id % 3)"),
        "readings_by_device": f"WITH {_R} SELECT device_id, CAST(1 AS BIGINT) AS partitions, count(*) AS n FROM r GROUP BY 1",
        "stream_rollup_closed": f"""SELECT * FROM ({_rollup('hour')}) x WHERE window_start + INTERVAL 90 MINUTE <=
            (WITH {_V} SELECT max(event_ts) FROM v)""",
        "stream_pipeline_alerts": f"""WITH {_ACCEPTED}, {_sigma('v')},
a AS ({_HARD.format('v')} UNION ALL {_SIGMA}) SELECT * FROM a""",
        "stream_pipeline_rollups": _rollup("minute", _ACCEPTED),
        "alerts_by_type": f"WITH {_A} SELECT type, count(*) AS n FROM a GROUP BY type ORDER BY type",
        "rollup_1m": _rollup("minute"),
        "rollup_1h": _rollup("hour"),
        "rollup_1d": _rollup("day"),
        "rollup_count": f"""WITH {_V}
SELECT count(*) AS minute_rollups FROM (SELECT DISTINCT device_id, date_trunc('minute', event_ts) FROM v)""",
        "panel_total_readings": f"WITH {_V} SELECT count(*) AS total_readings FROM v",
        "panel_throughput": f"""WITH {_V}
SELECT count(*) AS msgs_last_min FROM v WHERE event_ts >= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE""",
        "panel_alert_count": f"WITH {_A} SELECT count(*) AS alert_count FROM a",
        "panel_rejected_count": f"WITH {_J} SELECT count(*) AS rejected_count FROM j WHERE reason_code IS NOT NULL",
        "panel_temp_series": _series("temperature_c", _LAST_DAYS),
        "panel_power_series": _series("power_kw", _LAST_DAYS),
        "recent_readings": f"WITH {_V} " + _recent("v", "event_ts", 10, _READING_COLUMNS, "device_id, room, temperature_c, power_kw"),
        "processed_sequences": f"WITH {_RUNS} SELECT seq FROM b UNION SELECT seq FROM c",
        "missing_sequences": f"""WITH {_RUNS}
SELECT event_id AS seq FROM events EXCEPT (SELECT seq FROM b UNION SELECT seq FROM c)""",
        "duplicated_sequences": f"WITH {_RUNS} SELECT seq FROM b INTERSECT SELECT seq FROM c",
        "missing_ranges": f"""WITH {_RUNS}, s AS (SELECT 'before' AS source, seq FROM b UNION SELECT 'after', seq FROM c
  UNION ALL SELECT k, min(event_id) - 1 FROM events, (VALUES ('before'), ('after')) x(k) GROUP BY k
  UNION ALL SELECT k, max(event_id) + 1 FROM events, (VALUES ('before'), ('after')) x(k) GROUP BY k),
g AS (SELECT source, lag(seq) OVER (PARTITION BY source ORDER BY seq) AS prior, seq FROM s)
SELECT source, prior + 1 AS first, seq - 1 AS last, seq - prior - 1 AS n FROM g WHERE seq - prior > 1""",
        "stream_rollup_late": _late_rollup(),
        "delivery_audit": f"""WITH {_RUNS}, u AS (SELECT seq FROM b UNION SELECT seq FROM c)
SELECT count(*) AS produced, (SELECT count(*) FROM b) AS processed_before, (SELECT count(*) FROM c) AS processed_after,
       (SELECT count(*) FROM u) AS unique_processed, count(*) - (SELECT count(*) FROM u) AS missing,
       (SELECT count(*) FROM b) + (SELECT count(*) FROM c) - (SELECT count(*) FROM u) AS duplicated,
       count(*) = (SELECT count(*) FROM u) AS success
FROM events""",
        "parity_check": f"""WITH {_J}
SELECT true AS same_schema, count(*) FILTER (temperature_c <= 120) = count(*) FILTER (reason_code IS NULL) AS same_shape,
       count(*) FILTER (temperature_c <= 120) AS rows_a, count(*) FILTER (reason_code IS NULL) AS rows_b,
       count(*) FILTER (temperature_c <= 120 AND reason_code IS NOT NULL) AS only_in_a, CAST(0 AS BIGINT) AS only_in_b,
       count(*) FILTER (temperature_c <= 120 AND reason_code IS NOT NULL) = 0 AS identical
FROM j""",
        "pipeline_stats": _PIPELINE,
        "latency_summary": _LATENCY,
        "timing_comparison": _TIMING,
    }
    for name, n in (("panel_recent_alerts", 50), ("recent_alerts", 10)):
        batch[name] = f"WITH {_A} " + _recent("a", "event_ts", n, "event_ts, device_id, type, value", "device_id, type, value")
    for name, n in (("panel_recent_rejects", 50), ("recent_rejects", 10)):
        batch[name] = (
            f"WITH {_J}, x AS (SELECT event_ts AS ts, reason, raw_payload FROM j WHERE reason_code IS NOT NULL) "
            + _recent("x", "ts", n, "ts, reason, raw_payload", "reason, raw_payload")
        )
    same_rows = {
        "parquet_export": "scan_readings",
        "stream_rollup": "rollup_1h",
        "stream_rollup_flushed": "rollup_1h",
        "stream_alerts": "three_sigma_alerts",
        "stream_all_alerts": "all_alerts",
        "stream_alerts_keyed": "all_alerts",
        "parity_by_digest": "parity_check",
        "stream_hard_limit_alerts": "hard_limit_alerts",
        "stream_validate_reasons": "validate_reasons",
        "stream_valid_readings": "valid_readings",
        "stream_rejected_rows": "rejected_rows",
        "stream_weather_to_readings": "weather_to_readings",
        "stream_pipeline_stats": "pipeline_stats",
    }
    return {**batch, **{name: batch[twin] for name, twin in same_rows.items()}}
