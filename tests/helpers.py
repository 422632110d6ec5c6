"""Plain-Python answers to compare with, and small tables."""

from __future__ import annotations

import random
import statistics
from collections import Counter, defaultdict, deque
from datetime import datetime, timedelta, timezone

START = datetime(2026, 10, 8, 12, 0, 0, tzinfo=timezone.utc)
READING = "device_id string, room string, event_ts timestamp, temperature_c double, power_kw double"


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def reading(device, seconds, temp, power, room="Room-201"):
    return (device, room, at(seconds), float(temp), float(power))


def numbered(spark, rows):
    """Readings with their place in the list as ``seq``."""
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], READING + ", seq long")


def random_readings(n, devices, seed, hot=0.0):
    """Readings in arrival order; a share ``hot`` of them belongs to device 0."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        device = 0 if rng.random() < hot else rng.randrange(devices)
        wild = rng.random() < 0.03
        temp = 20 + rng.gauss(0, 1) + (50 if wild else 0)
        power = 2 + rng.gauss(0, 0.2) + (12 if wild and rng.random() < 0.5 else 0)
        rows.append(reading(f"d{device}", i // 2, round(temp, 2), round(abs(power), 3)))
    return rows


def expected_alerts(rows, history=20, sigmas=True, hard=True):
    """(device, seq, type, value) of every alert when rows arrive in list order."""
    past = defaultdict(lambda: (deque(maxlen=history), deque(maxlen=history)))
    out = []
    for seq, (device, _, _, temp, power) in enumerate(rows):
        temps, powers = past[device]
        if hard and temp > 45.0:
            out.append((device, seq, "temp_spike_hard_limit", temp))
        if hard and power > 10.0:
            out.append((device, seq, "power_surge_hard_limit", power))
        for values, x, kind in ((temps, temp, "temp_3_sigma_anomaly"), (powers, power, "power_3_sigma_anomaly")):
            if sigmas and len(values) >= 5:
                mean, std = statistics.fmean(values), statistics.pstdev(values)
                if std > 0.05 and abs(x - mean) > 3.0 * std:
                    out.append((device, seq, kind, x))
            values.append(x)
    return Counter(out)


def bag(df, *columns):
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())
