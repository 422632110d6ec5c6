"""Alerts on a stream with keyed state: for many devices of which each sends little."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from .. import contract as c
from ..sinks.external import BatchSink

_SIGNALS = ("temperature_c", "power_kw")
_TAIL = "temperature_c double, power_kw double"
#: Readings whose frames are laid out at once.
_CHUNK = 1 << 14


def _fired(values: np.ndarray, new: int, history: int, min_history: int, sigmas: float, std_floor: float) -> np.ndarray:
    """For each of the last ``new`` values: whether it is too far from the ``history`` values before it."""
    out = np.zeros(new, bool)
    padded = np.concatenate((np.full(history, np.nan), values))
    first = len(values) - new
    for at in range(0, new, _CHUNK):
        stop = min(new, at + _CHUNK)
        own = values[first + at : first + stop]
        frames = np.lib.stride_tricks.sliding_window_view(padded, history)[first + at : first + stop]
        known = ~np.isnan(frames)
        n = known.sum(1)
        mean = np.where(known, frames, 0).sum(1) / np.maximum(n, 1)
        std = np.sqrt((np.where(known, frames - mean[:, None], 0) ** 2).sum(1) / np.maximum(n, 1))
        out[at:stop] = (n >= min_history) & (std > std_floor) & (np.abs(own - mean) > sigmas * std)
    return out


class _Tails(StatefulProcessor):
    """The last readings of a device, as a list in the state store."""

    def __init__(self, order_by: list[str], history: int, hard_limits: bool, limits: dict[str, float]):
        self.order_by, self.history, self.hard_limits, self.limits = order_by, history, hard_limits, limits

    def init(self, handle) -> None:
        self.tail = handle.getListState("tail", _TAIL)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(self.order_by, kind="stable")
        old = np.array([tuple(r) for r in self.tail.get()], np.float64).reshape(-1, len(_SIGNALS))
        own = new[list(_SIGNALS)].to_numpy(np.float64)
        both = np.concatenate((old, own))
        self.tail.put([tuple(map(float, r)) for r in both[-self.history :]])
        limits = self.limits
        found = []
        hard = ((c.TEMP_HARD_LIMIT, limits["temp_max"]), (c.POWER_HARD_LIMIT, limits["power_max"]))
        for i, (name, limit) in enumerate(hard if self.hard_limits else ()):
            found.append((name, i, own[:, i] > limit))
        for i, name in enumerate((c.TEMP_THREE_SIGMA, c.POWER_THREE_SIGMA)):
            fired = _fired(both[:, i], len(own), self.history, int(limits["min_history"]), limits["sigmas"], limits["std_floor"])
            found.append((name, i, fired))
        for name, i, fired in found:
            if fired.any():
                yield pd.DataFrame({
                    "device_id": key[0], "event_ts": new["event_ts"].to_numpy()[fired], "type": name, "value": own[fired, i],
                })

    def close(self) -> None:
        pass


def stream_alerts_keyed(
    readings: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    order_by: list[str],
    trigger: dict | None = None,
    hard_limits: bool = True,
    history: int = c.HISTORY_LENGTH,
    min_history: int = c.MIN_HISTORY,
    sigmas: float = c.SIGMAS,
    std_floor: float = c.STD_FLOOR,
    temp_max: float = c.TEMP_LIMIT_C,
    power_max: float = c.POWER_LIMIT_KW,
) -> StreamingQuery:
    """Same alerts as ``stream_alerts``, from state kept by device.

    A batch touches the state of its own devices only, however many there
    are, and the state store keeps it; ``stream_alerts`` instead reads whole
    versions of a table per batch. In turn all readings that a device has in one
    batch meet in one task: for devices that send more than that can hold, take ``stream_alerts``.
    Needs the RocksDB state store, see ``session.configure``.
    """
    limits = {"min_history": min_history, "sigmas": sigmas, "std_floor": std_floor, "temp_max": temp_max, "power_max": power_max}
    processor = _Tails(order_by, history, hard_limits, limits)
    rows = readings.select(*c.READINGS.names, *[o for o in order_by if o not in c.READINGS.names])
    alerts = rows.groupBy("device_id").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType="device_id string, event_ts timestamp, type string, value double",
        outputMode="Append", timeMode="None",
    )
    return (
        alerts.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
