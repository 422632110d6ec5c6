"""Structured Streaming jobs."""

from .alerts import stream_alerts
from .append import stream_into
from .closed import ClosedRollups, stream_closed_rollups
from .keyed import stream_alerts_keyed
from .pipeline import PipelineTables, run_pipeline
from .rollups import latest_rollups, open_rollups, stream_rollup, versions_table
from .tails import DeviceTails

__all__ = [
    "ClosedRollups", "DeviceTails", "PipelineTables", "latest_rollups", "open_rollups", "run_pipeline", "stream_alerts",
    "stream_alerts_keyed", "stream_closed_rollups", "stream_into", "stream_rollup", "versions_table",
]
