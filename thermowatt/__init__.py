"""Sensor telemetry on Spark: validation, anomalies, rollups, reports and audits."""

from .contract import ALERTS, READINGS, REJECTED, ROLLUPS
from .operators import *  # noqa: F401,F403
from .operators import __all__ as _operators

__all__ = ["ALERTS", "READINGS", "REJECTED", "ROLLUPS", *_operators]
