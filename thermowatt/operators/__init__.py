"""Operators over DataFrames."""

from .anomalies import all_alerts, anomalous_readings, anomaly_condition, hard_limit_alerts, sigma_alerts
from .audit import (
    delivery_audit, duplicated_keys, expected_sequence, missing_keys, missing_ranges, parity_by_digest,
    parity_check, pipeline_stats, processed_keys,
)
from .hot_groups import SplitPolicy
from .layout import by_device, cached
from .messages import to_messages
from .panels import count_by, count_since, recent, row_count, series, since
from .ranks import latency_summary, order_statistics, timing_comparison
from .reports import (
    anomaly_count, readings_per_device, room_daily_power, room_hourly_temperature, top_anomalous_devices,
)
from .windows import merge_rollup_parts, rollup, rollup_parts
from .validation import decode, rejected_rows, split_valid, valid_readings, validate
from .weather import default_stations, weather_to_readings

__all__ = [
    "SplitPolicy", "all_alerts", "anomalous_readings", "anomaly_condition", "anomaly_count", "by_device", "cached",
    "count_by", "count_since", "decode", "default_stations", "delivery_audit", "duplicated_keys",
    "expected_sequence", "hard_limit_alerts", "latency_summary", "merge_rollup_parts", "missing_keys",
    "missing_ranges", "order_statistics", "parity_by_digest", "parity_check", "pipeline_stats", "processed_keys", "readings_per_device", "recent",
    "rejected_rows", "rollup", "rollup_parts", "room_daily_power", "room_hourly_temperature", "row_count", "series",
    "sigma_alerts", "since", "split_valid", "timing_comparison", "to_messages", "top_anomalous_devices",
    "valid_readings", "validate", "weather_to_readings",
]
