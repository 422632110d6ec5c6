"""Hard-limit and three-sigma alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import contract as c
from .history import PRIOR, prior_stats
from .hot_groups import SplitPolicy

_SIGNALS = ["temperature_c", "power_kw"]


# (condition, alert type, column), as SQL text
Rule = tuple[str, str, str]


def _hard_rules(temp_max: float, power_max: float) -> list[Rule]:
    return [
        (f"temperature_c > {float(temp_max)}D", c.TEMP_HARD_LIMIT, "temperature_c"),
        (f"power_kw > {float(power_max)}D", c.POWER_HARD_LIMIT, "power_kw"),
    ]


def _sigma_rules(min_history: int, sigmas: float, std_floor: float) -> list[Rule]:
    # An empty frame has no deviation; that counts as not fired, not as unknown.
    return [
        (
            f"coalesce({PRIOR} >= {min_history} AND {column}_std > {float(std_floor)}D "
            f"AND abs({column} - {column}_mean) > {float(sigmas)}D * {column}_std, false)",
            kind,
            column,
        )
        for column, kind in (("temperature_c", c.TEMP_THREE_SIGMA), ("power_kw", c.POWER_THREE_SIGMA))
    ]


def _emit(rows: DataFrame, rules: list[Rule], extra: tuple[str, ...]) -> DataFrame:
    """One alert row for each rule that holds, from one pass over ``rows``."""
    kinds = ", ".join(
        f"if({condition}, named_struct('type', '{kind}', 'value', {column}), NULL)" for condition, kind, column in rules
    )
    return (
        rows.where(" OR ".join(condition for condition, _, _ in rules))
        .selectExpr("device_id", "event_ts", *extra, f"inline(array({kinds}))")
        .where("type IS NOT NULL")
        .select("device_id", "event_ts", "type", "value", *extra)
    )


def anomaly_condition(temp_max: float = c.TEMP_LIMIT_C, power_max: float = c.POWER_LIMIT_KW) -> Column:
    """Rows over either hard limit (strict)."""
    return F.expr(" OR ".join(condition for condition, _, _ in _hard_rules(temp_max, power_max)))


def anomalous_readings(
    readings: DataFrame, temp_max: float = c.TEMP_LIMIT_C, power_max: float = c.POWER_LIMIT_KW
) -> DataFrame:
    return readings.where(anomaly_condition(temp_max, power_max))


def hard_limit_alerts(
    readings: DataFrame,
    temp_max: float = c.TEMP_LIMIT_C,
    power_max: float = c.POWER_LIMIT_KW,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Stateless alerts; batch or streaming. A reading over both limits gives two."""
    return _emit(readings, _hard_rules(temp_max, power_max), extra)


def sigma_alerts(
    readings: DataFrame,
    order_by: list[str],
    history: int = c.HISTORY_LENGTH,
    min_history: int = c.MIN_HISTORY,
    sigmas: float = c.SIGMAS,
    std_floor: float = c.STD_FLOOR,
    extra: tuple[str, ...] = (),
    seeds: DataFrame | None = None,
    policy: SplitPolicy = SplitPolicy(),
    stats: DataFrame | None = None,
) -> DataFrame:
    """Readings further than ``sigmas`` deviations from the device's previous readings.

    ``order_by`` is the arrival order inside a device; make it total. The frame
    holds earlier anomalies too. Batch input; see ``streaming.alerts`` for streams.
    ``stats`` are the readings with their statistics, where those are made already.
    """
    rows = prior_stats(readings, "device_id", order_by, _SIGNALS, history, seeds, policy) if stats is None else stats
    return _emit(rows, _sigma_rules(min_history, sigmas, std_floor), extra)


def all_alerts(
    readings: DataFrame,
    order_by: list[str],
    temp_max: float = c.TEMP_LIMIT_C,
    power_max: float = c.POWER_LIMIT_KW,
    history: int = c.HISTORY_LENGTH,
    min_history: int = c.MIN_HISTORY,
    sigmas: float = c.SIGMAS,
    std_floor: float = c.STD_FLOOR,
    extra: tuple[str, ...] = (),
    seeds: DataFrame | None = None,
    policy: SplitPolicy = SplitPolicy(),
    stats: DataFrame | None = None,
) -> DataFrame:
    """Up to four alerts per reading: hard temperature, hard power, sigma temperature, sigma power."""
    rows = prior_stats(readings, "device_id", order_by, _SIGNALS, history, seeds, policy) if stats is None else stats
    rules = _hard_rules(temp_max, power_max) + _sigma_rules(min_history, sigmas, std_floor)
    return _emit(rows, rules, extra)


def alert_count_per_reading(
    readings: DataFrame, order_by: list[str], policy: SplitPolicy = SplitPolicy()
) -> DataFrame:
    """Every reading with its number of alerts in ``alerts``, at the default limits."""
    rows = prior_stats(readings, "device_id", order_by, _SIGNALS, c.HISTORY_LENGTH, None, policy)
    rules = _hard_rules(c.TEMP_LIMIT_C, c.POWER_LIMIT_KW)
    rules += _sigma_rules(c.MIN_HISTORY, c.SIGMAS, c.STD_FLOOR)
    fired = " + ".join(f"int({condition})" for condition, _, _ in rules)
    return rows.selectExpr(*readings.columns, f"{fired} AS alerts")
