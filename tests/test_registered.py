"""Every registered query against its SQL twin, and the shape of its plan."""

import pytest

from __spark_entry__ import entry
from check_oracle import compare, connect
from thermowatt.operators.hot_groups import SLICE, SplitPolicy, slice_groups
from thermowatt.plans import oracle as oracle_sql, registered as queries, views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert queries().keys() == oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(queries()))
def test_same_rows_as_sql(spark, con, name):
    assert compare(spark, con, name, SF) is None


def test_entry(spark):
    assert entry(spark).columns == ["device_id", "event_ts", "type", "value"]


def plan(spark, name):
    return queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in queries() if not n.startswith("stream_")))
def test_no_python_rows_and_no_cross_joins(spark, name):
    text = plan(spark, name)
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


@pytest.mark.parametrize("name, exchanges", [
    ("scan_readings", 0), ("readings_by_device", 1), ("valid_readings", 0), ("rejected_rows", 0), ("anomalous_readings", 0),
    ("hard_limit_alerts", 0), ("reading_messages", 0), ("all_alerts", 1), ("three_sigma_alerts", 1),
    ("alert_messages", 1), ("rollup_1h", 1), ("anomaly_count", 1), ("q3_top_anomalous_devices", 1),
    ("q1_room_hourly_temp", 2), ("q4_readings_per_device", 2), ("delivery_audit", 2), ("parity_check", 2),
    ("latency_summary", 2),
])
def test_number_of_shuffles(spark, name, exchanges):
    assert plan(spark, name).count("Exchange hashpartitioning") + plan(spark, name).count("Exchange rangepartitioning") + plan(
        spark, name
    ).count("Exchange SinglePartition") == exchanges


def test_columns_are_pruned(spark):
    text = plan(spark, "q4_readings_per_device")
    assert "ReadSchema: struct<user_id:bigint>" in text


def test_range_filter_reaches_the_scan(spark):
    assert "LessThanOrEqual(value,120.0)" in plan(spark, "panel_total_readings")
    assert "ReadSchema: struct<value:double>" in plan(spark, "panel_total_readings")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_groups_are_cut_by_one_rule_at_any_size(spark, sf):
    rows = views.in_range(spark, f"/root/testdata/{sf}").selectExpr("event_ts", "device_id = 'sensor-1' AS odd")
    limit = rows.count() // 5
    found = slice_groups(rows, ["odd"], "event_ts", SplitPolicy(limit)).rows.groupBy("odd", SLICE).count().collect()
    assert max(r["count"] for r in found) < 1.2 * limit
    assert len([r for r in found if not r["odd"]]) == -(-sum(r["count"] for r in found if not r["odd"]) // limit)
