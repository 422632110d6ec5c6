from pyspark.sql import functions as F

from thermowatt import (
    delivery_audit, duplicated_keys, expected_sequence, missing_keys, missing_ranges, parity_by_digest, parity_check,
    pipeline_stats, processed_keys, validate,
)
from .helpers import bag


def seqs(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], "seq long")


def test_nothing_lost(spark):
    runs = {"before": seqs(spark, range(1, 41)), "after": seqs(spark, range(41, 101))}
    assert delivery_audit(expected_sequence(spark, 100), runs).first().asDict() == {
        "produced": 100, "processed_before": 40, "processed_after": 60, "unique_processed": 100,
        "missing": 0, "duplicated": 0, "success": True,
    }


def test_lost_and_repeated(spark):
    first = seqs(spark, [n for n in range(1, 41) if n != 7])
    second = seqs(spark, [40, 40] + [n for n in range(41, 101) if n != 50])
    expected = expected_sequence(spark, 100)
    found = delivery_audit(expected, {"before": first, "after": second}).first()
    assert (found["missing"], found["duplicated"], found["success"]) == (2, 1, False)
    assert (found["processed_before"], found["processed_after"], found["unique_processed"]) == (39, 60, 98)
    assert set(bag(missing_keys(expected, [first, second]))) == {(7,), (50,)}
    assert bag(duplicated_keys(first, second)) == {(40,): 1}
    assert processed_keys([first, second]).count() == 98


def test_unexpected_key_is_no_success(spark):
    found = delivery_audit(expected_sequence(spark, 3), {"only": seqs(spark, [1, 2, 3, 9])}).first()
    assert (found["missing"], found["unique_processed"], found["success"]) == (0, 4, False)


def test_parity(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k long, v string")
    b = spark.createDataFrame([(2, None), (1, "x"), (3, "x")], "k long, v string")
    same = parity_check(a, a).first()
    assert same["identical"] and same["same_shape"]
    found = parity_check(a, b).first().asDict()
    assert found == {
        "same_schema": True, "same_shape": True, "rows_a": 3, "rows_b": 3, "only_in_a": 1, "only_in_b": 1, "identical": False,
    }
    other = parity_check(a, b.select("k")).first()
    assert not other["same_schema"] and not other["same_shape"] and not other["identical"]
    empty = parity_check(a.limit(0), a.limit(0)).first()
    assert empty["identical"] and empty["rows_a"] == 0


def test_pipeline_counters(spark):
    good = '{{"device_id":"s","room":"r","event_ts":"2026-10-08T12:0{}:00Z","temperature_c":{},"power_kw":1}}'
    raw = spark.createDataFrame([(good.format(i, 50 if i == 2 else 20), i) for i in range(4)] + [("x", 9)], "value string, seq int")
    stats = pipeline_stats(validate(raw), ["event_ts", "seq"]).first().asDict()
    assert stats == {"received": 5, "readings": 4, "rejected": 1, "alerts": 1, "aggregates": 4}


def test_more_runs_than_a_number_has_bits(spark):
    runs = {f"r{i}": seqs(spark, [i, i + 1]) for i in range(1, 71)}
    found = delivery_audit(expected_sequence(spark, 72), runs).first()
    assert (found["unique_processed"], found["missing"], found["duplicated"]) == (71, 1, 69)
    assert found["processed_r1"] == found["processed_r63"] == found["processed_r70"] == 2


def test_missing_ranges(spark):
    def run(*keys):
        return spark.createDataFrame([(k,) for k in keys], "seq long")

    runs = {"all": run(*range(-5, 31)), "some": run(0, 1, 1, 2, 7, 8, 20, 20, None, 99), "none": run(), "ends": run(*range(1, 25))}
    for width in (1, 4, 1 << 20):
        got = {tuple(r) for r in missing_ranges(runs, 0, 25, width=width).collect()}
        assert got == {
            ("some", 3, 6, 4), ("some", 9, 19, 11), ("some", 21, 25, 5), ("none", 0, 25, 26), ("ends", 0, 0, 1), ("ends", 25, 25, 1),
        }
    assert {tuple(r) for r in missing_ranges({"x": run(-4, 2)}, -6, 3, width=4).collect()} == {("x", -6, -5, 2), ("x", -3, 1, 5), ("x", 3, 3, 1)}


def test_missing_ranges_shuffle_keys_once(spark):
    rows = spark.range(1000).select(F.col("id").alias("seq"))
    plan = missing_ranges({"a": rows, "b": rows.where("seq % 7 > 0")}, 0, 1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(source#") - plan.count("ReusedExchange") <= 3


def test_parity_by_digest(spark):
    def rows(values):
        return spark.createDataFrame(values, "a string, b double, c timestamp")

    base = [("x", 1.0, None), ("x", 1.0, None), (None, 0.0, None), ("y", float("nan"), None), (None, None, None)] + [(str(i), i / 7, None) for i in range(60)]
    for other in (base, base[::-1], base[1:], base + base[:1], [("x", 1.5, None)] + base[1:], [(None, 1.0, None)] + base[1:], []):
        assert parity_by_digest(rows(base).repartition(3), rows(other), buckets=16).first() == parity_check(rows(base), rows(other)).first()
    assert parity_by_digest(rows([("x", -0.0, None)]), rows([("x", 0.0, None)])).first()["identical"]
    assert not parity_by_digest(rows(base), rows(base).withColumn("b", F.col("b").cast("string"))).first()["same_schema"]


def test_equal_tables_shuffle_digests_only(spark):
    rows = spark.range(20_000).selectExpr("id % 777 AS a", "id AS b").repartition(4)
    rows.cache().count()
    found = parity_by_digest(rows, rows.select("a", "b"), buckets=8)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    # No row reaches the comparison: adaptive execution leaves its shuffle out.
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert "hashpartitioning(a#" not in final
    assert found.first()["identical"] and found.first()["rows_a"] == 20_000
