"""Delivery, parity and throughput audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..contract import READINGS
from ..sources.workspace import shared_folder
from .anomalies import alert_count_per_reading
from .hot_groups import SplitPolicy
from .validation import valid_readings

_SIDES_PER_MASK = 62


def expected_sequence(spark, last: int, first: int = 1, key: str = "seq") -> DataFrame:
    """Every number from ``first`` to ``last``."""
    return spark.range(first, last + 1).withColumnRenamed("id", key)


def processed_keys(runs: list[DataFrame], key: str = "seq") -> DataFrame:
    """Keys handled by any run."""
    return reduce(DataFrame.union, [r.select(key) for r in runs]).distinct()


def missing_keys(expected: DataFrame, runs: list[DataFrame], key: str = "seq") -> DataFrame:
    """Expected keys that no run handled."""
    return expected.select(key).distinct().join(processed_keys(runs, key), key, "left_anti")


def duplicated_keys(first: DataFrame, second: DataFrame, key: str = "seq") -> DataFrame:
    """Keys that both runs handled."""
    return first.select(key).intersect(second.select(key))


def delivery_audit(expected: DataFrame, runs: dict[str, DataFrame], key: str = "seq") -> DataFrame:
    """One row: keys produced, handled per run and in all, missing, in more than one run, and the verdict.

    One shuffle: every key is reduced to bit masks of the sides it appears on,
    one mask for so many sides as a number has bits.
    """
    sides = [expected, *runs.values()]
    words = range(-(-len(sides) // _SIDES_PER_MASK))

    def bits(i: int, word: int) -> Column:
        return F.lit(1 << i % _SIDES_PER_MASK if i // _SIDES_PER_MASK == word else 0).cast("long")

    marked = reduce(DataFrame.union, [
        side.select(F.col(key), *[bits(i, w).alias(f"mask_{w}") for w in words]) for i, side in enumerate(sides)
    ])
    masks = marked.groupBy(key).agg(*[F.bit_or(f"mask_{w}").alias(f"mask_{w}") for w in words])

    def seen_on(i: int) -> Column:
        return F.col(f"mask_{i // _SIDES_PER_MASK}").bitwiseAND(bits(i, i // _SIDES_PER_MASK)) != 0

    is_expected = seen_on(0)
    handled = reduce(Column.__add__, [F.bit_count(f"mask_{w}") for w in words]) - is_expected.cast("int")
    report = masks.agg(
        F.count_if(is_expected).alias("produced"),
        *[
            F.count_if(seen_on(i)).alias(f"processed_{name}")
            for i, name in enumerate(runs, start=1)
        ],
        F.count_if(handled > 0).alias("unique_processed"),
        F.count_if(is_expected & (handled == 0)).alias("missing"),
        F.count_if(handled > 1).alias("duplicated"),
    )
    success = (F.col("missing") == 0) & (F.col("unique_processed") == F.col("produced"))
    return report.withColumn("success", success)


def missing_ranges(runs: dict[str, DataFrame], first: int, last: int, key: str = "seq", width: int = 1 << 20) -> DataFrame:
    """Ranges ``(source, first, last, n)`` of the numbers from ``first`` to ``last`` that a run did not handle.

    Gaps between neighbours, found with ``lag`` inside blocks of ``width``
    numbers. What reaches over the border of blocks is found from each
    block's lowest and highest number: one row per block, so ``width`` times less than numbers.
    Keys may repeat; nulls and numbers beyond the range are left out. One shuffle of the keys.
    """
    handled = reduce(DataFrame.union, [
        run.select(F.lit(name).alias("source"), F.col(key).cast("bigint").alias("_at")).where(F.col("_at").between(first, last))
        for name, run in runs.items()
    ])
    blocks = handled.withColumn("_block", F.expr(f"(_at - pmod(_at, {width}L)) div {width}L")).repartition("source", "_block")
    inside = Window.partitionBy("source", "_block").orderBy("_at")
    near = blocks.select("source", F.lag("_at").over(inside).alias("_before"), "_at").where("_at - _before > 1")
    # Each run gets a number before the first and one after the last, so that open ends are gaps like any other.
    ends = reduce(DataFrame.union, [
        handled.sparkSession.range(1).select(
            F.lit(name).alias("source"), F.lit(block).cast("bigint").alias("_block"), F.lit(at).alias("_low"), F.lit(at).alias("_high")
        )
        for name in runs for block, at in ((first // width - 1, first - 1), (last // width + 1, last + 1))
    ])
    spans = blocks.groupBy("source", "_block").agg(F.min("_at").alias("_low"), F.max("_at").alias("_high"))
    along = Window.partitionBy("source").orderBy("_block")
    far = spans.unionByName(ends).select("source", F.lag("_high").over(along).alias("_before"), F.col("_low").alias("_at")).where(
        "_at - _before > 1"
    )
    return near.union(far).selectExpr("source", "_before + 1 AS first", "_at - 1 AS last", "_at - _before - 1 AS n")


def parity_check(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row telling whether two tables are equal as bags of rows.

    One shuffle over all columns, with copies counted before it. When names or
    types differ, only the shapes are compared.
    """
    same_schema = a.dtypes == b.dtypes
    same_width = len(a.columns) == len(b.columns)
    left, right = F.col("_a"), F.col("_b")
    if same_schema:
        both = a.select("*", F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionAll(
            b.select("*", F.lit(0).alias("_a"), F.lit(1).alias("_b"))
        )
        both = both.groupBy(*a.columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    else:
        both = a.agg(F.count(F.lit(1)).alias("_a")).select("_a", F.lit(0).alias("_b")).unionAll(
            b.agg(F.count(F.lit(1)).alias("_b")).select(F.lit(0).alias("_a"), "_b")
        )
    counts = both.agg(
        F.coalesce(F.sum(left), F.lit(0)).alias("rows_a"),
        F.coalesce(F.sum(right), F.lit(0)).alias("rows_b"),
        F.coalesce(F.sum(F.greatest(left - right, F.lit(0))), F.lit(0)).alias("only_in_a"),
        F.coalesce(F.sum(F.greatest(right - left, F.lit(0))), F.lit(0)).alias("only_in_b"),
    )
    return counts.select(
        F.lit(same_schema).alias("same_schema"),
        (F.lit(same_width) & (F.col("rows_a") == F.col("rows_b"))).alias("same_shape"),
        "rows_a",
        "rows_b",
        "only_in_a",
        "only_in_b",
        (F.lit(same_schema) & (F.col("only_in_a") == 0) & (F.col("only_in_b") == 0)).alias("identical"),
    )


def parity_by_digest(a: DataFrame, b: DataFrame, buckets: int = 4096) -> DataFrame:
    """``parity_check`` for tables that are expected to be equal, without shuffling their rows.

    Rows are dealt into buckets by hash. Of each bucket both sides add up the
    rows' 128-bit hashes, one side with the other sign: equal bags add up to
    zero, in any order and with any copies. Only the rows of other buckets are
    compared. Equal tables shuffle one row per bucket and task. Rows that differ
    go unseen where sums of 128-bit hashes agree.
    """
    if a.dtypes != b.dtypes:
        return parity_check(a, b)
    names = [f"`{n}`" for n in a.columns]
    hashes = f"named_struct('x', xxhash64({', '.join(names)}), 'y', xxhash64(1, {', '.join(names)}, {', '.join(f'{n} IS NULL' for n in names)}))"

    def marked(rows: DataFrame, sign: int) -> DataFrame:
        return rows.selectExpr("*", f"{hashes} AS _h", f"{sign} AS _sign").selectExpr("*", f"pmod(_h.y, {buckets}L) AS _bucket")

    both = marked(a, 1).unionAll(marked(b, -1))
    halves = [f"_sign * {part}" for h in ("_h.x", "_h.y") for part in (f"shiftright({h}, 32)", f"({h} & 4294967295L)")]
    sums = both.groupBy("_bucket").agg(
        F.expr("count_if(_sign = 1)").alias("_a"), F.expr("count_if(_sign = -1)").alias("_b"),
        *[F.expr(f"sum({half})").alias(f"_s{i}") for i, half in enumerate(halves)],
    )
    unlike = "_a <> _b OR " + " OR ".join(f"_s{i} <> 0" for i in range(len(halves)))
    found = both.join(sums.where(unlike).select("_bucket"), "_bucket", "left_semi")
    compared = found.groupBy(*a.columns).agg(F.expr("sum(_sign)").alias("_more")).agg(
        F.coalesce(F.sum(F.greatest("_more", F.lit(0))), F.lit(0)).alias("only_in_a"),
        F.coalesce(F.sum(F.greatest(-F.col("_more"), F.lit(0))), F.lit(0)).alias("only_in_b"),
    )
    counts = sums.agg(F.coalesce(F.sum("_a"), F.lit(0)).alias("rows_a"), F.coalesce(F.sum("_b"), F.lit(0)).alias("rows_b"))
    one = total_counters(
        compared.selectExpr("0L AS rows_a", "0L AS rows_b", "only_in_a", "only_in_b").unionAll(
            counts.selectExpr("rows_a", "rows_b", "0L AS only_in_a", "0L AS only_in_b")
        )
    )
    return one.selectExpr(
        "true AS same_schema", "rows_a = rows_b AS same_shape", "rows_a", "rows_b", "only_in_a", "only_in_b",
        "only_in_a = 0 AND only_in_b = 0 AS identical",
    )


def pipeline_stats(
    validated: DataFrame, order_by: list[str], size: str = "1 minute", policy: SplitPolicy = SplitPolicy()
) -> DataFrame:
    """One row of counters: messages received, readings, rejected, alerts and rollup windows.

    ``order_by`` columns come from ``validated``. What the check found is
    written to the shared folder once, without the texts, so every message is
    parsed once. Alerts and windows are counted from one shuffle by device.
    """
    needed = [*dict.fromkeys([*READINGS.names, *order_by]), "reason_code"]
    path = shared_folder(validated.sparkSession, "checked")
    checked = validated.select(*needed)
    checked.write.parquet(path)
    validated = validated.sparkSession.read.schema(checked.schema).parquet(path)
    arrived = validated.selectExpr(
        "1 AS received", "int(reason_code IS NULL) AS readings", "int(reason_code IS NOT NULL) AS rejected",
        "0 AS alerts", "0 AS aggregates",
    )
    extra = tuple(c for c in order_by if c != "event_ts")
    counted = alert_count_per_reading(valid_readings(validated, extra), order_by, policy)
    windows = counted.groupBy("device_id", F.window("event_ts", size)).agg(F.sum("alerts").alias("alerts"))
    produced = windows.selectExpr("0 AS received", "0 AS readings", "0 AS rejected", "alerts", "1 AS aggregates")
    return total_counters(arrived.unionByName(produced))


def total_counters(rows: DataFrame) -> DataFrame:
    """One row with the sum of every column, zero where there are no rows."""
    return rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in rows.columns])
