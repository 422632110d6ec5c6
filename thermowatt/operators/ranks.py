"""Exact order statistics per group, and the summaries built on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import mean_of_units, round_half_even, to_units
from .hot_groups import SLICE, SplitPolicy, slice_groups

Rank = Callable[[Column], Column]


def at_fraction(q: float) -> Rank:
    """Position ``floor(n * q)`` counted from zero."""
    return lambda n: F.floor(n.cast("double") * F.lit(q))


def lower_middle(n: Column) -> Column:
    return F.floor((n - 1) / 2)


def upper_middle(n: Column) -> Column:
    return F.floor(n / 2)


def order_statistics(
    df: DataFrame,
    keys: list[str],
    value: str,
    ranks: dict[str, Rank],
    partial: list[Column] | None = None,
    final: list[Column] | None = None,
    policy: SplitPolicy = SplitPolicy(),
) -> DataFrame:
    """Elements of each group's sorted values at the given positions, plus the count ``n``.

    Equal values are counted before the shuffle, and a hot group is cut along
    its values, so no task sorts more than one slice. ``partial`` aggregates
    per distinct value and ``final`` aggregates per group ride along; the
    number of copies of a value is ``_copies``.
    """
    sliced = slice_groups(df.where(F.col(value).isNotNull()), keys, value, policy)
    counted = sliced.rows.groupBy(*keys, SLICE, value).agg(F.count(F.lit(1)).alias("_copies"), *(partial or []))
    if sliced.cut_keys is None:
        group = Window.partitionBy(*keys)
        placed = counted.withColumns({
            "n": F.sum("_copies").over(group),
            "_end": F.sum("_copies").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)),
        })
    else:
        # At most `slices_per_group` + 1 rows per key here.
        sizes = counted.groupBy(*keys, SLICE).agg(F.sum("_copies").alias("_size"))
        over_slices = Window.partitionBy(*keys)
        before = over_slices.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.select(
            *keys,
            SLICE,
            F.sum("_size").over(over_slices).alias("n"),
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        )
        running = Window.partitionBy(*keys, SLICE).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
        placed = counted.join(sizes, [*keys, SLICE]).withColumn("_end", F.col("_offset") + F.sum("_copies").over(running))
    n = F.col("n")
    picks = [
        F.max(F.when((rank(n) < F.col("_end")) & (rank(n) >= F.col("_end") - F.col("_copies")), F.col(value))).alias(name)
        for name, rank in ranks.items()
    ]
    return placed.groupBy(*keys).agg(F.max("n").alias("n"), *picks, *(final or []))


def latency_summary(
    df: DataFrame,
    group: str,
    value: str,
    ts: str,
    decimals: int | None = None,
    min_elapsed: float = 0.0001,
    policy: SplitPolicy = SplitPolicy(),
) -> DataFrame:
    """Count, throughput, median, 90/95/99 % points and mean of ``value`` per ``group``.

    The points are elements of the sorted values at position ``floor(n * q)``;
    the median of an even count is the mean of the middle two. Throughput is
    the count over the seconds between the first and the last ``ts``.
    ``decimals`` switches the mean to exact whole-number sums.
    """
    ranks = {
        "_lower": lower_middle,
        "_upper": upper_middle,
        "p90": at_fraction(0.90),
        "p95": at_fraction(0.95),
        "p99": at_fraction(0.99),
    }
    unit = value if decimals is None else to_units(value, decimals)
    found = order_statistics(
        df,
        [group],
        value,
        ranks,
        partial=[F.min(ts).alias("_from"), F.max(ts).alias("_to")],
        final=[
            F.expr(f"sum({unit} * _copies)").alias("_total"),
            F.min("_from").alias("_from"),
            F.max("_to").alias("_to"),
        ],
        policy=policy,
    )
    seconds = "(unix_micros(cast(_to AS timestamp)) - unix_micros(cast(_from AS timestamp))) / 1e6D"
    throughput = f"n / greatest({min_elapsed}D, {seconds})"
    mean = round_half_even("_total / n", 4) if decimals is None else mean_of_units("_total", "n", decimals, 4)
    return found.selectExpr(
        group,
        "n AS messages",
        f"{round_half_even(throughput, 2)} AS throughput_msg_sec",
        f"{round_half_even('(_lower + _upper) / 2', 4)} AS p50_ms",
        *[f"{round_half_even(p, 4)} AS {p}_ms" for p in ("p90", "p95", "p99")],
        f"{mean} AS avg_ms",
    )


def timing_comparison(
    timings: DataFrame,
    engines: list[str],
    query: str = "query",
    engine: str = "engine",
    sec: str = "sec",
    interpolate: bool = False,
    floor: float = 0.0001,
    policy: SplitPolicy = SplitPolicy(),
) -> DataFrame:
    """Median run time per query and engine, the faster engine and how many times faster it is.

    The median is the upper middle run, or with ``interpolate`` the mean of the
    middle two. On equal medians the engine named last wins.
    """
    timed = timings.where(F.col(engine).isin(engines))
    medians = order_statistics(
        timed, [query, engine], sec, {"_lower": lower_middle, "_upper": upper_middle}, policy=policy
    )
    median = (F.col("_lower") + F.col("_upper")) / 2 if interpolate else F.col("_upper")
    columns = [f"{e}_sec" for e in engines]
    wide = medians.groupBy(query).agg(
        *[F.max(F.when(F.col(engine) == e, median)).alias(name) for e, name in zip(engines, columns)]
    )
    fastest, slowest = F.least(*columns), F.greatest(*columns)
    winner = F.coalesce(*[
        F.when(F.col(name) == fastest, F.lit(e)) for e, name in reversed(list(zip(engines, columns)))
    ])
    return wide.select(
        query,
        *columns,
        winner.alias("winner"),
        (slowest / F.greatest(F.lit(floor), fastest)).alias("speedup"),
    )
