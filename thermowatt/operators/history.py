"""Statistics over the rows that came before, per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from .hot_groups import SLICE, Sliced, SplitPolicy, slice_groups

PRIOR = "_prior_n"
GIVEN = "_given"
NEWEST = "_newest"
_FRESH = "_fresh"
_POSITION = "_position"


def _arrival(order_by: list[str]) -> list[Column]:
    """Seeds first, in their stored order, then the new rows."""
    return [F.col(_FRESH), F.col(_POSITION), *[F.col(c) for c in order_by]]


def _newest(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The last ``n`` rows per key with their ``_rank`` (1 = newest).

    Spark applies the rank limit before the shuffle as well as after it, so a
    hot key sends at most ``n`` rows per map task.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order])
    return rows.withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") <= n)


def _stats(frame: WindowSpec, columns: list[str]) -> list[Column]:
    stats = [F.count(F.lit(1)).over(frame).alias(PRIOR)]
    for c in columns:
        stats.append(F.avg(c).over(frame).alias(f"{c}_mean"))
        stats.append(F.stddev_pop(c).over(frame).alias(f"{c}_std"))
    return stats


def _with_older(
    readings: DataFrame, sliced: Sliced, key: str, order_by: list[str], columns: list[str], history: int, seeds: DataFrame | None
) -> tuple[DataFrame, WindowSpec]:
    """Readings with the older rows their frames reach back to, not ``GIVEN``, and the window they lie in."""
    rows = sliced.rows.withColumns({_FRESH: F.lit(1), _POSITION: F.lit(0), GIVEN: F.lit(True)})
    order = _arrival(order_by)
    older = seeds
    if sliced.cut_keys is not None:
        cut_keys = F.broadcast(sliced.cut_keys)
        tails = _newest(rows.join(cut_keys, key, "left_semi"), [key, SLICE], order, history)
        tails = tails.select(key, SLICE, _FRESH, _POSITION, *order_by, *columns)
        if seeds is not None:
            # For a cut key the seeds are a slice of their own, in front of slice 0.
            before = seeds.join(cut_keys, key, "left_semi").withColumns({_FRESH: F.lit(0), SLICE: F.lit(-1)})
            tails = tails.unionByName(before, allowMissingColumns=True)
            older = seeds.join(cut_keys, key, "left_anti")
        # Slices from 1 on are non-empty, so the next history + 1 slices are the
        # only ones whose frames can reach back into this one.
        later = F.sequence(F.col(SLICE) + 1, F.col(SLICE) + history + 1)
        carried = _newest(tails.withColumn(SLICE, F.explode(later)), [key, SLICE], order, history)
        rows = rows.unionByName(carried.drop("_rank").withColumn(GIVEN, F.lit(False)), allowMissingColumns=True)
    if older is not None:
        given = older.withColumns({_FRESH: F.lit(0), SLICE: F.lit(0), GIVEN: F.lit(False)})
        rows = rows.unionByName(given, allowMissingColumns=True)
    frame_keys = [key] if sliced.cut_keys is None else [key, SLICE]
    return rows, Window.partitionBy(*frame_keys).orderBy(*order)


def prior_stats(
    readings: DataFrame,
    key: str,
    order_by: list[str],
    columns: list[str],
    history: int,
    seeds: DataFrame | None = None,
    policy: SplitPolicy = SplitPolicy(),
) -> DataFrame:
    """Mean and population deviation of ``columns`` over the previous ``history`` rows of the key.

    The current row is not part of its own frame. Adds ``<column>_mean``,
    ``<column>_std`` and the frame's row count. ``seeds`` are older rows
    ``(key, _position, columns...)`` that come before all of ``readings``.

    One shuffle on the key. A hot key is cut along ``order_by[0]`` and each
    slice gets the last rows of the slices before it, so the frames are the
    same as over the uncut key.
    """
    sliced = slice_groups(readings, [key], order_by[0], policy)
    if sliced.cut_keys is None and seeds is None:
        frame = Window.partitionBy(key).orderBy(*order_by).rowsBetween(-history, -1)
        return readings.select("*", *_stats(frame, columns))

    rows, window = _with_older(readings, sliced, key, order_by, columns, history, seeds)
    helpers = (_FRESH, _POSITION, GIVEN, *sliced.helper_columns)
    return rows.select("*", *_stats(window.rowsBetween(-history, -1), columns)).where(GIVEN).drop(*helpers)


def stats_and_newest(
    readings: DataFrame,
    key: str,
    order_by: list[str],
    columns: list[str],
    history: int,
    seeds: DataFrame | None = None,
    policy: SplitPolicy = SplitPolicy(),
) -> tuple[DataFrame, DataFrame | None]:
    """``prior_stats`` and what ``last_rows`` needs, from one shuffle and one sort.

    Gives the readings (``GIVEN``) together with those seeds that stay among the
    last ``history`` rows of their key, each with its place ``NEWEST`` from the
    end of its key (1 = newest), and the keys that were cut, if any. For a cut
    key the place counts inside a slice only.
    """
    sliced = slice_groups(readings, [key], order_by[0], policy)
    rows, window = _with_older(readings, sliced, key, order_by, columns, history, seeds)
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Counted from the front: a frame that ends with the key would be gone through again for every row.
    place = F.count(F.lit(1)).over(whole) - F.row_number().over(window) + 1
    stats = _stats(window.rowsBetween(-history, -1), columns)
    marked = rows.select("*", *stats, place.alias(NEWEST)).where(F.col(GIVEN) | (F.col(NEWEST) <= history))
    return marked.drop(_FRESH, _POSITION, *sliced.helper_columns), sliced.cut_keys


def last_rows(
    readings: DataFrame, key: str, order_by: list[str], columns: list[str], history: int, seeds: DataFrame | None = None
) -> DataFrame:
    """The last ``history`` rows per key as seeds ``(key, _position, columns...)`` for later rows."""
    rows = readings.select(key, *order_by, *columns).withColumns({_FRESH: F.lit(1), _POSITION: F.lit(0)})
    if seeds is not None:
        rows = rows.unionByName(seeds.withColumn(_FRESH, F.lit(0)), allowMissingColumns=True)
    return _newest(rows, [key], _arrival(order_by), history).select(
        key, (F.lit(history) - F.col("_rank")).alias(_POSITION), *columns
    )
