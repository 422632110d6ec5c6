"""Splitting of groups that are too large for one task.

A group is hot when it holds more than ``rows_per_slice`` rows, as counted. It
is cut along an ordering column at its own quantiles, into slices of about
that many rows. The slices come in order, so work on one slice only needs a
short carry from the slices before it. What is kept about hot groups is one
cut point per slice, so never more than all rows divided by ``rows_per_slice``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

SLICE = "_slice"
_CUTS = "_cuts"
_CHUNK = 64


@dataclass(frozen=True)
class SplitPolicy:
    """``rows_per_slice``: rows of one group that a task should work on at most. The rule is the same for any input size."""

    rows_per_slice: int = 2_000_000


@dataclass(frozen=True)
class Sliced:
    """Rows with a slice number; ``cut_keys`` holds the keys that were cut, if any."""

    rows: DataFrame
    helper_columns: tuple[str, ...]
    cut_keys: DataFrame | None = None


def _hot_counts(df: DataFrame, keys: list[str], policy: SplitPolicy) -> list[tuple]:
    """Rows (keys..., n) of the hot groups: fewer than all rows divided by ``rows_per_slice``."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return [tuple(r) for r in counts.where(F.col("_n") > policy.rows_per_slice).collect()]


def _cut_value(df: DataFrame, order: str) -> tuple[str, T.DataType]:
    """The ordering column in a type that is cheap to compare."""
    kind = df.schema[order].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"unix_micros(cast({order} AS timestamp))", T.LongType()
    if isinstance(kind, T.NumericType):
        return order, kind
    raise TypeError(f"cannot cut groups along {order}: {kind.simpleString()}")


def _cut_table(
    df: DataFrame, keys: list[str], order: str, hot: list[tuple], policy: SplitPolicy
) -> DataFrame:
    """Table (keys..., sorted cut points in short arrays) with one row per hot group."""
    spark = df.sparkSession
    key_fields = [df.schema[k] for k in keys]
    key_table = spark.createDataFrame([r[:-1] for r in hot], T.StructType(key_fields))
    value, kind = _cut_value(df, order)
    limit = policy.rows_per_slice
    finest = math.ceil(max(r[-1] for r in hot) / limit)
    fractions = [i / finest for i in range(1, finest)]
    # A smaller group takes every so many of the cut points of the largest.
    step = f"greatest(1, int({finest} / ceil(_n / {limit}D)))"
    found = (
        df.selectExpr(*keys, f"{value} AS _value")
        .join(F.broadcast(key_table), keys, "left_semi")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_value", fractions, 4 * finest).alias(_CUTS))
        .selectExpr(*keys, f"array_sort(array_distinct(filter({_CUTS}, (c, i) -> (i + 1) % {step} = 0))) AS {_CUTS}")
        .collect()
    )
    nested = [
        (*[r[k] for k in keys], [r[_CUTS][i : i + _CHUNK] for i in range(0, len(r[_CUTS]), _CHUNK)])
        for r in found
    ]
    cuts_type = T.ArrayType(T.ArrayType(kind))
    return spark.createDataFrame(nested, T.StructType([*key_fields, T.StructField(_CUTS, cuts_type)]))


def _slice_number(value: str) -> str:
    """How many cut points are at or below ``value``; found in two short steps."""
    chunk = f"size(filter({_CUTS}, c -> c[0] <= {value}))"
    inside = f"size(filter(element_at({_CUTS}, {chunk}), c -> c <= {value}))"
    return f"CASE WHEN {_CUTS} IS NULL OR {chunk} = 0 THEN 0 ELSE ({chunk} - 1) * {_CHUNK} + {inside} END"


def slice_groups(df: DataFrame, keys: list[str], order: str, policy: SplitPolicy = SplitPolicy()) -> Sliced:
    """Add a slice number that grows with ``order`` inside each group.

    Groups that are not hot have slice 0 only. In a hot group every slice from
    1 on is non-empty, because each cut point is a value of that group. Runs a
    job that counts groups, and one more for the cut points of hot ones.
    Hidden columns of the result are listed in ``helper_columns``.
    """
    whole = Sliced(df.withColumn(SLICE, F.lit(0)), (SLICE,))
    hot = _hot_counts(df, keys, policy)
    if not hot:
        return whole
    table = _cut_table(df, keys, order, hot, policy)
    # Bounded: one cut point per `rows_per_slice` rows.
    rows = df.join(F.broadcast(table), keys, "left").withColumn(SLICE, F.expr(_slice_number(_cut_value(df, order)[0])))
    return Sliced(rows, (SLICE, _CUTS), table.select(*keys))
