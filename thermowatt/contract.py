"""Table contracts shared by the batch and the streaming side.

All timestamps are instants; the session time zone is expected to be UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable=False) for n, t in columns.items()])


READINGS = _table(
    device_id=T.StringType(),
    room=T.StringType(),
    event_ts=T.TimestampType(),
    temperature_c=T.DoubleType(),
    power_kw=T.DoubleType(),
)

ROLLUPS = _table(
    device_id=T.StringType(),
    window_start=T.TimestampType(),
    avg_temp=T.DoubleType(),
    max_temp=T.DoubleType(),
    avg_power=T.DoubleType(),
    n=T.IntegerType(),
)

ALERTS = _table(
    device_id=T.StringType(),
    event_ts=T.TimestampType(),
    type=T.StringType(),
    value=T.DoubleType(),
)

REJECTED = _table(
    raw_payload=T.StringType(),
    reason=T.StringType(),
    ts=T.TimestampType(),
)

# Names and limits the stored tables and reports depend on.
TEMP_HARD_LIMIT = "temp_spike_hard_limit"
POWER_HARD_LIMIT = "power_surge_hard_limit"
TEMP_THREE_SIGMA = "temp_3_sigma_anomaly"
POWER_THREE_SIGMA = "power_3_sigma_anomaly"
TEMP_LIMIT_C = 45.0
POWER_LIMIT_KW = 10.0
TEMP_RANGE_C = (-50.0, 120.0)
HISTORY_LENGTH = 20
MIN_HISTORY = 5
SIGMAS = 3.0
STD_FLOOR = 0.05


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to the columns and types of ``schema``, dropping extras."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def breaks_contract(schema: T.StructType) -> Column:
    """Predicate for rows with a null in a NOT NULL column of ``schema``."""
    broken = F.lit(False)
    for f in schema:
        if not f.nullable:
            broken = broken | F.col(f.name).isNull()
    return broken


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Conform ``df`` and fail the job on the first row with a null in a NOT NULL column.

    Parquet files do not keep NOT NULL, so writers check it on the way out.
    """
    message = f"null in a NOT NULL column of ({', '.join(schema.names)})"
    rows = conform(df, schema)
    checked = [
        F.coalesce(F.col(f.name), F.raise_error(F.lit(message)).cast(f.dataType)).alias(f.name)
        if not f.nullable
        else F.col(f.name)
        for f in schema
    ]
    return rows.select(checked)
