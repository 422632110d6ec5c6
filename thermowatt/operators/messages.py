"""Rows to keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from ..functions import iso_text


def to_messages(df: DataFrame, key: str = "device_id", columns: list[str] | None = None, text: str | None = None) -> DataFrame:
    """``(key, value)`` pairs; the value is the JSON of ``columns`` with ISO timestamps.

    With ``text`` that column is the value as it stands.
    """
    if text is not None:
        return df.selectExpr(f"cast({key} AS string) AS key", f"cast({text} AS string) AS value")
    fields = ", ".join(
        f"'{name}', {iso_text(name) if isinstance(df.schema[name].dataType, T.TimestampType) else name}"
        for name in columns or df.columns
    )
    return df.selectExpr(f"cast({key} AS string) AS key", f"to_json(named_struct({fields})) AS value")
