"""Helpers of the operators in this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import shared_folder

#: Fixed value: the white space that separates words, as a character class body.
BLANKS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, with no lineage behind it.

    The small side of a join is stored as well where it comes from an aggregate over the join's own key:
    both sides are then plain shuffles, of which adaptive execution can split a hot key.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def private_session(spark: SparkSession, **settings: str) -> SparkSession:
    """A session on the same context with the caller's settings and some of its own; the caller's stay untouched."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in settings.items():
        own.conf.set(key, value)
    return own
