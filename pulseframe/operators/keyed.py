"""Last-write-wins keys, latest records, records not yet handled."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pulseframe import fixed


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key in ``order`` (later columns break ties).

    ``row_number() = 1`` is planned with a group limit before the shuffle: each task
    forwards at most one row per key, so a key holding a large share of the table
    costs its reducer one row per task.
    """
    by_recency = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(by_recency)).where("_rank = 1").drop("_rank")


def upsert(
    table: DataFrame, batch: DataFrame, keys: list[str] = fixed.RAW_KEY, order: list[str] | None = None
) -> DataFrame:
    """``table`` after writing ``batch``: a key keeps its last row in ``order``."""
    return latest_by_key(table.unionByName(batch), keys, order or ["seq"])


def latest_per_citizen(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    return latest_by_key(df, [fixed.CITIZEN], order or [fixed.TIMESTAMP])


def pending(raw: DataFrame, analytics: DataFrame, keys: list[str] = fixed.RAW_KEY) -> DataFrame:
    """Raw records without a row in the analytics table. With a version among the keys, a corrected record
    is pending again. Copies of a key are merged before they meet the raw records."""
    return raw.join(analytics.select(*keys).distinct(), keys, "left_anti")
