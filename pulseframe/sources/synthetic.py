"""Labelled data from normal distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseframe import fixed
from pulseframe.functions import clip, hash_normals
from pulseframe.operators.features import risk_label


def synthetic_for(ids: DataFrame, id_col: str, seed: int = fixed.SEED) -> DataFrame:
    """One labelled record per id. Values come from a hash of (seed, id): a record does
    not change with partitioning, and no state is shared between tasks. The label is set
    before the values are cut to their stored precision."""
    key = F.col(id_col)
    z = [*hash_normals(key, f"{seed}.0"), *hash_normals(key, f"{seed}.1")]
    drawn = ids.select(
        F.format_string("C%03d", key.cast("bigint")).alias(fixed.CITIZEN),
        *[
            clip(normal * spread + mean, low, high).alias(c)
            for normal, (c, (mean, spread, low, high)) in zip(z, fixed.GENERATED.items())
        ],
    )
    return risk_label(drawn).select(
        fixed.CITIZEN,
        F.col(fixed.HEART_RATE).cast("int"),
        F.round(fixed.O2, 4).alias(fixed.O2),
        F.round(fixed.SLEEP, 2).alias(fixed.SLEEP),
        F.col(fixed.CALORIES).cast("int"),
        fixed.LABEL,
    )


def synthetic(
    spark: SparkSession, n: int = fixed.GENERATED_ROWS, seed: int = fixed.SEED, partitions: int | None = None
) -> DataFrame:
    return synthetic_for(spark.range(1, n + 1, 1, partitions), "id", seed)
