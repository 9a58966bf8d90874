"""Counts and column statistics. Every function is one pass with partial aggregation;
only per-task partial rows are shuffled, so no value of a key can overload a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulseframe import fixed
from pulseframe.functions import clip
from pulseframe.operators.clean import is_complete


def value_counts(df: DataFrame, col: str = fixed.LABEL) -> DataFrame:
    return df.groupBy(col).count()


def column_measures(cols: list[str] = fixed.VITALS) -> Column:
    """An aggregate: array of (column_name, n_null, n_total, min, max, mean, stddev)."""
    return F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(F.col(c).isNull()).alias("n_null"),
                F.count(F.lit(1)).alias("n_total"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("stddev"),
            )
            for c in cols
        ]
    )


def audit(df: DataFrame, cols: list[str] = fixed.VITALS) -> DataFrame:
    """One row of measures per column. An empty or all-null column gives NULL measures."""
    return df.agg(column_measures(cols).alias("audit")).select(F.inline("audit"))


def profile(df: DataFrame, drop: tuple[str, ...] = (fixed.CITIZEN,)) -> DataFrame:
    """The audit and the row counts of all stages before deduplication, as one row from
    one pass: audit, raw, after_nulls, after_range, n_anomalies."""
    complete = is_complete(df, [c for c in df.columns if c not in drop])
    in_range = F.col(fixed.HEART_RATE).between(*fixed.HEART_RATE_RANGE)
    return df.agg(
        column_measures().alias("audit"),
        F.count(F.lit(1)).alias("raw"),
        F.count_if(complete).alias("after_nulls"),
        F.count_if(complete & in_range).alias("after_range"),
        F.count_if(~in_range).alias("n_anomalies"),
    )


def count_anomalies(
    df: DataFrame,
    col: str = fixed.HEART_RATE,
    low: float = fixed.HEART_RATE_RANGE[0],
    high: float = fixed.HEART_RATE_RANGE[1],
) -> DataFrame:
    return df.agg(F.count_if((F.col(col) < low) | (F.col(col) > high)).alias("n_anomalies"))


def funnel(df: DataFrame, drop: tuple[str, ...] = (fixed.CITIZEN,)) -> DataFrame:
    """Row counts of each cleaning stage: raw, after_nulls, after_range, after_clean,
    removed - all from one scan and one shuffle.

    Rows are counted per distinct cleaned row. Rows a stage removes carry NULL in all
    columns, so they collapse into one group per stage before the shuffle.
    """
    df = df.drop(*drop)
    low, high = fixed.HEART_RATE_RANGE
    complete = is_complete(df)
    stage = F.when(~complete, 0).when(~F.col(fixed.HEART_RATE).between(low, high), 1).otherwise(2)
    clipped = {c: clip(F.col(c), *fixed.CLIP_RANGES[c]) if c in fixed.CLIP_RANGES else F.col(c) for c in df.columns}
    staged = df.select(
        stage.alias("_stage"), *[F.when(stage == 2, value).alias(c) for c, value in clipped.items()]
    )
    groups = staged.groupBy("_stage", *df.columns).agg(F.count(F.lit(1)).alias("_n"))

    def rows(at_least):
        return F.coalesce(F.sum(F.when(F.col("_stage") >= at_least, F.col("_n"))), F.lit(0).cast("bigint"))

    kept = F.count_if(F.col("_stage") == 2)
    return groups.agg(
        rows(0).alias("raw"),
        rows(1).alias("after_nulls"),
        rows(2).alias("after_range"),
        kept.alias("after_clean"),
        (rows(0) - kept).alias("removed"),
    )


def split_counts(df: DataFrame, split: str = "split", label: str = fixed.LABEL) -> DataFrame:
    """Rows per split and label."""
    return df.groupBy(split, label).count()


def summary(df: DataFrame, distinct_citizens: bool = False) -> DataFrame:
    """Dashboard counters; an empty table gives one row of zeros."""
    is_class = lambda name: F.count_if(F.col(fixed.CLASSIFICATION) == name)
    measures = [
        F.count(F.lit(1)).alias("total"),
        is_class(fixed.HEALTHY).alias("healthy"),
        is_class(fixed.UNHEALTHY).alias("unhealthy"),
    ]
    if distinct_citizens:
        measures.append(F.count_distinct(fixed.CITIZEN).alias("citizens"))
    return df.agg(*measures)
