"""Standardisation: one-pass statistics, kept as data and reused for scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulseframe import fixed

Stats = dict[str, dict[str, float]]


def fit_scaler(df: DataFrame, cols: list[str] = fixed.NUMERIC_FEATURES) -> DataFrame:
    """One row, one column ``stats`` STRUCT<feature: STRUCT<mean, std>>, in one pass.
    A mean without values is 0; a missing or zero sample deviation is 1."""

    def entry(c):
        deviation = F.stddev_samp(c)
        return F.struct(
            F.coalesce(F.avg(c), F.lit(0.0)).alias("mean"),
            F.coalesce(F.nullif(deviation, F.lit(0.0)), F.lit(1.0)).alias("std"),
        ).alias(c)

    return df.agg(F.struct(*[entry(c) for c in cols]).alias("stats"))


def stats_table(stats: DataFrame) -> DataFrame:
    """The fitted statistics as rows (feature, mean, std)."""
    names = stats.schema["stats"].dataType.fieldNames()
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col("stats")[c]["mean"].alias("mean"), F.col("stats")[c]["std"].alias("std"))
        for c in names
    ]
    return stats.select(F.inline(F.array(*rows)))


def stats_values(stats: DataFrame) -> Stats:
    """The statistics as numbers: a single row with two values per feature."""
    return stats.first()["stats"].asDict(recursive=True)


def scale(df: DataFrame, stats: DataFrame | Stats) -> DataFrame:
    """Add ``<feature>_scaled`` = (x - mean) / std for each fitted feature.

    Saved statistics become literals; a frame from ``fit_scaler`` is read as a scalar
    subquery, so the whole plan stays lazy.
    """
    if isinstance(stats, DataFrame):
        names = stats.schema["stats"].dataType.fieldNames()
        fitted = df.withColumn("_fitted", stats.scalar())
        scaled = {
            f"{c}_scaled": (F.col(c) - F.col(f"_fitted.{c}.mean")) / F.col(f"_fitted.{c}.std") for c in names
        }
        return fitted.withColumns(scaled).drop("_fitted")
    return df.withColumns({f"{c}_scaled": (F.col(c) - s["mean"]) / s["std"] for c, s in stats.items()})


def training_frame(df: DataFrame, features: list[str] = fixed.SCALED_FEATURES, label: str = fixed.LABEL) -> DataFrame:
    return df.select(*features, label)
