"""Statistics that are stored per batch and merged later, so that no record is read twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pulseframe import fixed
from pulseframe.session import read_partitioned

#: size of the distinct-count sketches: 2^12 registers, a relative standard error of 1.04 / 64
LG_K = 12
RELATIVE_ERROR = 1.04 / 2 ** (LG_K / 2)

MOMENTS = "feature string, n long, mean double, m2 double"


def moments(df: DataFrame, cols: list[str] = fixed.NUMERIC_FEATURES) -> DataFrame:
    """(feature, n, mean, m2) of the values that are there: count, mean and sum of squared deviations, in one pass."""
    per = [F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), (F.var_pop(c) * F.count(c)).alias("m2")).alias(c) for c in cols]
    row = df.agg(*per)
    entries = [F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}.{p}").alias(p) for p in ("n", "mean", "m2")]) for c in cols]
    return row.select(F.inline(F.array(*entries)))


def merge_moments(parts: DataFrame) -> DataFrame:
    """The moments of all rows together. Deviations are taken from a mean of the parts' means, so that nothing
    cancels out however large the values are."""
    some = parts.where("n > 0").withColumn("_near", F.avg("mean").over(Window.partitionBy("feature")))
    off = F.col("mean") - F.col("_near")
    sums = some.groupBy("feature", "_near").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * off).alias("s"), F.sum(F.col("m2") + F.col("n") * off * off).alias("q")
    )
    mean_off = F.col("s") / F.col("n")
    merged = sums.select(
        "feature", "n", (F.col("_near") + mean_off).alias("mean"), (F.col("q") - F.col("s") * mean_off).alias("m2")
    )
    empty = parts.select("feature").distinct()
    return empty.join(merged, "feature", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def scaler_of(merged: DataFrame) -> DataFrame:
    """(feature, mean, std) as ``fit_scaler`` has them: a mean without values is 0, a missing or zero deviation 1."""
    deviation = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / (F.col("n") - 1)))
    return merged.select(
        "feature", F.coalesce("mean", F.lit(0.0)).alias("mean"), F.coalesce(F.nullif(deviation, F.lit(0.0)), F.lit(1.0)).alias("std")
    )


def distinct_sketches(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Per group of ``by`` and column a sketch (binary) of the distinct values, a few KB whatever their number."""
    per = [F.struct(F.lit(c).alias("column_name"), F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias("sketch")) for c in cols]
    return df.groupBy(*by).agg(F.array(*per).alias("_s")).select(*by, F.inline("_s"))


def merge_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of larger groups, with the ``estimate`` of distinct values."""
    merged = sketches.groupBy(*by, "column_name").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.withColumn("estimate", F.hll_sketch_estimate("sketch"))


def keep_batch(part: DataFrame, path: str, batch_id: int) -> None:
    """Store the statistics of one batch; a batch that is stored again replaces itself."""
    part.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def kept_batches(df_schema: DataFrame, path: str) -> DataFrame:
    """All stored statistics of the shape of ``df_schema``."""
    return read_partitioned(df_schema.sparkSession, path, df_schema.schema)
