"""Batch ETL: labelled CSV -> processed Parquet, train / validation CSV, statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession, functions as F

from pulseframe import fixed
from pulseframe.operators.clean import clean, coerce
from pulseframe.operators.features import engineer
from pulseframe.operators.profile import profile, split_counts, value_counts
from pulseframe.operators.report import preview
from pulseframe.operators.scaling import fit_scaler, scale, stats_values, training_frame
from pulseframe.operators.split import TRAIN, random_split, stratified_split, train_validation, with_hash
from pulseframe.session import materialize, remove_folder
from pulseframe.sinks.files import (
    register_table,
    stats_document,
    table_properties,
    write_processed,
    write_document,
    write_training_csv,
)
from pulseframe.sources.labelled_csv import read_training_csv

# after deduplication these columns identify a row: all others are computed from them
ROW_KEY = fixed.VITALS + [fixed.LABEL]
#: engineered rows shown in the report
SAMPLE_ROWS = 5


def run_etl(
    spark: SparkSession,
    source: str,
    dest: str,
    as_of: datetime,
    split: str = "stratified",
    fit_on: str = "all",
    share: float = fixed.TRAIN_SHARE,
    seed: int = fixed.SEED,
    table: str | None = None,
) -> dict:
    """Run the whole preparation; returns the run's counts and statistics.

    The text is parsed once into typed Parquet, the one shuffle (deduplication) runs once
    into engineered Parquet, and split and scaling once into a third; every later pass is
    a narrow, column-pruned scan of those files. They live below ``dest`` until the run
    has succeeded.

    ``fit_on='train'`` takes the scaling statistics from training rows only.
    """
    if split not in ("stratified", "random") or fit_on not in ("all", "train"):
        raise ValueError(f"split={split!r}, fit_on={fit_on!r}")
    dest = dest.rstrip("/")
    typed = coerce(read_training_csv(spark, source)).drop(fixed.CITIZEN)  # never parsed
    landed = materialize(typed, f"{dest}/_staging/landed")
    seen = profile(landed).first()
    value_counts(landed).write.mode("overwrite").json(f"{dest}/reports/label_distribution")

    engineered = with_hash(engineer(clean(landed)), ROW_KEY, seed)
    features = materialize(engineered, f"{dest}/_staging/features")
    sample = preview(features, [*ROW_KEY, *fixed.CATEGORIES, *fixed.ENGINEERED], SAMPLE_ROWS, ROW_KEY)
    sample.write.mode("overwrite").json(f"{dest}/reports/sample")
    divide = stratified_split if split == "stratified" else random_split
    placed = divide(features, share=share)

    # the statistics of all rows do not depend on the split
    fitted_rows = features if fit_on == "all" else placed.where(F.col("split") == TRAIN)
    stats = stats_values(fit_scaler(fitted_rows))
    scaled = materialize(scale(placed, stats), f"{dest}/_staging/scaled")

    write_processed(scaled.drop("split"), f"{dest}/{fixed.PROCESSED}")
    train, validation = train_validation(training_frame_with_split(scaled))
    write_training_csv(train, f"{dest}/{fixed.TRAIN_FILE}")
    write_training_csv(validation, f"{dest}/{fixed.VALIDATION_FILE}")

    per_split = materialize(split_counts(scaled), f"{dest}/_staging/split_counts")
    per_split.write.mode("overwrite").json(f"{dest}/reports/split_counts")
    is_train = F.col("split") == TRAIN
    counted = per_split.agg(
        F.sum(F.when(is_train, F.col("count")).otherwise(0)).alias("train"),
        F.sum("count").alias("total"),
    ).first()
    total, n_train = counted["total"] or 0, counted["train"] or 0
    n_val = total - n_train

    exact = fixed.STATISTICS_FILE.replace(".json", "_exact.json")
    for name, digits in ((fixed.STATISTICS_FILE, 6), (exact, None)):
        document = stats_document(stats, n_train, n_val, total, as_of, digits)
        write_document(spark, document, f"{dest}/{fixed.CONFIG}/{name}")
    if table:
        properties = table_properties(total, n_train, n_val, len(stats), as_of, source)
        register_table(spark, table, f"{dest}/{fixed.PROCESSED}", properties)
    remove_folder(spark, f"{dest}/_staging")
    return {
        "audit": [row.asDict() for row in seen["audit"]],
        "raw": seen["raw"],
        "after_nulls": seen["after_nulls"],
        "after_range": seen["after_range"],
        "anomalies": seen["n_anomalies"],
        "after_clean": total,
        "removed": seen["raw"] - total,
        "train": n_train,
        "validation": n_val,
        "stats": stats,
    }


def training_frame_with_split(scaled):
    return scaled.select(*training_frame(scaled).columns, "split")
