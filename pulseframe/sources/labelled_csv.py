"""Labelled training CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from pulseframe import fixed


def read_training_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV with a header, which names the columns in any order; further columns are not read. All are text
    (types come from ``coerce``). Only the header is read ahead of the data. A file without one of the
    columns is an error.
    """
    names = columns or list(fixed.TRAINING_CSV)
    rows = spark.read.option("header", True).option("inferSchema", False).csv(path, enforceSchema=False)
    lacking = [c for c in names if c not in rows.columns]
    if lacking:
        raise ValueError(f"no column {', '.join(lacking)} in {path}")
    return rows.select(*names)


def read_split_csv(spark: SparkSession, path: str, features: list[str] = fixed.SCALED_FEATURES) -> DataFrame:
    """A headerless training channel: label first, then the features."""
    fields = [T.StructField(fixed.LABEL, T.IntegerType())]
    fields += [T.StructField(c, T.DoubleType()) for c in features]
    return spark.read.schema(T.StructType(fields)).csv(path, header=False)
