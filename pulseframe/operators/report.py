"""Presentation: defaults, class and time columns, display rows, previews, JSON."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from pulseframe import fixed
from pulseframe.functions import classify, display_number, display_percent, escape_html, iso_millis


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace NULL by a default; a text default also replaces the empty text."""

    def filled(name, value) -> Column:
        col = F.col(name)
        if isinstance(value, str):
            col = F.nullif(col, F.lit(""))
        return F.coalesce(col, F.lit(value))

    return df.withColumns({c: filled(c, v) for c, v in defaults.items()})


def add_classification(
    df: DataFrame, probability: str, threshold: float = fixed.CLASS_THRESHOLD, out: str = fixed.CLASSIFICATION
) -> DataFrame:
    return df.withColumn(out, classify(F.col(probability), threshold))


def stamp(df: DataFrame, as_of: datetime | Column, out: str = fixed.INFERENCE_TS) -> DataFrame:
    """The run's time, given by the caller so that a repeated run writes equal rows."""
    return df.withColumn(out, iso_millis(as_of))


def report_rows(df: DataFrame) -> DataFrame:
    """Dashboard rows as text: units attached, '-' for missing values, the citizen id safe to show in a page."""
    types = dict(df.dtypes)

    def number(name, unit):
        col = F.col(name)
        whole = types[name] in ("tinyint", "smallint", "int", "bigint")
        text = F.coalesce(col.cast("string"), F.lit("-")) if whole else display_number(col)
        return F.concat(text, F.lit(unit))

    cls = F.coalesce(F.nullif(F.col(fixed.CLASSIFICATION), F.lit("")), F.lit(fixed.UNKNOWN))
    stamped = F.coalesce(F.nullif(F.col(fixed.INFERENCE_TS), F.lit("")), F.lit("-"))
    return df.select(
        escape_html(F.coalesce(F.col(fixed.CITIZEN).cast("string"), F.lit(""))).alias(fixed.CITIZEN),
        number(fixed.HEART_RATE, " bpm").alias("heart_rate"),
        display_percent(F.col(fixed.O2)).alias("o2"),
        number(fixed.SLEEP, "h").alias("sleep"),
        number(fixed.CALORIES, " kcal").alias("calories"),
        cls.alias(fixed.CLASSIFICATION),
        stamped.alias(fixed.INFERENCE_TS),
    )


def preview(df: DataFrame, cols: list[str], n: int = 5, order: list[str] | None = None) -> DataFrame:
    """The first n rows; with ``order`` a top-n that never sorts the whole input."""
    return (df.orderBy(*order) if order else df).limit(n).select(*cols)


def json_records(df: DataFrame, out: str = "record") -> DataFrame:
    """One JSON object per row. Missing values are written as null."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(out))
