"""Engineered columns. Each function is a projection and works on streams too."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulseframe import fixed
from pulseframe.functions import any_of, bucket, interaction, safe_ratio, weighted_deviation


def bucketize(df: DataFrame, col: str, out: str, steps: list[tuple[str, float, str]], last: str) -> DataFrame:
    return df.withColumn(out, bucket(F.col(col), steps, last))


def add_categories(df: DataFrame, rules: dict = fixed.CATEGORIES) -> DataFrame:
    return df.withColumns({out: bucket(F.col(c), steps, last) for out, (c, steps, last) in rules.items()})


def risk_label(df: DataFrame, out: str = fixed.LABEL) -> DataFrame:
    """1 where the vital signs are unhealthy, else 0."""
    return df.withColumn(out, F.when(any_of(fixed.UNHEALTHY_IF), 1).otherwise(0))


def add_safe_ratio(
    df: DataFrame, num: str = fixed.CALORIES, den: str = fixed.HEART_RATE, out: str = "calorie_efficiency"
) -> DataFrame:
    return df.withColumn(out, safe_ratio(F.col(num), F.col(den)))


def risk_score(df: DataFrame, terms: list = fixed.RISK_TERMS, out: str = "composite_risk_score") -> DataFrame:
    return df.withColumn(out, weighted_deviation(terms))


def add_interaction(
    df: DataFrame, rate: str = fixed.HEART_RATE, sleep: str = fixed.SLEEP, out: str = "hr_sleep_interaction"
) -> DataFrame:
    return df.withColumn(out, interaction(F.col(rate), F.col(sleep)))


def engineer(df: DataFrame) -> DataFrame:
    """Three categories and three numeric features; the same function serves training
    and scoring."""
    return add_interaction(risk_score(add_safe_ratio(add_categories(df))))
