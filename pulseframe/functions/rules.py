"""Threshold rules given as data."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, functions as F

from pulseframe import fixed

_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def bucket(col: Column, steps: list[tuple[str, float, str]], last: str) -> Column:
    """Name of the first step whose comparison holds, else ``last`` (NULL included)."""
    chain = F
    for comparison, bound, name in steps:
        chain = chain.when(_COMPARE[comparison](col, bound), name)
    return chain.otherwise(last)


def any_of(rules: list[tuple[str, str, float]]) -> Column:
    """True when at least one (column, comparison, bound) holds; unknown counts as no."""
    tests = [_COMPARE[c](F.col(name), bound) for name, c, bound in rules]
    return F.coalesce(reduce(operator.or_, tests), F.lit(False))


def weighted_deviation(terms=fixed.RISK_TERMS) -> Column:
    """Sum of weighted distances from an ideal value. The operations keep the given
    order, so results are bit-equal across engines."""

    def term(name, ideal, direction, span, weight):
        distance = F.abs(F.col(name) - ideal) if direction == "either" else F.lit(ideal) - F.col(name)
        return distance / span * weight

    return reduce(operator.add, [term(*t) for t in terms]).cast("double")


def interaction(rate: Column, sleep: Column) -> Column:
    short = F.lit(fixed.INTERACTION_CEILING) - sleep
    return (rate * short / fixed.INTERACTION_DIVISOR).cast("double")


def classify(probability: Column, threshold: float = fixed.CLASS_THRESHOLD) -> Column:
    """healthy below the threshold, unhealthy otherwise (NaN included), NULL for NULL."""
    return F.when(
        probability.isNotNull(),
        F.when(probability < threshold, fixed.HEALTHY).otherwise(fixed.UNHEALTHY),
    )
