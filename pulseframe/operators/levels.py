"""Aggregates at several levels of detail in one pass."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F


def rollup_sets(dimensions: list[str]) -> list[tuple[str, ...]]:
    """From all dimensions to none, the last one dropped first."""
    return [tuple(dimensions[:n]) for n in range(len(dimensions), -1, -1)]


def cube_sets(dimensions: list[str]) -> list[tuple[str, ...]]:
    """Every choice of dimensions."""
    return [c for n in range(len(dimensions), -1, -1) for c in combinations(dimensions, n)]


def aggregate_levels(df: DataFrame, dimensions: list[str], sets: list[tuple[str, ...]], **aggregates: Column) -> DataFrame:
    """One row per level and group: the dimensions (null where the level does not have them), ``level`` (its
    dimensions, joined by a comma), and the aggregates.

    The rows are expanded to the levels and summed up inside tasks before one shuffle. The level tells a null that
    stands for "all" from one in the data. A table without rows gives no rows, not even of the empty level.
    """
    unknown = {c for s in sets for c in s} - set(dimensions)
    if unknown:
        raise ValueError(f"not among the dimensions: {sorted(unknown)}")
    names = [F.when(F.grouping(c) == 0, F.lit(c)) for c in dimensions]
    level = F.concat_ws(",", *names).alias("level")
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dimensions])
    rows = grouped.agg(level, *[a.alias(name) for name, a in aggregates.items()])
    return rows.select(*dimensions, "level", *aggregates)
