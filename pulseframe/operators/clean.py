"""Row cleaning: typed columns, incomplete rows, ranges, clipping, duplicates."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from pulseframe import fixed
from pulseframe.functions import clip, parse_double, parse_int


def coerce(df: DataFrame, types: dict[str, str] = fixed.TRAINING_CSV) -> DataFrame:
    """Give text columns their types in one projection; bad values become NULL.
    Columns not named in ``types`` pass unchanged."""
    parse = {"int": parse_int, "double": parse_double, "string": lambda c: c}
    return df.select(
        *[parse[types[c]](F.col(c)).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def is_complete(df: DataFrame, cols: list[str] | None = None) -> Column:
    """No NULL and no NaN in the given columns (all by default). Spelled as plain
    predicates, so the NOT NULL part reaches the Parquet scan; ``dropna`` does not."""
    types = dict(df.dtypes)
    tests = []
    for c in cols or df.columns:
        tests.append(F.col(c).isNotNull())
        if types[c] in ("double", "float"):
            tests.append(~F.isnan(c))
    return reduce(and_, tests)


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.where(is_complete(df, cols))


def keep_range(
    df: DataFrame,
    col: str = fixed.HEART_RATE,
    low: float = fixed.HEART_RATE_RANGE[0],
    high: float = fixed.HEART_RATE_RANGE[1],
) -> DataFrame:
    """Rows with low <= col <= high."""
    return df.where(F.col(col).between(low, high))


def clip_values(df: DataFrame, ranges: dict[str, tuple[float, float]] = fixed.CLIP_RANGES) -> DataFrame:
    return df.withColumns({c: clip(F.col(c), *bounds) for c, bounds in ranges.items()})


def dedupe(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Distinct rows, or one row per key.

    Copies are merged within each task before the shuffle, so a row repeated in a large
    share of the input reaches its reducer once per task. With ``keys`` the smallest of
    the rows sharing a key stays, whatever the partitioning.
    """
    if not keys:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def clean(df: DataFrame, drop: tuple[str, ...] = (fixed.CITIZEN,), keys: list[str] | None = None) -> DataFrame:
    """The whole cleaning chain: drop identifiers, incomplete rows and rate anomalies,
    clip, remove duplicates. Narrow up to the one shuffle of the last step."""
    df = drop_incomplete(df.drop(*drop))
    return dedupe(clip_values(keep_range(df)), keys)
