"""Joins by time: the last record before each moment, and the moments inside intervals.

Neither builds pairs that it then throws away by the key alone, and neither brings all rows of a key together: both work
in buckets of time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _complete(columns: list[str]) -> Column:
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return known


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    time: str,
    width: int,
    right_time: str | None = None,
    ties: list[str] | None = None,
    tolerance: int | None = None,
    out: str = "matched",
) -> DataFrame:
    """``left`` with the struct ``out``: the last row of ``right`` with equal ``on`` at or before the left row's time; null
    if there is none, or none within ``tolerance``. Times are whole numbers; of right rows at one time the one with
    the largest ``ties`` counts.

    Both sides are merged in buckets of ``width``: inside a bucket of a key the rows are put in order of time, and
    each left row takes the last right row before it. What a bucket inherits is one row, the last right row of any
    earlier bucket of the key; it is found among one row per bucket and enters the bucket as its first. So a key's
    rows meet by bucket only, and one shuffle brings both sides together.

    Left rows whose key or time is null match nothing and are kept; such right rows are left out.
    """
    right_time = right_time or time
    row = F.struct(F.col(right_time).cast("long").alias("_t"), *(ties or []), F.struct(*right.columns).alias("_r"))
    own_type = F.struct(*left.columns)
    bucket = F.floor(F.col("_t") / F.lit(width)).cast("long").alias("_bucket")

    known = left.where(_complete([*on, time]))
    moments = known.select(*on, F.col(time).cast("long").alias("_t"), F.lit(1).alias("_side"), own_type.alias("_l"))
    moments = moments.select("*", bucket)
    records = right.where(_complete([*on, right_time])).select(*on, row.alias("_row"))
    records = records.select(*on, F.col("_row._t").alias("_t"), F.lit(0).alias("_side"), "_row").select("*", bucket)

    # the last right row of each bucket, then of all buckets before
    per_bucket = records.groupBy(*on, "_bucket").agg(F.max("_row").alias("_last"))
    wanted = moments.groupBy(*on, "_bucket").agg(F.lit(None).cast(per_bucket.schema["_last"].dataType).alias("_last"))
    both = per_bucket.unionByName(wanted).groupBy(*on, "_bucket").agg(F.max("_last").alias("_last"))
    earlier = Window.partitionBy(*on).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    inherited = both.select(*on, "_bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_row")).where("_row IS NOT NULL")
    inherited = inherited.select(*on, "_bucket", F.lit(None).cast("long").alias("_t"), F.lit(0).alias("_side"), "_row")

    merged = moments.unionByName(records, allowMissingColumns=True).unionByName(inherited, allowMissingColumns=True)
    so_far = Window.partitionBy(*on, "_bucket").orderBy(F.asc_nulls_first("_t"), "_side", F.asc_nulls_first("_row"))
    so_far = so_far.rowsBetween(Window.unboundedPreceding, 0)
    found = merged.select("_side", "_l", "_t", F.last("_row", ignorenulls=True).over(so_far).alias("_row")).where("_side = 1")
    near = F.lit(True) if tolerance is None else F.col("_t") - F.col("_row._t") <= tolerance
    matched = found.select("_l.*", F.when(near, F.col("_row._r")).alias(out))
    without = left.where(~_complete([*on, time]))
    return matched.unionByName(without.withColumn(out, F.lit(None).cast(matched.schema[out].dataType)))


def _level(length: Column) -> Column:
    """The least k for which 2^k is at least the length."""
    return F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1)))


def interval_join(
    moments: DataFrame, intervals: DataFrame, on: list[str], time: str, start: str, end: str, out: str = "interval"
) -> DataFrame:
    """Every pair of a moment and an interval (the struct ``out``) with equal ``on`` and start <= time < end; times are whole
    numbers.

    An interval is filed under buckets of the power of two that its length just fits into, so it touches two of them
    at most, whatever its length; a moment is looked up once per power that occurs (64 at most). Rows meet by key,
    power and bucket, and a pair meets once. Nulls, and intervals that end before they start, match nothing.
    """
    spans = intervals.where(_complete([*on, start, end])).where(F.col(end) > F.col(start))
    length = F.col(end).cast("long") - F.col(start).cast("long")
    spans = spans.select(*on, F.struct(*intervals.columns).alias(out), F.col(start).cast("long").alias("_a"), F.col(end).cast("long").alias("_b"), _level(length).alias("_level"))
    first, last = F.expr("shiftright(_a, _level)"), F.expr("shiftright(_b - 1, _level)")
    filed = spans.select("*", F.explode(F.array_distinct(F.array(first, last))).alias("_bucket"))
    levels = sorted(r["_level"] for r in spans.select("_level").distinct().collect())  # 64 at most
    at = moments.where(_complete([*on, time])).select(*on, F.struct(*moments.columns).alias("_m"), F.col(time).cast("long").alias("_t"))
    looked_up = at.select("*", F.explode(F.array(*[F.lit(k) for k in levels]) if levels else F.array().cast("array<int>")).alias("_level"))
    looked_up = looked_up.withColumn("_bucket", F.expr("shiftright(_t, _level)"))
    met = looked_up.join(filed, [*on, "_level", "_bucket"]).where("_a <= _t AND _t < _b")
    return met.select("_m.*", out)
