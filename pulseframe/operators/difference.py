"""What changed between two states of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ADDED, REMOVED, CHANGED, SAME = "added", "removed", "changed", "same"


def snapshot_difference(old: DataFrame, new: DataFrame, keys: list[str], same: bool = False) -> DataFrame:
    """Per key ``change`` (added, removed, changed; with ``same``, also same), the names of the ``columns`` whose values
    differ, and the structs ``before`` and ``after`` of the other columns.

    A null equals a null, in keys too, and NaN equals NaN. Both states must have one row per key; of several the
    greatest is compared. The states are stacked and grouped once, so a key that is in both meets itself in one
    shuffle, after the copies of a key were merged inside their tasks.
    """
    values = [c for c in old.columns if c not in keys]
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    sides = [df.select(*keys, F.lit(i).alias("_side"), F.struct(*[F.col(c) for c in values]).alias("_row")) for i, df in enumerate((old, new))]
    side = lambda i: F.max(F.when(F.col("_side") == i, F.col("_row")))
    met = sides[0].unionByName(sides[1]).groupBy(*keys).agg(side(0).alias("before"), side(1).alias("after"))
    differ = [F.when(~F.col(f"before.`{c}`").eqNullSafe(F.col(f"after.`{c}`")), F.lit(c)) for c in values]
    both = F.col("before").isNotNull() & F.col("after").isNotNull()
    columns = F.when(both, F.array_compact(F.array(*differ))).otherwise(F.array().cast("array<string>"))
    rows = met.withColumn("columns", columns)
    change = (
        F.when(F.col("before").isNull(), ADDED).when(F.col("after").isNull(), REMOVED).when(F.size("columns") > 0, CHANGED).otherwise(SAME)
    )
    rows = rows.withColumn("change", change).select(*keys, "change", "columns", "before", "after")
    return rows if same else rows.where(F.col("change") != SAME)


def common_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows that both have."""
    return left.intersect(right.select(*left.columns))


def missing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` beyond those of ``right``, each as many times as it exceeds."""
    return left.exceptAll(right.select(*left.columns))
