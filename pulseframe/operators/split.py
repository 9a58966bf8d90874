"""Reproducible train / validation splits.

The side of a row depends only on a hash of its key, never on partitioning or on which
attempt of a task computed it. Rows that share a key stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pulseframe import fixed
from pulseframe.functions import as_fraction, hash_long
from pulseframe.functions.hashing import HASH_BITS

TRAIN, VALIDATION = "train", "validation"
# a label's rows meet its bound in this many parts
SALTS = 64
# the histogram has up to 2**PREFIX_BITS prefixes per label, and the pass after it orders
# about (rows of the label) / 2**PREFIX_BITS hashes; both are small up to 10**12 rows
PREFIX_BITS = 16


def with_hash(
    df: DataFrame, key: str | list[str] | None = None, seed: int | None = fixed.SEED, out: str = "_hash"
) -> DataFrame:
    """Add the split hash of the key (of the whole row without one). A frame that is read
    several times can store it instead of hashing again."""
    names = [key] if isinstance(key, str) else key or df.columns
    return df.withColumn(out, hash_long([F.col(c) for c in names], seed))


def random_split(
    df: DataFrame,
    key: str | list[str] | None = None,
    share: float = fixed.TRAIN_SHARE,
    seed: int | None = fixed.SEED,
) -> DataFrame:
    """Add ``split``; a row trains when its hash falls below the share. No shuffle.
    A ``_hash`` column from ``with_hash`` is used (and dropped) if there is one."""
    hashed = df if "_hash" in df.columns else with_hash(df, key, seed)
    train = as_fraction(F.col("_hash")) < share
    return hashed.withColumn("split", F.when(train, TRAIN).otherwise(VALIDATION)).drop("_hash")


def stratified_bounds(df: DataFrame, label: str, share: float) -> DataFrame:
    """Per label the largest ``_hash`` that still trains: rows train while fewer than
    floor(share * rows of the label) rows come before them in hash order.

    A window over whole labels would put each label on one task. Instead a histogram
    over hash prefixes finds the one prefix that holds the bound, and only the distinct
    hashes below that prefix are ordered.
    """
    df = df.select(label, "_hash", F.shiftright("_hash", HASH_BITS - PREFIX_BITS).alias("_prefix"))
    rows = F.count(F.lit(1)).alias("_n")
    per_label = Window.partitionBy(label)

    def running(order):
        return per_label.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    at_bound = (
        df.groupBy(label, "_prefix")
        .agg(rows)
        .withColumns(
            {
                "_wanted": F.floor(F.sum("_n").over(per_label) * F.lit(float(share))),
                "_upto": F.sum("_n").over(running("_prefix")),
            }
        )
        .select(label, "_prefix", "_wanted", (F.col("_upto") - F.col("_n")).alias("_before"), "_upto")
        .where("_before < _wanted AND _wanted <= _upto")
        .drop("_upto")
        .withColumnsRenamed({label: "_label", "_prefix": "_at"})
    )
    same = F.col(label).eqNullSafe(F.col("_label")) & (F.col("_prefix") == F.col("_at"))
    # copies of a hot key are merged before the rows meet their label's bound
    inside = df.groupBy(label, "_prefix", "_hash").agg(rows).join(at_bound, same)
    rank = F.col("_before") + F.sum("_n").over(running("_hash")) - F.col("_n")
    return (
        inside.withColumn("_rank", rank)
        .where("_rank < _wanted")
        .groupBy(F.col(label).alias("_label"))
        .agg(F.max("_hash").alias("_bound"))
    )


def stratified_split(
    df: DataFrame,
    key: str | list[str] | None = None,
    label: str = fixed.LABEL,
    share: float = fixed.TRAIN_SHARE,
    seed: int | None = fixed.SEED,
) -> DataFrame:
    """Add ``split`` with exactly floor(share * n) training rows per label when keys are
    unique (rows sharing a key are never separated). Everything is lazy: the bounds are
    part of the plan. They are one row per label, so adaptive execution broadcasts them
    where their measured size allows it; else each label's rows meet them in SALTS parts,
    dealt by the row's place so that copies of one row part as well. A ``_hash`` column
    from ``with_hash`` is used (and dropped) if there is one."""
    hashed = df if "_hash" in df.columns else with_hash(df, key, seed)
    columns = [c for c in df.columns if c != "_hash"]
    bounds = stratified_bounds(hashed, label, share)
    same = F.col(label).eqNullSafe(F.col("_label"))
    salted = hashed.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    spread = bounds.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = salted.join(spread, same & (F.col("_salt") == F.col("_part")), "left")
    side = F.when(F.col("_hash") <= F.col("_bound"), TRAIN).otherwise(VALIDATION)
    return placed.select(*columns, side.alias("split"))


def train_validation(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    parts = [df.where(F.col("split") == side).drop("split") for side in (TRAIN, VALIDATION)]
    return parts[0], parts[1]
