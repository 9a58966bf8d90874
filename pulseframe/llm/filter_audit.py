"""What each filter of a chain removes, for every order of the filters.

Documents are counted per part and mask (bit i: filter i fails); whatever the corpus, a part has 2^k masks
at most. A document of a mask is removed by the first filter of an order that is in its mask. Orders are
numbered by their Lehmer rank, the place among all permutations in lexicographic order, so the orders that
start with the same filters form an interval of ranks. For a mask and a step they are all starts whose last
filter is in the mask and whose others are not: the mask's count is added to a difference array where each
interval begins and taken off where it ends, and a prefix sum over the ranks gives what each order removes
at each step. All further numbers follow from these and from the masks.

Defined cases: a null text is the empty text; rows without id have the identical text of no earlier document,
make none, and have no labels; a null part is the empty string; repeated rows count each, and rows of one id
with one text are the same document for filter E; of several labels for one id the larger counts; labels
without document have no effect; an empty table gives no rows. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pulseframe.llm import wordhash
from pulseframe.llm.batches import bound_batches
from pulseframe.session import materialize, scratch_path

MIN_WORDS = 100
MIN_DISTINCT = 80
MAX_CAPITALS = 10
SYMBOLS = "#$%&*|"
#: too short, repetitive, shouting, symbols, identical to an earlier document
FILTERS = "ABCDE"

# ---------------------------------------------------------------------- masks of documents

_LEDGER = "doc_id long, part string, mask int, key binary"


def _measuring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    symbols = np.isin(np.arange(256), list(SYMBOLS.encode()))
    for batch in batches:
        data, ends = wordhash.text_bytes(wordhash.strings(batch.column("text")))
        masks, keys = [], []
        for low, high in wordhash.slices(ends):
            body, own = data[ends[low] : ends[high]], ends[low : high + 1] - ends[low]
            words = wordhash.Words(body, own, False, 1)
            n_words = np.diff(words.offset)
            distinct = wordhash.distinct_per_text(words.lanes[0], np.repeat(np.arange(high - low), n_words), high - low)
            points = wordhash.per_text((body & 0xC0) != 0x80, own)
            fails = (
                n_words < MIN_WORDS,
                100 * distinct < MIN_DISTINCT * n_words,
                100 * wordhash.per_text((body >= 65) & (body <= 90), own) > MAX_CAPITALS * points,
                wordhash.per_text(symbols[body], own) > 0,
            )
            masks.append(sum(f.astype(np.int32) << i for i, f in enumerate(fails)))
            view = memoryview(body)
            keys += [hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(own[:-1], own[1:])]
        mask = pa.array(np.concatenate(masks) if masks else [], pa.int32())
        columns = [batch.column("doc_id"), batch.column("part"), mask, pa.array(keys, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "mask", "key"])


def failure_masks(docs: DataFrame, part: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, part, mask, n) of the documents that share them; the mask has the bits of FILTERS.

    Texts are identical if their 128-bit digests are. Copies are merged inside each task before they are
    shuffled, and the copies of a text are spread by their ids.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    own = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.col(text).alias("text")
    )
    rows = materialize(own.mapInArrow(_measuring, _LEDGER), scratch_path(spark, "masks"))
    known = rows.where("doc_id IS NOT NULL")
    earliest = known.groupBy("key").agg(F.min("doc_id").alias("doc_id")).withColumn("earliest", F.lit(True))
    alike = known.groupBy("doc_id", "key", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    copied = F.when(F.col("earliest").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    judged = alike.join(earliest, ["doc_id", "key"], "left").withColumn("mask", F.col("mask").bitwiseOR(copied))
    of_ids = judged.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    without = rows.where("doc_id IS NULL").groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    return of_ids.unionByName(without)


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and mask, and those labelled good and toxic."""
    flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(f"_{c}")
    per_id = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marked = per_id.agg(flag("quality"), flag("toxic")).where("_quality + _toxic > 0")
    named = masks.where("doc_id IS NOT NULL").join(marked, "doc_id", "left")
    rows = named.unionByName(masks.where("doc_id IS NULL"), allowMissingColumns=True)
    weighed = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0)))
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), weighed(F.col("_quality")).alias("good"), weighed(F.col("_toxic")).alias("toxic")
    )


# ------------------------------------------------------------------------ orders of filters


def rank_intervals(mask: int, k: int) -> list[tuple[int, int, int]]:
    """(step, first rank, end rank) of the orders of k filters in which that step removes the mask's documents."""
    found = []

    def extend(rest: list[int], step: int, rank: int) -> None:
        size = math.factorial(len(rest) - 1)  # orders that start with one more given filter
        for place, chosen in enumerate(rest):
            if mask >> chosen & 1:
                found.append((step, rank + place * size, rank + (place + 1) * size))
            else:
                extend(rest[:place] + rest[place + 1 :], step + 1, rank + place * size)

    if mask:
        extend(list(range(k)), 1, 0)
    return found


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """For every part, order and step of ``mask_counts``: documents kept, removed, redundant (failing the step's
    filter, but removed before), unique_fails, good_lost, toxic_lost, and shapley (removed by the step's filter in all
    orders). ``filters`` has one letter per bit, in alphabetical order."""
    spark, k = counts.sparkSession, len(filters)
    orders = F.array(*[F.lit("".join(o)) for o in permutations(filters)])
    ends = [
        (mask, step, rank, sign)
        for mask in range(1 << k)
        for step, low, high in rank_intervals(mask, k)
        for rank, sign in ((low, 1), (high, -1))
        if rank < math.factorial(k)
    ]
    differences = spark.createDataFrame(ends, "mask int, step int, rank int, sign int")  # given by k alone
    sums = ("n", "good", "toxic")
    added = counts.join(differences, "mask").select("part", "step", "rank", *[(F.col("sign") * F.col(c)).alias(c) for c in sums])
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"))
    every = F.explode(F.sequence(F.lit(0), F.lit(math.factorial(k) - 1))).alias("rank")
    zeros = parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"), *[F.lit(0).cast("long").alias(c) for c in sums])
    zeros = zeros.select("part", "step", every, *sums)
    array = added.unionByName(zeros).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in sums])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    rows = array.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in sums])
    rows = rows.withColumn("filter_order", F.element_at(orders, F.col("rank") + 1))
    rows = rows.withColumn("filter", F.expr("substring(filter_order, step, 1)"))

    each = F.explode(F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(1 << i).alias("bit")) for i, f in enumerate(filters)]))
    fails = counts.select("part", "mask", "n", each.alias("f")).groupBy("part", F.col("f.filter").alias("filter")).agg(
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("f.bit")) != 0, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == F.col("f.bit"), F.col("n")).otherwise(0)).alias("unique_fails"),
    )
    steps = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(parts, "part").join(fails, ["part", "filter"])
    return joined.select(
        "part", "filter_order", "step",
        (F.col("total") - F.sum("n").over(steps)).alias("kept"),
        F.col("n").alias("removed"),
        (F.col("fails") - F.col("n")).alias("redundant"),
        "unique_fails",
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The interactions of the five FILTERS on ``docs``, with the losses that ``labels`` (doc_id, quality, toxic) show."""
    counts = mask_counts(failure_masks(docs, part), labels)
    return interactions(materialize(counts, scratch_path(docs.sparkSession, "mask_counts")))
