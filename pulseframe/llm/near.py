"""Near-duplicate documents: fast similarity sketching, banding, exact verification.

A document is its set of word shingles. Sketching fills ``t`` bins in rounds: in round i each shingle
falls into the bin that its i-th hash names, and a bin keeps the smallest hash of the first round that
reaches it; after t such rounds every shingle goes to each bin in turn, so that all bins fill whatever
the size of the set. Two sketches agree in a bin with the probability of the sets' similarity, and the
number of agreeing bins is concentrated around it.

1. Documents with one set form a class; its smallest id stands for it from here on.
2. Bands of sketch values are bucket keys. The number of bands follows from the threshold so that a pair
   at the threshold misses all buckets with a probability of 1e-7.
3. In each bucket every member is compared with one pivot, on the full sets. Linked members become one
   component and need no further comparison. Buckets that still hold several components get another
   pivot, as long as that joins components.
4. What then shares a bucket but not a component is compared pair by pair, on the full sets, unless the
   sets cannot reach the threshold: similar sets must share one of their rarest shingles (the prefix of a
   common order by frequency), and shingles that no other set has bound the similarity.
   So every candidate link is tested, ruled out by an exact bound, or lies within a component already. No
   pair is capped, and copies are never paired with each other.

Defined cases: null, empty and blank texts have an empty set and are linked with nothing; a text with
fewer words than a shingle is one shingle; documents without id are left out; rows that share a
doc_id are one node, linked with whatever any of them is linked with; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pulseframe.llm import wordhash
from pulseframe.llm.batches import bound_batches
from pulseframe.llm.components import components
from pulseframe.llm.wordhash import mix, ranges, run_hashes, signed, strings, word_slices
from pulseframe.session import materialize, scratch_path

SHINGLE, SIMILARITY = 5, 80  # words, hundredths

#: chance to miss a pair exactly at the threshold
MISS = 1e-7
ROWS = 5
_EMPTY = np.uint64(2**64 - 1)


def bands(similarity: int) -> int:
    """Number of bands of ROWS values for a threshold in hundredths."""
    return math.ceil(math.log(MISS) / math.log1p(-((similarity / 100) ** ROWS)))


def _sets(words: wordhash.Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted, and the offset of each text's set."""
    lane = words.lanes[0]
    n_words = np.diff(words.offset)
    counts = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    at = ranges(words.offset[:-1], counts)
    hashes = np.empty(len(at), np.uint64)
    short = np.repeat(n_words < shingle, counts)
    hashes[~short] = run_hashes(lane, shingle)[at[~short]]
    for width in range(1, shingle):
        mine = np.repeat(n_words == width, counts)
        if mine.any():
            hashes[mine] = mix(run_hashes(lane, width)[at[mine]] + np.uint64(width))
    ends = np.concatenate([[0], np.cumsum(counts)])
    for low, high in zip(ends[:-1].tolist(), ends[1:].tolist()):
        hashes[low:high].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[ends[:-1][counts > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return hashes[new], kept[ends]


def sketch(hashes: np.ndarray, offset: np.ndarray, t: int) -> np.ndarray:
    """One row of ``t`` values per set; sets must not be empty."""
    n = len(offset) - 1
    out = np.full((n, t), _EMPTY, np.uint64)
    open_ = np.arange(n)
    for i in range(2 * t):
        if not len(open_):
            break
        counts = offset[open_ + 1] - offset[open_]
        salted = mix(hashes[ranges(offset[open_], counts)] + np.uint64((i + 1) * 0x632BE59BD9B4E019 % 2**64))
        row = np.repeat(np.arange(len(open_)), counts)
        if i < t:
            bin_ = ((salted >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        else:
            bin_ = np.full(len(salted), i - t)
        fresh = np.full(len(open_) * t, _EMPTY, np.uint64)
        np.minimum.at(fresh, row * t + bin_, mix(salted))
        fresh = fresh.reshape(-1, t)
        mine = out[open_]
        out[open_] = np.where(mine == _EMPTY, fresh, mine)
        open_ = open_[(out[open_] == _EMPTY).any(axis=1)]
    return out


def _band_keys(sketches: np.ndarray) -> np.ndarray:
    keys = []
    for band in range(sketches.shape[1] // ROWS):
        key = np.full(len(sketches), band, np.uint64)
        for value in sketches[:, band * ROWS : (band + 1) * ROWS].T:
            key = mix(key * np.uint64(3) + value)
        keys.append(key)
    return np.stack(keys, axis=1)


_SKETCHED = "_doc long, n_shingles long, f1 long, f2 long, keys array<long>"


def _sketching(shingle: int, similarity: int):
    t = bands(similarity) * ROWS

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Set size, set fingerprint (128 bits) and bucket keys; an empty set has no keys."""
        for batch in batches:
            docs = batch.column(0)
            for low, high, words in word_slices(strings(batch.column(1)), fold=True):
                hashes, offset = _sets(words, shingle)
                size = np.diff(offset)
                some = np.flatnonzero(size)
                prints = np.zeros((2, high - low), np.uint64)
                keys = np.empty((0, t // ROWS), np.uint64)
                if len(some):
                    for lane, salt in enumerate((0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)):
                        prints[lane, some] = np.add.reduceat(mix(hashes ^ np.uint64(salt)), offset[some])
                    keys = _band_keys(sketch(hashes, np.append(offset[some], len(hashes)), t))
                ends = np.concatenate([[0], np.cumsum((size > 0) * (t // ROWS))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs.slice(low, high - low), pa.array(size.astype(np.int64)), signed(prints[0]), signed(prints[1]),
                        pa.ListArray.from_arrays(pa.array(ends), signed(np.ascontiguousarray(keys).reshape(-1))),
                    ],
                    ["_doc", "n_shingles", "f1", "f2", "keys"],
                )

    return of_batches


def _set_arrays(shingle: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in word_slices(strings(batch.column("text")), fold=True):
                hashes, offset = _sets(words, shingle)
                sets = pa.ListArray.from_arrays(pa.array(offset.astype(np.int32)), signed(hashes))
                yield pa.RecordBatch.from_arrays([batch.column("rep").slice(low, high - low), sets], ["rep", "members"])

    return of_batches


def _linked(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    of = lambda end: sets.select(F.col("rep").alias(end), F.col("members").alias(f"_{end}"))
    both = pairs.select("a", "b").join(of("b"), "b").join(of("a"), "a")
    shared = F.size(F.array_intersect("_a", "_b"))
    counted = both.select("a", "b", shared.alias("n"), (F.size("_a") + F.size("_b")).alias("total"))
    return counted.where(100 * F.col("n") >= similarity * (F.col("total") - F.col("n"))).select("a", "b")


def _pivot(turn: int) -> Column:
    """The member of a bucket that the others are compared with: the most central one, then others by chance.

    What many copies were made from shares buckets with most of them, and is close to more of them than
    they are to each other.
    """
    chance = F.xxhash64("rep", F.lit(turn)).bitwiseAND(F.lit(1023)) if turn else F.lit(1)
    return F.max_by("rep", F.struct(F.col("central") * chance, -F.col("rep")))


#: differences from a common reference that are kept, as a share of the set
_CLOSE = 0.5


def _references(members: DataFrame) -> DataFrame:
    """(rep, ref): the most central representative that shares a bucket with each one."""
    first = F.max_by("rep", F.struct("central", -F.col("rep")))
    top = members.groupBy("key").agg(first.alias("ref"), F.max("central").alias("c"))
    return members.select("key", "rep").join(top, "key").groupBy("rep").agg(F.max_by("ref", F.struct("c", -F.col("ref"))).alias("ref"))


def _prefixes(open_: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """(rep, label, n, common, prefix, ref, n_ref, missing, extra): of n shingles, how many another open set
    has, the rarest of those of which a similar set must share one, and the differences from the
    reference set (null if there are too many to carry along)."""
    one = sets.join(open_, "rep").select("rep", F.explode("members").alias("shingle"))
    known = one.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"))
    ordered = one.join(known, "shingle").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("s"))
    least = F.expr(f"cast(ceil({similarity} * size(s) / 100) AS INT)")
    prefix = F.filter(F.slice("s", F.lit(1), F.size("s") - least + 1), lambda x: x["df"] > 1)
    rows = ordered.select(
        "rep", F.size("s").alias("n"), F.size(F.filter("s", lambda x: x["df"] > 1)).alias("common"), prefix["shingle"].alias("prefix"), least.alias("least")
    )
    rows = rows.where((F.col("common") >= F.col("least")) & (F.size("prefix") > 0)).drop("least").join(open_, "rep")
    rows = rows.join(sets, "rep").join(sets.select(F.col("rep").alias("ref"), F.col("members").alias("_ref")), "ref")
    missing, extra = F.array_except("_ref", "members"), F.array_except("members", "_ref")
    rows = rows.withColumns({"missing": missing, "extra": extra, "n_ref": F.size("_ref")})
    close = F.size("missing") + F.size("extra") <= F.lit(_CLOSE) * F.col("n")
    shown = [F.when(close, F.col(c)).alias(c) for c in ("ref", "n_ref", "missing", "extra")]
    return rows.select("rep", "label", "n", "common", "prefix", *shown)


def _remaining(prefixes: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) of different components that may be similar enough.

    The members of the commonest component of a shingle are only compared with the others, not with each
    other. Two sets with one reference are compared by their differences from it, which is exact.
    """
    rows = prefixes.withColumn("shingle", F.explode("prefix"))
    sizes = rows.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("shingle").agg(F.max_by("label", F.struct("n", "label")).alias("major"), F.count(F.lit(1)).alias("labels"))
    rows = rows.join(sizes.where("labels > 1").select("shingle", "major"), "shingle")
    named = lambda end: rows.select("shingle", "major", *[F.col(c).alias(f"{c}_{end}") for c in prefixes.columns])
    few, all_ = named("a").where("label_a <> major"), named("b").drop("major")
    return few.alias("few").join(
        all_.alias("every"),
        F.expr(f"""
            few.shingle = every.shingle AND label_a <> label_b AND (label_b = major OR label_a < label_b)
            AND 100 * least(common_a, common_b) >= {similarity} * (n_a + n_b - least(common_a, common_b))
            AND array_min(array_intersect(prefix_a, prefix_b)) = few.shingle
            AND (coalesce(ref_a <> ref_b, true) OR
              (100 + {similarity}) * (n_ref_a - size(array_union(missing_a, missing_b)) + size(array_intersect(extra_a, extra_b)))
                >= {similarity} * (n_a + n_b))"""),
    ).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles``, ``class_id`` (smallest id with the same set) and ``component_id``."""
    spark = docs.sparkSession
    bound_batches(spark)

    def keep(df: DataFrame, name: str) -> DataFrame:
        return materialize(df, scratch_path(spark, name))

    own = docs.select(F.col(doc_id).cast("long").alias("_doc"), F.col(text).alias("text")).where("_doc IS NOT NULL")
    sketches = keep(own.mapInArrow(_sketching(shingle, similarity), _SKETCHED), "sketches")

    some = sketches.where("n_shingles > 0")
    classes = some.groupBy("f1", "f2", "n_shingles").agg(F.min("_doc").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = keep(classes, "classes")
    reps = some.join(classes.withColumnRenamed("rep", "_doc").select("_doc", "f1", "f2"), ["_doc", "f1", "f2"])
    # one row per representative even if an id is repeated
    buckets = reps.select(F.col("_doc").alias("rep"), F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count(F.lit(1)).alias("size"))
    members = keep(buckets.join(keep(shared.where("low < high").select("key", "size"), "shared"), "key").distinct(), "members")
    central = keep(members.groupBy("rep").agg(F.sum("size").alias("central")), "central")
    members = keep(members.select("key", "rep").join(central, "rep"), "members")

    wanted = keep(members.select("rep").distinct(), "wanted")
    texts = own.select(F.col("_doc").alias("rep"), "text").join(wanted, "rep").mapInArrow(_set_arrays(shingle), "rep long, members array<long>")
    sets = keep(texts, "sets")

    links, labels, tested, before = None, None, None, None
    turn = 0
    while True:
        at = members.withColumn("label", F.col("rep"))
        if labels is not None:
            at = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
            at = at.select("key", "rep", "central", F.coalesce("label", "rep").alias("label"))
        spread = at.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), _pivot(turn).alias("pivot"))
        spread = keep(spread.where("low < high").select("key", "pivot"), "spread")
        at = keep(at.join(spread, "key"), "open")
        left = at.count()
        if not left:
            break
        last = before is not None and left > 0.7 * before
        if last:
            open_ = at.select("rep", "label").distinct().join(_references(members), "rep")
            prefixes = keep(_prefixes(keep(open_, "open"), sets, similarity), "prefixes")
            pairs = _remaining(prefixes, similarity)
        else:
            pairs = at.select(F.col("pivot").alias("a"), F.col("rep").alias("b")).where("a <> b")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = keep(pairs, "pairs")
        found = keep(_linked(pairs, sets, similarity), "links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        if last:
            break
        before, turn = left, turn + 1

    rep = classes.where("n > 1").select("f1", "f2", "n_shingles", "rep")
    out = sketches.select("_doc", "n_shingles", "f1", "f2").join(rep, ["f1", "f2", "n_shingles"], "left")
    out = out.select("_doc", "n_shingles", F.coalesce("rep", "_doc").alias("class_id"))
    if labels is None:
        component = out.withColumn("component_id", F.col("class_id"))
    else:
        component = out.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left")
        component = component.withColumn("component_id", F.coalesce("label", "class_id"))
    return component.select(F.col("_doc").alias("doc_id"), "n_shingles", "class_id", "component_id")
