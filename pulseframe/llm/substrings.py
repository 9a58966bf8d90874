"""Substring deduplication by Relative Lempel-Ziv parsing.

The reference is the whole collection, cut into blocks: within a document every window of ``window``
words belongs to the block of its smallest seed (a hashed run of SEED words), and consecutive windows
with one seed form a block. Equal passages choose equal seeds, so they are cut into equal blocks except
at their ends, whatever stands around them.

1. Index. Every distinct block is indexed under (seed, hash of its words) with the place (document, word)
   of its first occurrence.
2. Parse. A block that an earlier document holds is a match with that place. Matches on one diagonal of one
   reference document are extended into each other. Then each document is parsed from left to right: of the
   matches that hold the next word the one that reaches furthest becomes a factor (start, end, reference
   document and word), words that none holds are literals.
3. Factor boundaries. Where a block is new but its seed is known from other blocks, a match may end
   inside it. These blocks, once each, are looked up window by window, and the matching windows extend
   the factors up to the last common word.

Every match has at least ``window`` words, so factors together are the duplicate spans; a factor may be shorter where the
one before it holds a part of its match. Blocks and windows are matched by 128-bit hashes, so no reference text has
to be at hand where a document is parsed. They are grouped within each batch before they are shuffled: a passage that a
third of the documents share travels once per batch.

Defined cases: null or empty texts have no words and no spans; texts shorter than the window lose
nothing; documents without id are left as they are and are no source; rows with one doc_id are never
sources of each other, and a factor's reference is one of the rows with its id; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulseframe.llm import wordhash
from pulseframe.llm.batches import bound_batches
from pulseframe.llm.wordhash import mix, packed, ranges, run_hashes, signed, strings, unpacked, word_slices
from pulseframe.session import materialize, scratch_path

WINDOW = 50
SEED = 12

#: an occurrence: document, checksum of its text (rows may share an id), first window, number of windows
_SPOT = np.dtype([("doc", "<i8"), ("crc", "<u4"), ("start", "<u4"), ("n", "u1")])
_MOST = 200  # windows in one block


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _windows(words: wordhash.Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and text of every window that lies inside one text."""
    counts = np.maximum(np.diff(words.offset) - window + 1, 0)
    return ranges(words.offset[:-1], counts), np.repeat(np.arange(len(counts)), counts)


def _blocks(words: wordhash.Words, window: int):
    """(text, first word, windows, seed, block hash) of all blocks of a slice."""
    at, owner = _windows(words, window)
    if not len(at):
        return None
    first, second = words.lanes
    seeds = _sliding_min(run_hashes(first, min(SEED, window)), window - min(SEED, window) + 1)[at]
    new = np.ones(len(at), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (seeds[1:] != seeds[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(at)))
    if size.max() > min(window, _MOST):  # a repeated phrase: cut the run into blocks whose ends overlap
        inside = np.arange(len(at)) - np.repeat(begin, size)
        begin = np.flatnonzero(inside % min(window, _MOST) == 0)
        size = np.diff(np.append(begin, len(at)))
    whole = run_hashes(second, window)
    left, right = whole[at[begin]], whole[at[begin + size - 1]]
    block = mix(left * np.uint64(3) + mix(right) + size.astype(np.uint64))
    return owner[begin], at[begin], size, seeds[begin], block


def _grouped(a: np.ndarray, b: np.ndarray, spots: np.ndarray) -> pa.RecordBatch:
    """One row per distinct (a, b) with its occurrences, packed, their smallest document with the place in it, and
    their largest document."""
    order = np.lexsort((spots["start"], spots["doc"], b, a))
    a, b, spots = a[order], b[order], spots[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    begin = np.flatnonzero(new)
    ends = np.append(begin, len(a))
    columns = [
        signed(a[begin]), signed(b[begin]), pa.array(spots["doc"][begin].astype(np.int64)),
        pa.array(spots["start"][begin].astype(np.int64)), pa.array(spots["doc"][ends[1:] - 1].astype(np.int64)), packed(spots, ends),
    ]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "first", "at", "last", "spots"])


def _joined(found: list) -> pa.RecordBatch:
    return _grouped(*[np.concatenate(x) for x in zip(*found)])


#: blocks or windows that are grouped before they leave a task, about
GROUP = 300_000
_GROUPED = "a long, b long, first long, at long, last long, spots binary"


def _crcs(texts: pa.Array) -> np.ndarray:
    data, ends = wordhash.text_bytes(texts)
    return np.array([zlib.crc32(data[s:e]) for s, e in zip(ends[:-1], ends[1:])], np.uint32)


def _index_blocks(window: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            texts, docs = strings(batch.column(1)), batch.column(0).to_numpy()
            crcs = _crcs(texts)
            for low, _, words in word_slices(texts, lanes=2):
                part = _blocks(words, window)
                if part is None:
                    continue
                owner, at, size, seed, block = part
                spots = np.empty(len(at), _SPOT)
                spots["doc"], spots["crc"] = docs[low + owner], crcs[low + owner]
                spots["start"], spots["n"] = at - words.offset[owner], size
                found.append((seed, block, spots))
            if sum(len(x[0]) for x in found) >= GROUP:
                yield _joined(found)
                found = []
        if found:
            yield _joined(found)

    return of_batches


#: a range of windows: start and number in one long, the text's checksum and the place in the reference in another
_RANGES = "_doc long, place long, source long, ref long, copied boolean"


def _factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences as ranges of windows: copied from an earlier document, or (its first occurrence) to be looked into."""
    for batch in batches:
        spots, at = unpacked(batch.column("spots"), _SPOT)
        origin, origin_at = (batch.column(c).to_numpy()[at] for c in ("origin", "origin_at"))
        fork = batch.column("fork").to_numpy(zero_copy_only=False).astype(bool)[at]
        copied = spots["doc"] > origin
        keep = copied | fork
        spots, copied, origin, origin_at = (x[keep] for x in (spots, copied, origin, origin_at))
        place = spots["start"].astype(np.int64) << 8 | spots["n"]
        source = spots["crc"].astype(np.uint64) << np.uint64(32) | origin_at.astype(np.uint64)
        columns = [pa.array(spots["doc"].astype(np.int64)), pa.array(place), signed(source), pa.array(origin), pa.array(copied)]
        yield pa.RecordBatch.from_arrays(columns, ["_doc", "place", "source", "ref", "copied"])


def _own_ranges(column: pa.Array, row: int, crc: int) -> tuple[np.ndarray, ...]:
    """(starts, numbers of windows, reference documents, places there) that a joined row lists for the text with this
    checksum."""
    low, high = column.offsets[row].as_py(), column.offsets[row + 1].as_py()
    place, source, ref = (column.values.field(f).to_numpy()[low:high] for f in ("place", "source", "ref"))
    mine = source.view(np.uint64) >> np.uint64(32) == crc
    place, source = place[mine], source[mine]
    return place >> 8, place & 255, ref[mine], source & 0xFFFFFFFF


def _look_into(window: int):
    """The windows of the ranges to be looked into, grouped like blocks."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            texts, docs, column = strings(batch.column("text")), batch.column("_doc").to_numpy(), batch.column("_ranges")
            crcs = _crcs(texts)
            for low, high, words in word_slices(texts, lanes=2):
                hashes = [run_hashes(lane, window, i) for i, lane in enumerate(words.lanes)]
                for text in range(low, high):
                    start, n, _, _ = _own_ranges(column, text, crcs[text])
                    if not len(start):
                        continue
                    inside = np.unique(ranges(start, n))
                    at = inside + words.offset[text - low]
                    spots = np.empty(len(at), _SPOT)
                    spots["doc"], spots["crc"], spots["start"], spots["n"] = docs[text], crcs[text], inside, 1
                    found.append((hashes[0][at], hashes[1][at], spots))
            if sum(len(x[0]) for x in found) >= GROUP:
                yield _joined(found)
                found = []
        if found:
            yield _joined(found)

    return of_batches


def _matches(start: np.ndarray, n: np.ndarray, ref: np.ndarray, ref_start: np.ndarray, window: int) -> np.ndarray:
    """Ranges of windows as matches of words: rows (begin, end, reference document, diagonal) in order of begin. Ranges
    that touch on one diagonal are one match."""
    begin, end, diagonal = start, start + n + window - 1, ref_start - start
    order = np.lexsort((begin, diagonal, ref))
    begin, end, ref, diagonal = begin[order], end[order], ref[order], diagonal[order]
    line = np.ones(len(begin), bool)  # another diagonal begins
    line[1:] = (ref[1:] != ref[:-1]) | (diagonal[1:] != diagonal[:-1])
    # running ends within a diagonal: each diagonal is lifted above the ones before
    lift = np.cumsum(line) * (int(end.max(initial=0)) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    new = line.copy()
    new[1:] |= begin[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(begin)) - 1
    found = np.column_stack([begin[first], reach[last], ref[first], diagonal[first]])
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _parsed(matches: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The greedy factors (start, end, reference document, reference word) of a text with these matches."""
    factors, at, best = [], -1, None
    rows = matches.tolist()
    for begin, end, ref, diagonal in [*rows, (None, None, None, None)]:
        # all matches that hold the next word are known: take the one that reaches furthest, as long as it is so
        while best is not None and (begin is None or begin > at):
            if best[0] <= at:
                best = None
                break
            factors.append((at, best[0], best[1], at + best[2]))
            at = best[0]
        if begin is None:
            break
        if best is None:
            at = max(at, begin)
        if best is None or end > best[0]:
            best = (end, ref, diagonal)
    return factors


_FACTOR = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())])
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_RESULT = (
    "doc_id long, n_words long, n_removed long, kept_text string, spans array<struct<start:int,end:int>>, "
    "factors array<struct<start:int,end:int,ref_doc:bigint,ref_start:int>>"
)


def _cut(window: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, column = batch.column("text"), batch.column("_ranges")
            n_words, n_removed, kept, spans, factors = [], [], [], [], []
            for row, text in enumerate(texts):
                body = text.as_buffer().to_pybytes() if text.is_valid else b""
                words = body.split()
                n_words.append(len(words))
                parsed, joined = [], []
                if column.is_valid()[row].as_py() if column.null_count else True:
                    found = _own_ranges(column, row, zlib.crc32(body))
                    if len(found[0]):
                        parsed = _parsed(_matches(*found, window))
                        for start, end, _, _ in parsed:
                            if joined and joined[-1][1] == start:
                                joined[-1][1] = end
                            else:
                                joined.append([start, end])
                        stay, past = [], 0
                        for begin, end in joined:
                            stay += words[past:begin]
                            past = end
                        words = stay + words[past:]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "replace"))
                spans.append([{"start": a, "end": b} for a, b in joined])
                factors.append([{"start": a, "end": b, "ref_doc": r, "ref_start": q} for a, b, r, q in parsed])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()),
                    pa.array(spans, pa.list_(_SPAN)), pa.array(factors, pa.list_(_FACTOR)),
                ],
                ["doc_id", "n_words", "n_removed", "kept_text", "spans", "factors"],
            )

    return of_batches


def _origins(grouped: DataFrame) -> DataFrame:
    return grouped.groupBy("a", "b").agg(
        F.min("first").alias("origin"), F.min_by("at", "first").alias("origin_at"), F.max("last").alias("last")
    )


def duplicate_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Ranges of windows (_doc, place, source, ref) of ``docs`` (_doc, text) that an earlier document holds, with the place of
    the first one that does."""
    spark = docs.sparkSession
    blocks = materialize(docs.mapInArrow(_index_blocks(window), _GROUPED), scratch_path(spark, "blocks"))

    index = _origins(blocks)
    forks = index.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", F.lit(True).alias("fork"))
    index = index.join(forks, "a", "left").where("fork OR origin < last")
    known = index.select("a", "b", "origin", "origin_at", F.coalesce("fork", F.lit(False)).alias("fork"))
    factors = blocks.select("a", "b", "spots").join(known, ["a", "b"])
    factors = factors.select("origin", "origin_at", "fork", "spots").mapInArrow(_factors, _RANGES)
    factors = materialize(factors, scratch_path(spark, "factors"))

    inside = factors.where(~F.col("copied")).groupBy("_doc").agg(_listed())
    windows = docs.join(inside, "_doc").mapInArrow(_look_into(window), _GROUPED)
    windows = materialize(windows, scratch_path(spark, "windows"))
    known = _origins(windows).where("origin < last").select("a", "b", "origin", "origin_at", F.lit(False).alias("fork"))
    ends = windows.select("a", "b", "spots").join(known, ["a", "b"])
    ends = ends.select("origin", "origin_at", "fork", "spots").mapInArrow(_factors, _RANGES)
    return factors.where("copied").unionByName(ends).select("_doc", "place", "source", "ref")


def _listed():
    return F.collect_list(F.struct("place", "source", "ref")).alias("_ranges")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id, ``n_words``, ``n_removed``, ``kept_text``, the removed ``spans`` of words (end exclusive), and the
    ``factors`` they consist of, each with the earlier document and the word there that it copies from."""
    bound_batches(docs.sparkSession)
    own = docs.select(F.col(doc_id).cast("long").alias("_doc"), F.col(text).alias("text"))
    spans = duplicate_spans(own.where("_doc IS NOT NULL"), window)
    joined = own.join(spans.groupBy("_doc").agg(_listed()), "_doc", "left")
    return joined.select(F.col("_doc").alias("doc_id"), "text", "_ranges").mapInArrow(_cut(window), _RESULT)
