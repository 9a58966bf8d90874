"""Mixture-controlled packing of documents into token sequences.

Every source is a queue of its documents, one after the other. The queues are cut into equal shares, one
for each part of about PART_WINDOWS windows, so that every part holds the corpus's own proportions. In a
part deficit round-robin fills one window after the other: a source's deficit grows by its share of the
window, it may put in as many whole tokens as its deficit allows, and what it could not put in stays in
its deficit for the next window. Room that is left goes to the source with the largest deficit.
Documents are cut freely.

Deficits are carried from part to part as well: every part uses up all its tokens, so the deficit of a
source after a part is its share of all tokens so far less its own tokens so far, whatever happened
inside. These are running sums over the token counts of parts, so that parts are packed side by side.

All sequences of a part but the last ones are full. The rest of a part fills sequences whose sizes are
powers of two, which need no padding.

Defined cases: a null or empty text has the closing id only; documents without source share the queue of the empty name; rows
are packed one by one, so repeated rows, null ids and ties are all packed; a document longer than a
part makes its part longer; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from pulseframe.llm import bpe
from pulseframe.llm.batches import bound_batches
from pulseframe.session import materialize, scratch_path

CAPACITY = 4096
PART_WINDOWS = 128
CLOSING = 2
#: name of the queue of documents without source
NO_SOURCE = ""

#: parts whose running sums are added up in one task
_BLOCK = 1000

_TOKENS = "doc_id long, source string, n_tokens long, ids binary, chunk long, within long"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
)


def _tokens(path: str, closing: int) -> Callable:
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of each document with the closing id, as bytes of 16 bits (32 for larger vocabularies), and
        its place in the queue of its source: the task, and the source's tokens before it in the task."""
        chunk = TaskContext.get().partitionId()
        so_far: dict[str, int] = {}
        for batch in batches:
            for low, high, encoded in bpe.encode_slices(bpe.wordhash.strings(batch.column(2)), path):
                ids, offset = encoded.text_ids()
                kind = np.dtype("<u2") if ids.dtype == np.uint16 else np.dtype("<u4")
                ids = np.insert(ids.astype(kind), offset[1:], closing)
                ends = offset + np.arange(len(offset))
                sources, within = batch.column(1).slice(low, high - low), []
                for source, n in zip(sources.to_pylist(), np.diff(ends).tolist()):
                    within.append(so_far.get(source, 0))
                    so_far[source] = within[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low), sources, pa.array(np.diff(ends)), bpe.wordhash.packed(ids, ends),
                        pa.array([chunk] * (high - low), pa.int64()), pa.array(within, pa.int64()),
                    ],
                    ["doc_id", "source", "n_tokens", "ids", "chunk", "within"],
                )

    return of_batches


def _dealt(tokens: DataFrame, parts: int, width: int) -> DataFrame:
    """``tokens`` cut where the parts of their source's queue end: (part, place, doc_id, source, start, n_tokens, doc_tokens, ids).

    The places where the tasks' pieces of a queue begin are a few rows per task; the optimiser broadcasts
    them where they are small enough and shuffles otherwise.
    """
    spark = tokens.sparkSession
    chunks = tokens.groupBy("source", "chunk").agg(F.sum("n_tokens").alias("n"))
    base = _before(chunks.withColumnRenamed("chunk", "part"), ["source"], "n").withColumnRenamed("part", "chunk")
    whole = chunks.groupBy("source").agg(F.sum("n").alias("whole"))
    base = materialize(base.join(whole, "source").select("source", "chunk", "before", "whole"), scratch_path(spark, "places"))
    rows = tokens.join(base, ["source", "chunk"]).withColumn("place", F.col("before") + F.col("within"))
    rows = rows.withColumn("_past", F.col("place") + F.col("n_tokens"))
    first = F.expr(f"((cast(place AS decimal(38,0)) + 1) * {parts} - 1) DIV whole")
    last = F.expr(f"(cast(_past AS decimal(38,0)) * {parts} - 1) DIV whole")
    rows = rows.withColumn("part", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    begin = F.greatest("place", F.expr(f"(cast(part AS decimal(38,0)) * whole) DIV {parts}").cast("long"))
    end = F.least("_past", F.expr(f"((cast(part AS decimal(38,0)) + 1) * whole) DIV {parts}").cast("long"))
    rows = rows.withColumns({"_begin": begin, "_end": end}).withColumn("start", F.col("_begin") - F.col("place"))
    n = F.col("_end") - F.col("_begin")
    ids = F.substring("ids", (F.col("start") * width + 1).cast("int"), (n * width).cast("int"))
    return rows.select(
        "part", F.col("_begin").alias("place"), "doc_id", "source", "start", n.alias("n"), F.col("n_tokens").alias("doc_tokens"), ids.alias("ids")
    )


def _before(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """``rows`` with ``before``, the sum of ``value`` over smaller parts of the same ``by``, in two levels."""
    rows = rows.withColumn("_block", F.floor(F.col("part") / _BLOCK))
    blocks = rows.groupBy(*by, "_block").agg(F.sum(value).alias("_sum"))
    run = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_base", F.coalesce(F.sum("_sum").over(run), F.lit(0))).drop("_sum")
    run = Window.partitionBy(*by, "_block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum(value).over(run), F.lit(0))
    return rows.withColumn("_inner", inner).join(blocks, [*by, "_block"]).withColumn("before", F.col("_base") + F.col("_inner")).drop(
        "_block", "_base", "_inner"
    )


def carried(pieces: DataFrame, total: int, mixture: dict[str, float] | None = None) -> DataFrame:
    """(part, source, share, deficit): what each source is owed when a part begins.

    Shares are the sources' proportions of all tokens, or those of ``mixture`` (source to weight).
    """
    counts = pieces.groupBy("part", "source").agg(F.sum("n").alias("n"))
    parts = _before(counts.groupBy("part").agg(F.sum("n").alias("n")), [], "n").select("part", F.col("before").alias("all_before"))
    own = _before(counts, ["source"], "n")
    if mixture is None:
        shares = counts.groupBy("source").agg((F.sum("n") / F.lit(max(total, 1))).alias("share"))
    else:
        whole = sum(mixture.values())
        weights = F.create_map(*[x for s, w in mixture.items() for x in (F.lit(s), F.lit(w / whole))])
        shares = counts.select("source").distinct().select("source", F.coalesce(weights[F.col("source")], F.lit(0.0)).alias("share"))
    joined = own.join(parts, "part").join(shares, "source")
    return joined.select("part", "source", "share", (F.col("share") * F.col("all_before") - F.col("before")).alias("deficit"))


class _Queue:
    """The tokens of one source in a part, taken from the front. Documents are (doc_id, start, doc_tokens, ids)."""

    def __init__(self, docs: list[tuple[int | None, int, int, bytes]], width: int, share: float, deficit: float):
        self.docs, self.width, self.share, self.deficit = docs, width, share, deficit
        self.left = sum(len(doc[3]) for doc in docs) // width
        self.doc, self.at = 0, 0

    def take(self, n: int) -> Iterator[tuple[int | None, int, int, int, int]]:
        """(doc_id, start, length, crc of the ids as 32 bits, tokens of the document) of the next n tokens."""
        self.left -= n
        self.deficit -= n
        while n:
            doc_id, start, doc_tokens, ids = self.docs[self.doc]
            size = len(ids) // self.width
            length = min(n, size - self.at)
            part = ids[self.at * self.width : (self.at + length) * self.width]
            if self.width == 2:
                part = np.frombuffer(part, "<u2").astype("<u4").tobytes()
            yield doc_id, start + self.at, length, zlib.crc32(part), doc_tokens
            n -= length
            self.at += length
            if self.at == size:
                self.doc, self.at = self.doc + 1, 0


def _fill(queues: list[_Queue], size: int) -> Iterator[tuple[_Queue, int]]:
    """One window of deficit round-robin: (queue, tokens to take)."""
    room, quota = size, []
    for queue in queues:
        queue.deficit += queue.share * size
        quota.append(min(room, queue.left, max(0, math.floor(queue.deficit))))
        room -= quota[-1]
    for most in (1, size):  # what rounding left, one token each; then what empty queues left
        for i in sorted(range(len(queues)), key=lambda i: quota[i] - queues[i].deficit) if room else ():
            more = min(most, room, queues[i].left - quota[i])
            quota[i] += more
            room -= more
    for queue, n in zip(queues, quota):
        if n:
            yield queue, n


def _sizes(total: int, capacity: int) -> Iterator[int]:
    """Sequence sizes: full ones, then the powers of two that make up the rest."""
    for _ in range(total // capacity):
        yield capacity
    rest = total % capacity
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            yield 1 << bit


def pack_part(part: int, docs: dict[str, list], owed: dict[str, tuple[float, float]], capacity: int, width: int):
    """Pieces of one part: (doc_id, start, length, crc, doc_tokens, sequence_id, offset, source)."""
    names = sorted(docs)
    queues = [_Queue(docs[s], width, *owed[s]) for s in names]
    source = dict(zip(map(id, queues), names))
    for number, size in enumerate(_sizes(sum(q.left for q in queues), capacity)):
        offset = 0
        for queue, n in _fill(queues, size):
            for doc_id, start, length, crc, tokens in queue.take(n):
                yield doc_id, start, length, crc, tokens, part << 32 | number, offset, source[id(queue)]
                offset += length


def _packing(capacity: int, width: int):
    def of_part(key: tuple, docs: pa.Table, owed: pa.Table) -> pa.Table:
        order = docs.sort_by([("source", "ascending"), ("place", "ascending")])
        queues: dict[str, list] = {}
        names = ("source", "doc_id", "start", "doc_tokens", "ids")
        for source, *doc in zip(*[order[c].to_pylist() for c in names]):
            queues.setdefault(source, []).append(doc)
        carry = {s: (a, b) for s, a, b in zip(*[owed[c].to_pylist() for c in ("source", "share", "deficit")])}
        carry = {s: carry.get(s, (0.0, 0.0)) for s in queues}
        columns = list(zip(*pack_part(key[0].as_py(), queues, carry, capacity, width))) or [()] * 8
        kinds = [pa.int64()] * 7 + [pa.string()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], _names())

    return of_part


def _names() -> list[str]:
    return [field.split()[0] for field in _PIECES.split(", ")]


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    mixture: dict[str, float] | None = None,
    closing: int = CLOSING,
    part_windows: int = PART_WINDOWS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The pieces of all documents: where each lies in its document and in its sequence. ``capacity`` is a power of two."""
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE)).alias("source"), F.col(text).alias("text"))
    bound_batches(spark)
    tokens = materialize(own.mapInArrow(_tokens(path, closing), _TOKENS), scratch_path(spark, "tokens"))
    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(1, math.ceil(total / (capacity * part_windows)))
    width = 2 if len(bpe.vocabulary(path).tokens) <= 1 << 16 else 4
    pieces = _dealt(tokens, parts, width)
    owed = materialize(carried(pieces, total, mixture), scratch_path(spark, "deficits"))
    queues = pieces.select("part", "place", "doc_id", "source", "start", "doc_tokens", "ids").groupBy("part")
    return queues.cogroup(owed.groupBy("part")).applyInArrow(_packing(capacity, width), _PIECES)
