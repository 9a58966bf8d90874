"""Line deduplication through a sharded minimal perfect hash.

Lines are keyed by a 128-bit hash of their stripped, A-Z lower-cased text. The keys that several
documents hold are cut into shards of bounded size; each shard gets a minimal perfect hash (levels of
bit arrays, a key owning the bit that no other key of its level shares) whose slots index three compact
arrays: 64-bit fingerprint, first document and count. Documents then probe the arrays. A probe carries
one key of a batch of documents with the ids that hold it, so a line that a third of all documents
share travels once per batch, not once per document. Probes with many ids are dealt over as many parts of
their shard as the most frequent key needs, and the keys that such probes can have are indexed in every part.

Defined cases: a null or empty text is one empty line; keys under ``min_chars`` code points are never
dropped; documents without id are left as they are and are no source; rows with one doc_id are one
document; an empty table gives an empty result; extra columns pass through, and the result columns
``n_lines`` and ``n_dropped`` replace columns of those names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pulseframe.llm import wordhash
from pulseframe.llm.batches import bound_batches
from pulseframe.session import materialize, scratch_path

MIN_CHARS = 10
SPACES = b" \t\n\x0b\x0c\r"

#: probes (distinct keys of one batch) per shard, about; the number of shards follows from the input
SHARD_PROBES = 200_000
LEAST_SHARDS = 96

#: a probe with this many ids is dealt over parts; a part holds about PART_IDS of the most frequent key's ids
MANY_IDS = 16
PART_IDS = 4_000_000

_OFTEN = np.dtype("<i8")


# ------------------------------------------------------------------- minimal perfect hash


def build_mph(keys: np.ndarray, spread: float = 1.5) -> tuple[list[int], np.ndarray]:
    """(level sizes, bits of all levels). Distinct 64-bit keys get distinct slots 0..n-1 by ``slots``."""
    sizes, levels, rest = [], [], keys
    while len(rest):
        size = max(8, math.ceil(spread * len(rest)))
        at = _place(rest, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        levels.append(alone)
        rest = rest[~alone[at]]
    return sizes, np.concatenate(levels) if levels else np.empty(0, bool)


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
    return (wordhash.mix(keys ^ salt) % np.uint64(size)).astype(np.int64)


def slots(keys: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot of each key; -1, or any slot, for a key that was not indexed."""
    rank = np.cumsum(bits) - 1
    found = np.full(len(keys), -1, np.int64)
    open_, base = np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = _place(keys[open_], level, size) + base
        hit = bits[at]
        found[open_[hit]] = rank[at[hit]]
        open_, base = open_[~hit], base + size
    return found


_INDEX = "shard int, part int, sizes array<int>, bits binary, fingerprints binary, firsts binary, counts binary"


def build_shard(key: tuple, table: pa.Table) -> pa.Table:
    """The index row of one part of a shard: rows of (h1, h2, first, n)."""
    h1 = table["h1"].to_numpy().view(np.uint64)
    sizes, bits = build_mph(h1)
    slot = slots(h1, sizes, bits)
    arrays = []
    for column, kind in (("h2", np.int64), ("first", np.int64), ("n", np.uint32)):
        out = np.zeros(len(h1), kind)
        out[slot] = table[column].to_numpy().astype(kind)
        arrays.append(out.tobytes())
    return pa.table(
        {
            "shard": pa.array([key[0].as_py()], pa.int32()),
            "part": pa.array([key[1].as_py()], pa.int32()),
            "sizes": pa.array([sizes], pa.list_(pa.int32())),
            "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            "fingerprints": pa.array([arrays[0]], pa.binary()),
            "firsts": pa.array([arrays[1]], pa.binary()),
            "counts": pa.array([arrays[2]], pa.binary()),
        }
    )


_DROPS = pa.schema([("_doc", pa.int64()), ("h1", pa.int64())])


def probe_shard(probes: pa.Table, index: pa.Table) -> pa.Table:
    """(document, key) of the lines to drop: keys in the index whose first document is a smaller one."""
    if not len(index) or not len(probes):
        return _DROPS.empty_table()
    row = {c: index[c][0].as_py() for c in index.column_names}
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["sizes"])).astype(bool)
    h1, h2 = (probes[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
    slot = slots(h1, row["sizes"], bits)
    known = slot >= 0
    known[known] = np.frombuffer(row["fingerprints"], np.uint64)[slot[known]] == h2[known]
    docs, at = wordhash.unpacked(probes["docs"].combine_chunks(), _OFTEN)
    first = np.where(known, np.frombuffer(row["firsts"], np.int64)[slot], 0)
    drop = known[at] & (docs > first[at])
    return pa.table([pa.array(docs[drop]), wordhash.signed(h1[at[drop]])], schema=_DROPS)


# ----------------------------------------------------------------------------- documents


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The key of a line, None if it is too short to count."""
    key = line.strip(SPACES).lower()
    size = len(key)
    if size < min_chars or (size < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key


def _hash(key: bytes) -> int:
    return xxhash.xxh3_128_intdigest(key)


_PROBES = "h1 long, h2 long, first long, last long, n long, docs binary"


#: lines that are grouped before they leave a task, about
GROUP_LINES = 200_000


def _grouped(found: bytearray, ids: list[int], counts: list[int]) -> pa.RecordBatch:
    """The distinct keys of some documents with the ids that hold them."""
    halves = np.frombuffer(bytes(found), ">u8").astype(np.uint64).reshape(-1, 2)
    docs = np.repeat(np.array(ids, np.int64), counts)
    order = np.lexsort((docs, halves[:, 1], halves[:, 0]))
    h1, h2, docs = halves[order, 0], halves[order, 1], docs[order]
    new = np.ones(len(docs), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    begin = np.flatnonzero(new)
    ends = np.append(begin, len(docs))
    return pa.RecordBatch.from_arrays(
        [
            wordhash.signed(h1[begin]), wordhash.signed(h2[begin]), pa.array(docs[begin]),
            pa.array(docs[ends[1:] - 1]), pa.array(np.diff(ends)), wordhash.packed(docs.astype(_OFTEN), ends),
        ],
        ["h1", "h2", "first", "last", "n", "docs"],
    )


def _probes(min_chars: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, ids, counts = bytearray(), [], []
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = text.as_buffer().to_pybytes() if text.is_valid else b""
                keys = {k for k in (line_key(x, min_chars) for x in body.split(b"\n")) if k is not None}
                for key in keys:
                    found += xxhash.xxh3_128_digest(key)
                ids.append(doc)
                counts.append(len(keys))
            if len(found) >= 16 * GROUP_LINES:
                yield _grouped(found, ids, counts)
                found, ids, counts = bytearray(), [], []
        if found:
            yield _grouped(found, ids, counts)

    return of_batches


def _dropping(text: int, dropped: int, min_chars: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts without the lines whose key is among the dropped ones; the counts as last columns."""
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for body, keys in zip(batch.column(text), batch.column(dropped)):
                lines = body.as_buffer().to_pybytes() if body.is_valid else b""
                n_lines.append(lines.count(b"\n") + 1)
                if not keys.is_valid:
                    n_dropped.append(0)
                    kept.append(body.as_py())
                    continue
                away = {k & (2**64 - 1) for k in keys.as_py()}
                stay = []
                for line in lines.split(b"\n"):
                    key = line_key(line, min_chars)
                    if key is None or _hash(key) >> 64 not in away:
                        stay.append(line)
                n_dropped.append(n_lines[-1] - len(stay))
                kept.append(b"\n".join(stay).decode("utf-8", "replace"))
            columns = [c for i, c in enumerate(batch.columns) if i != dropped]
            names = [c for i, c in enumerate(batch.schema.names) if i != dropped]
            columns[text] = pa.array(kept, batch.schema.field(text).type)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*names, "n_lines", "n_dropped"]
            )

    return of_batches


def _shard(shards: int):
    return F.pmod(F.col("h1"), F.lit(shards)).cast("int").alias("shard")


def dealt(probes: DataFrame, shards: int, parts: int) -> DataFrame:
    """``probes`` with shard and part; those with many ids are dealt over all parts, others stay in part 0."""
    part = F.when(F.col("n") >= MANY_IDS, F.pmod(F.xxhash64("h2", "first", "last"), F.lit(parts))).otherwise(0)
    return probes.select(_shard(shards), part.cast("int").alias("part"), *probes.columns)


def indexed(repeated: DataFrame, shards: int, parts: int) -> DataFrame:
    """(shard, part, h1, h2, first, n) of the keys to index: all in part 0, in the others those a probe there can have."""
    where = F.when(F.col("n") >= MANY_IDS, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    return repeated.select(_shard(shards), F.explode(where).alias("part"), "h1", "h2", "first", "n")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines that a document with a smaller id holds; with ``n_lines`` and ``n_dropped``."""
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.drop("n_lines", "n_dropped")
    keyed = docs.select(F.col(doc_id).cast("long").alias("_doc"), text).where("_doc IS NOT NULL")
    probes = materialize(keyed.mapInArrow(_probes(min_chars), _PROBES), scratch_path(spark, "line_probes"))

    merged = probes.groupBy("h1", "h2").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")
    )
    repeated = materialize(merged.where("first < last"), scratch_path(spark, "repeated_lines"))
    shards = max(LEAST_SHARDS, math.ceil(probes.count() / SHARD_PROBES))
    parts = math.ceil((repeated.agg(F.max("n").alias("n")).first()["n"] or 1) / PART_IDS)
    index = indexed(repeated, shards, parts).groupBy("shard", "part").applyInArrow(build_shard, _INDEX)
    keys = dealt(probes, shards, parts).select("shard", "part", "h1", "h2", "docs")
    drops = (
        keys.groupBy("shard", "part").cogroup(index.groupBy("shard", "part")).applyInArrow(
            lambda left, right: probe_shard(left, right), "_doc long, h1 long"
        )
    )
    per_doc = drops.groupBy("_doc").agg(F.collect_set("h1").alias("_dropped"))
    joined = docs.withColumn("_doc", F.col(doc_id).cast("long")).join(per_doc, "_doc", "left")
    joined = joined.select(*docs.columns, "_dropped")
    schema = StructType(
        [*docs.schema.fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType())]
    )
    at = docs.columns.index(text)
    return joined.mapInArrow(_dropping(at, len(docs.columns), min_chars), schema)
