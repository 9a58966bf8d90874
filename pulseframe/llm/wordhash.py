"""Hashes of the words and word sequences of Arrow text columns, without a Python loop over words.

A word is a run without ASCII white space. Its hash is a polynomial over its bytes, read off a running
sum; the hash of a run of words is the same over word hashes. Two independent lanes of 64 bits give
128 bits where a false match would change a result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: texts are worked on in slices of about this many bytes; a longer text forms a slice of its own
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_SEEDS = (11, 23)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


@functools.cache
def _byte_values(lane: int, fold: bool) -> np.ndarray:
    values = np.random.default_rng(_SEEDS[lane]).integers(1, 2**64, 256, np.uint64)
    if fold:
        values[65:91] = values[97:123]
    return values


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the lane's base and of its inverse modulo 2^64."""
    have = _powers.get(lane)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 65536)
        base = _BASES[lane]
        both = []
        for b in (base, pow(base, -1, 2**64)):
            run = np.full(size, b, np.uint64)
            run[0] = 1
            both.append(np.multiply.accumulate(run))
        have = (both[0], both[1])
        if n <= SLICE_BYTES + 65536:  # a single very long text leaves nothing behind
            _powers[lane] = have
    return have[0][:n], have[1][:n]


def _running(values: np.ndarray, lane: int) -> np.ndarray:
    total = np.empty(len(values) + 1, np.uint64)
    total[0] = 0
    np.cumsum(values * _power(lane, len(values))[0], out=total[1:])
    return total


def run_hashes(hashes: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """Hash of ``width`` consecutive values from each start on (empty if there are fewer values)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = _running(hashes, lane)
    return mix((total[width:] - total[:n]) * _power(lane, max(n, 1))[1])


class Words:
    """The words of a slice of texts: hash lanes, byte positions, and where each text's words begin."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, fold: bool, lanes: int):
        self.data = data
        inside = ~_SPACE[data]
        first = np.zeros(len(data) + 1, bool)  # a text begins here
        first[ends] = True
        first[0] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | first[1:-1]
        stops = inside
        stops[:-1] &= ~inside[1:] | first[1:-1]
        self.start = np.flatnonzero(begins)
        self.stop = np.flatnonzero(stops) + 1
        self.offset = np.searchsorted(self.start, ends)  # of each text's first word; one more at the end
        self.lanes = [self._hash(lane, fold) for lane in range(lanes)]

    def _hash(self, lane: int, fold: bool) -> np.ndarray:
        total = _running(_byte_values(lane, fold)[self.data], lane)
        inverse = _power(lane, max(len(self.data), 1))[1]
        return mix((total[self.stop] - total[self.start]) * inverse[self.start])

    def __len__(self) -> int:
        return len(self.start)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array without nulls, and the offsets of its texts (one more than texts)."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return body[ends[0] : ends[-1]], ends - ends[0]


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string column as one array, null as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "")


def slices(ends: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes each."""
    low, n = 0, len(ends) - 1
    while low < n:
        high = int(np.searchsorted(ends, ends[low] + limit, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def word_slices(texts: pa.Array, fold: bool = False, lanes: int = 1, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first text, end text, Words) for each slice of about ``limit`` bytes; ``fold`` lower-cases A to Z."""
    data, ends = text_bytes(texts)
    for low, high in slices(ends, limit):
        part = data[ends[low] : ends[high]]
        yield low, high, Words(part, ends[low : high + 1] - ends[low], fold, lanes)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then the same for the next."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - before, counts)


def per_text(marks: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many bytes (or words) of each text are marked; ``ends`` as of ``text_bytes``."""
    total = np.concatenate([[0], np.cumsum(marks)])
    return total[ends[1:]] - total[ends[:-1]]


def distinct_per_text(hashes: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """How many distinct hashes each text has; ``text`` is the text of each hash."""
    own = hashes ^ mix(text.astype(np.uint64) + np.uint64(1))  # equal hashes of two texts differ
    _, first = np.unique(own, return_index=True)
    return np.bincount(text[first], minlength=n_texts)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def packed(rows: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Consecutive structured rows as one binary value per group; ``ends`` has one entry more than groups."""
    raw = np.ascontiguousarray(rows).view(np.uint8).reshape(-1) if len(rows) else np.empty(0, np.uint8)
    offsets = (np.asarray(ends) * rows.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def unpacked(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The rows in a column of ``packed`` values, and for each row the position of its value."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and data.size else np.empty(0, np.uint8)
    counts = np.diff(ends) // kind.itemsize
    return raw.view(kind), np.repeat(np.arange(len(column)), counts)
