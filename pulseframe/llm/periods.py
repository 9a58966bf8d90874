"""Periodic runs of words, by string synchronising sets.

A run is a longest stretch of words whose smallest period p fits into it ``exponent`` times at least
(words p apart are identical), of ``min_length`` words or more. It is found so:

* Periods up to DIRECT are compared outright, word with word, for every such distance.
* For scale t = DIRECT / 2, twice that, and so on, windows of t/2 words get hashes, and a position is
  chosen if its hash is the least of those up to t/2 words on, or the hash t/2 words on is. That depends
  on the next t words only, and of any t/2 neighbouring positions one is chosen. So a run of period p
  (2t < p <= 4t) has a chosen position i for which i + p is chosen as well, both with equal contexts;
  the context is a little longer than the largest period it serves, hence the next chosen position of
  equal context is i + p itself. Such neighbours propose their distance as a period.
* Where a whole context lies in a run of period t/4 or less that is known from smaller scales, positions
  are omitted: they could propose small periods only, and those are known.
* A proposed period is compared word with word over its text, which gives all its runs exactly.

Everything happens inside a text, so nothing is shuffled. A text takes O(n log n), and O(n) for each
of its proposed periods, of which there are O(sqrt n) at most.

Defined cases: a null or empty text has no runs and an empty ``collapsed``; null ids and repeated rows
are rows like others; an empty table gives an empty result; extra columns pass through, and the result
columns ``runs`` and ``collapsed`` replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulseframe.llm import wordhash
from pulseframe.llm.batches import bound_batches

MIN_LENGTH = 24
EXPONENT = 3
#: periods that are compared outright; a power of two, 8 at least
DIRECT = 16


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the runs of True of ``least`` or more."""
    edge = np.flatnonzero(same[1:] != same[:-1]) + 1
    edge = np.concatenate([[0] if len(same) and same[0] else [], edge, [len(same)] if len(same) and same[-1] else []]).astype(np.int64)
    first, end = edge[::2], edge[1::2]
    long = end - first >= least
    return first[long], end[long]


def _with_period(ids: np.ndarray, period: int, cross: np.ndarray, min_length: int, exponent: int) -> np.ndarray:
    """Rows (start, end, period) of the stretches that have this period; ``cross`` are positions whose
    partner is in another text."""
    if len(ids) <= period:
        return np.empty((0, 3), np.int64)
    same = ids[period:] == ids[:-period]
    same[cross] = False
    first, end = _stretches(same, max(min_length, exponent * period) - period)
    return np.column_stack([first, end + period, np.full(len(first), period)])


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Each stretch once, with its smallest period, in order of start and period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _direct(ids: np.ndarray, offset: np.ndarray, min_length: int, exponent: int) -> np.ndarray:
    found = []
    for period in range(1, DIRECT + 1):
        cross = (offset[1:-1, None] - np.arange(1, period + 1)).reshape(-1)
        cross = cross[(cross >= 0) & (cross < len(ids) - period)]
        found.append(_with_period(ids, period, cross, min_length, exponent))
    return _smallest(np.concatenate(found))


def synchronising(ids: np.ndarray, reach: int) -> np.ndarray:
    """Positions whose window hash is the least of the ``reach`` (a power of two) next ones, or the last of
    which is; windows have ``reach`` words."""
    hashes = wordhash.run_hashes(ids, reach)
    n = len(hashes) - reach
    if n <= 0:
        return np.empty(0, np.int64)
    least, width = hashes, 1
    while width < reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[1 : n + 1])  # of reach + 1 hashes
    return np.flatnonzero((hashes[:n] == least) | (hashes[reach:] == least))


def _proposed(ids: np.ndarray, offset: np.ndarray, scale: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, period) pairs that equal contexts at this scale propose."""
    at = synchronising(ids, scale // 2)
    text = np.searchsorted(offset, at, "right") - 1
    covering = known[known[:, 2] <= scale // 4]
    reach = np.maximum.accumulate(covering[:, 1])
    texts, periods = [], []
    # periods up to 3 and 4 scales; contexts exceed them by the largest period that omits positions
    for low, high in ((2 * scale, 3 * scale), (3 * scale, 4 * scale)):
        width = high + scale // 4
        use = at + width <= offset[text + 1]
        if len(covering):
            last = np.searchsorted(covering[:, 0], at, "right") - 1
            use &= (last < 0) | (reach[last] < at + width)
        position, owner = at[use], text[use]
        if len(position) < 2:
            continue
        context = wordhash.run_hashes(ids, width)[position]
        order = np.argsort(context, kind="stable")
        apart = position[order[1:]] - position[order[:-1]]
        equal = (context[order[1:]] == context[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        hit = np.flatnonzero(equal & (apart > low) & (apart <= high))
        texts.append(owner[order[hit]])
        periods.append(apart[hit])
    if not texts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.unique(np.column_stack([np.concatenate(texts), np.concatenate(periods)]), axis=0)
    return pairs[:, 0], pairs[:, 1]


def runs_of(ids: np.ndarray, offset: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> np.ndarray:
    """Rows (start, end, period), by start and period, of all runs in texts of words.

    ``ids`` are word hashes of all texts in a row; text k has those from ``offset[k]`` to ``offset[k + 1]``.
    """
    if exponent < 3:
        raise ValueError("equal contexts are guaranteed from three periods on")
    known = _direct(ids, offset, min_length, exponent)
    scale = DIRECT // 2
    none = np.empty(0, np.int64)
    while True:
        large = np.flatnonzero(np.diff(offset) > exponent * 2 * scale)
        if not len(large):
            return known
        # only texts that can hold a run of this scale, moved together
        begin, size = offset[large], np.diff(offset)[large]
        moved = np.concatenate([[0], np.cumsum(size)])
        part = ids[wordhash.ranges(begin, size)]
        shift = begin - moved[:-1]
        inside = np.searchsorted(large, np.searchsorted(offset, known[:, 0], "right") - 1)
        inside = np.minimum(inside, len(large) - 1)
        of_large = (known[:, 0] >= begin[inside]) & (known[:, 0] < begin[inside] + size[inside])
        local = known[of_large] - np.column_stack([shift[inside[of_large]]] * 2 + [np.zeros(of_large.sum(), np.int64)])
        found = [known]
        for text, period in zip(*_proposed(part, moved, scale, local)):
            rows = _with_period(part[moved[text] : moved[text + 1]], int(period), none, min_length, exponent)
            rows[:, :2] += begin[text]
            found.append(rows)
        known = _smallest(np.concatenate(found))
        scale *= 2


def _collapsed(words: wordhash.Words, runs: np.ndarray) -> pa.Array:
    """The texts without the words that repeat a run's first period, the rest joined by one space."""
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 1], -1)
    kept = np.cumsum(step[:-1]) == 0
    first = np.zeros(len(words), bool)  # of the kept words of its text
    n_before = np.concatenate([[0], np.cumsum(kept)])
    begins = words.offset[:-1][np.diff(words.offset) > 0]
    first[begins] = kept[begins]  # a run never drops its first period, so a text keeps its first word
    space = words.start - 1
    size = words.stop - words.start
    stay = np.flatnonzero(kept)
    lead = (~first[stay]).astype(np.int64)
    source = np.concatenate([words.data, np.array([32], np.uint8)])
    take = wordhash.ranges(space[stay] + 1 - lead, size[stay] + lead)
    blank = np.cumsum(size[stay] + lead) - (size[stay] + lead)
    take[blank[lead == 1]] = len(words.data)
    length = np.concatenate([[0], np.cumsum(size[stay] + lead)])
    ends = length[n_before[words.offset]].astype(np.int64)
    body = source[take]
    return pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(body)]).cast(pa.string())


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _finding(text: int, min_length: int, exponent: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in wordhash.word_slices(wordhash.strings(batch.column(text))):
                part = batch.slice(low, high - low)
                runs = runs_of(words.lanes[0], words.offset, min_length, exponent)
                owner = np.searchsorted(words.offset, runs[:, 0], "right") - 1
                ends = np.searchsorted(owner, np.arange(high - low + 1)).astype(np.int32)
                fields = [runs[:, 0] - words.offset[owner], runs[:, 1] - runs[:, 0], runs[:, 2]]
                flat = pa.StructArray.from_arrays([pa.array(f) for f in fields], fields=list(_RUN))
                columns = [*part.columns, pa.ListArray.from_arrays(pa.array(ends), flat), _collapsed(words, runs)]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "runs", "collapsed"])

    return of_batches


def find_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """``docs`` with ``runs`` (word number of the start, length and smallest period in words, by start and
    period) and ``collapsed``: the words without those that any run contains after its first period, joined
    by one space. Words are compared by 64-bit hashes."""
    bound_batches(docs.sparkSession)
    kept = docs.drop("runs", "collapsed")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), _FOUND])
    return kept.mapInArrow(_finding(kept.columns.index(text), min_length, exponent), schema)
