import random

import numpy as np
import pyarrow as pa

from pulseframe.llm import wordhash


def test_words_and_hashes():
    rng = random.Random(1)
    texts = ["", "a b", None, " x  y\n", "b a b a", "é a b", "a"] + ["".join(rng.choice("ab \n\té") for _ in range(rng.randint(0, 60))) for _ in range(800)]
    column = wordhash.strings(pa.array(texts)).slice(1)
    seen, back = {}, {}
    for low, high, words in wordhash.word_slices(column, lanes=2):
        for text in range(low, high):
            a, b = words.offset[text - low], words.offset[text - low + 1]
            mine = [bytes(words.data[s:e]) for s, e in zip(words.start[a:b], words.stop[a:b])]
            assert mine == column[text].as_py().encode().split()
            for word, x, y in zip(mine, words.lanes[0][a:b].tolist(), words.lanes[1][a:b].tolist()):
                assert seen.setdefault(word, (x, y)) == (x, y) and back.setdefault((x, y), word) == word


def test_run_hashes_tell_runs_apart():
    values = np.random.default_rng(1).integers(0, 3, 3000).astype(np.uint64)
    got = wordhash.run_hashes(values, 7)
    seen = {}
    for i, h in enumerate(got.tolist()):
        assert seen.setdefault(tuple(values[i : i + 7].tolist()), h) == h
    assert len(set(seen.values())) == len(seen)
    assert len(wordhash.run_hashes(values[:3], 7)) == 0


def test_fold_only_touches_ascii():
    hashes = lambda t: [w.lanes[0].tolist() for _, _, w in wordhash.word_slices(pa.array([t]), fold=True)]
    assert hashes("AbC É") == hashes("abc É") != hashes("abc é")


def test_slices_cover_all_texts(monkeypatch):
    ends = np.array([0, 0, 5, 5, 100, 101, 300])
    assert list(wordhash.slices(ends, 50)) == [(0, 3), (3, 4), (4, 5), (5, 6)]
    assert list(wordhash.slices(np.zeros(1, np.int64), 50)) == []


def test_packed_round_trip():
    kind = np.dtype([("a", "<i8"), ("b", "u1")])
    rows = np.array([(1, 2), (3, 4), (5, 6)], kind)
    column = wordhash.packed(rows, np.array([0, 2, 2, 3]))
    back, at = wordhash.unpacked(column.slice(1), kind)
    assert back.tolist() == [(5, 6)] and at.tolist() == [1]
