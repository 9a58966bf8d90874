import random
import zlib

import numpy as np
import pytest

from pulseframe.llm import periods, queries
from tests.llm.texts import frame, passages, sha, table, words


def plain_runs(w, min_length=24, exponent=3):
    """Every period tried at every place."""
    found = {}
    for q in range(1, len(w) // exponent + 1):
        k = 0
        while k < len(w) - q:
            j = k
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > k and j + q - k >= max(min_length, exponent * q):
                found.setdefault((k, j + q), q)
            k = max(j, k + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def repetitive(rng):
    """Words with many nested, neighbouring and nearly periodic stretches."""
    out = []
    for _ in range(rng.randint(1, 4)):
        p = rng.choice([1, 2, 3, 7, 8, 15, 16, 17, 24, 31, 32, 33, 47, 48, 49, 63, 64, 65, 96, 97, 130])
        base = [rng.randrange(rng.choice([1, 2, 3, 60])) for _ in range(p)]
        if rng.random() < 0.4:  # a period that is itself nearly periodic
            base = (base[: rng.choice([1, 2, 3, 4])] * 200)[: p - 1] + [rng.randrange(5)]
        out += (base * 9)[: rng.choice([2 * p, 3 * p - 1, 3 * p, 3 * p + 1, 4 * p + 2, 7 * p])]
        if rng.random() < 0.6:
            out += [rng.randrange(rng.choice([2, 60])) for _ in range(rng.randint(0, 30))]
    return [f"w{x}" for x in out]


@pytest.mark.parametrize("seed", range(5))
def test_brute_force(seed):
    rng = random.Random(seed)
    hashes = {f"w{i}": h for i, h in enumerate(np.random.default_rng(1).integers(1, 2**63, 100).astype(np.uint64))}
    for _ in range(12):
        texts = [repetitive(rng) if rng.random() < 0.9 else [] for _ in range(rng.randint(1, 6))]
        offset = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        ids = np.array([hashes[x] for t in texts for x in t], np.uint64)
        got = [(s, e - s, q) for s, e, q in periods.runs_of(ids, offset).tolist()]
        assert got == [(s + o, n, q) for t, o in zip(texts, offset.tolist()) for s, n, q in plain_runs(t)]


def test_long_periods_and_fibonacci_words():
    rng = np.random.default_rng(3)
    part = rng.integers(0, 2**62, 3001).astype(np.uint64)
    ids = np.concatenate([part, part, part, part[:17], rng.integers(0, 2**62, 500).astype(np.uint64)])
    assert periods.runs_of(ids, np.array([0, len(ids)])).tolist() == [[0, 9020, 3001]]
    a, b = "a", "ab"
    while len(b) < 1500:
        a, b = b, b + a
    ids = np.array([ord(c) for c in b], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert [(s, e - s, q) for s, e, q in periods.runs_of(ids, np.array([0, len(ids)])).tolist()] == plain_runs(b)


def test_one_of_any_neighbouring_positions_is_chosen():
    ids = np.random.default_rng(4).integers(0, 3, 4000).astype(np.uint64)
    for reach in (4, 8, 32):
        at = periods.synchronising(ids, reach)
        assert (np.diff(at) <= reach).all() and at[0] < reach
        chosen, seen = np.isin(np.arange(len(ids)), at), {}
        for i in range(1000):  # the choice depends on the next words only
            assert seen.setdefault(ids[i : i + 2 * reach].tobytes(), chosen[i]) == chosen[i]


def plain(rows):
    out = []
    for i, t in rows:
        w = words(t)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = plain_runs(w)
        best = None
        for r in runs:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        out.append((i, len(runs), *four, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(plain_collapsed(w, runs))))
    return sorted(out, key=str)


def test_query(spark, tmp_path):
    rng = random.Random(6)
    rows = passages(11, 250) + [(i, " \n".join(repetitive(rng))) for i in range(300, 420)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "é " * 100), (None, "x y " * 40), (503, "é " * 100)]
    got = queries.op11_periodic_runs(spark, table(spark, tmp_path, rows)).collect()
    want = plain(rows)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert sum(r[1] > 0 for r in want) > 60


def test_columns_and_empty_tables(spark):
    docs = frame(spark, [(1, "a b " * 20, 5, 7), (None, None, 6, 8)], "doc_id long, text string, runs int, period int")
    got = periods.find_runs(docs, min_length=10, exponent=4)
    assert got.columns == ["doc_id", "text", "period", "runs", "collapsed"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert [tuple(x) for x in rows[1]["runs"]] == [(0, 40, 2)] and rows[1]["collapsed"] == "a b"
    assert rows[None]["runs"] == [] and rows[None]["collapsed"] == "" and rows[None]["period"] == 8
    assert periods.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.runs_of(np.zeros(3, np.uint64), np.array([0, 3]), exponent=2)


def test_a_very_long_text(spark):
    text = " ".join(f"w{i % 9001}" for i in range(400_000)) + " end"
    row = periods.find_runs(frame(spark, [(1, text)])).first()
    assert [tuple(x) for x in row["runs"]] == [(0, 400_000, 9001)] and len(row["collapsed"].split()) == 9002
