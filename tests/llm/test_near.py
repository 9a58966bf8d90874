import collections
import random

import numpy as np
import pytest

from pulseframe.llm import components, near, queries
from tests.llm.texts import frame, table


def plain(rows, shingle, similarity):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(low).split()
        sets[i] = frozenset(tuple(w[j : j + shingle]) for j in range(max(1, len(w) - shingle + 1))) if w else frozenset()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i)) for i in sets)


def fixture(seed):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3) for _ in range(rng.choice([1, 2, 3, 5, 60, 200]))] for _ in range(15)]
    rows = []
    for i in range(250):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(w) // 25))):
            w[rng.randrange(len(w))] = rng.choice("XYZ")
        rows.append((i, " ".join(w) if rng.random() < 0.95 else rng.choice([None, "", " \n"])))
    return rows


@pytest.mark.parametrize(("shingle", "similarity"), [(3, 85), (5, 80), (1, 50)])
def test_brute_force(spark, shingle, similarity):
    rows = fixture(shingle)
    got = near.near_duplicates(frame(spark, rows), shingle, similarity).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == plain(rows, shingle, similarity)


def test_query(spark, tmp_path):
    rows = fixture(7)
    got = queries.op5_near_dedup(spark, table(spark, tmp_path, rows)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == plain(rows, 3, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_a_large_group_of_near_copies(spark):
    """Copies with few and with many edits of a text that is not there itself."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.randint(1, 8)):
            w[rng.randrange(100)] = f"x{rng.random()}"
        rows.append((i, " ".join(w)))
    got = near.near_duplicates(frame(spark, rows), 3, 85).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == plain(rows, 3, 85)


def test_edges(spark):
    docs = frame(spark, [(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "A B C"), (3, None)], "doc_id long, text string")
    got = collections.Counter((r["doc_id"], r["component_id"]) for r in near.near_duplicates(docs).collect())
    assert got == {(1, 1): 2, (2, 1): 1, (3, 3): 1}
    assert near.near_duplicates(docs.limit(0)).count() == 0


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 2**63, 1).astype(np.uint64)
    big = rng.integers(0, 2**63, 2000).astype(np.uint64)
    other = np.concatenate([big[:1700], rng.integers(0, 2**63, 300).astype(np.uint64)])
    hashes = np.concatenate([one, big, other])
    out = near.sketch(hashes, np.array([0, 1, 2001, 4001]), 400)
    assert (out != near._EMPTY).all()
    share = (out[1] == out[2]).mean()
    assert abs(share - 1700 / 2300) < 0.1


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 180)] + [(7, 7), (300, 301), (301, 300)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 180), 100), 300: 300, 301: 300}
