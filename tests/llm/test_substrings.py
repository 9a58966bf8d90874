import numpy as np
import pytest

from pulseframe.llm import queries, substrings
from tests.llm.texts import frame, passages, sha, table


def plain(rows, window):
    first, split = {}, [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for j in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[j : j + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for j in range(len(w) - window + 1) if i is not None else ():
            if first[tuple(w[j : j + window])] < i:
                gone.update(range(j, j + window))
        out.append((i, len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [5, 13, 50])
def test_brute_force(spark, window):
    rows = passages(window)
    got = substrings.dedup_substrings(frame(spark, rows), window).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], sha(r["kept_text"])) for r in got), key=str) == plain(rows, window)
    held = {}
    for i, t in rows:
        held.setdefault(i, []).append((t or "").encode().split())
    many = 0
    for r in got:
        many += len(r["factors"]) > len(r["spans"])
        at = {k for f in r["factors"] for k in range(f["start"], f["end"])}
        assert at == {k for s in r["spans"] for k in range(s["start"], s["end"])}
        assert sum(f["end"] - f["start"] for f in r["factors"]) == len(at)  # factors do not overlap
        for f in r["factors"]:  # each is a copy of its reference
            n = f["end"] - f["start"]
            copies = [w[f["ref_start"] : f["ref_start"] + n] for w in held[f["ref_doc"]]]
            assert f["ref_doc"] < r["doc_id"] and any(w[f["start"] : f["end"]] in copies for w in held[r["doc_id"]])
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_query(spark, tmp_path):
    rows = passages(9)
    got = queries.op1_substring_dedup(spark, table(spark, tmp_path, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, 50)


def test_boundaries_of_a_passage(spark):
    """A passage of exactly 50 words in other surroundings goes, one of 49 stays."""
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(1, f"a b {passage} c"), (2, f"x {passage}"), (3, f"{passage} y z"), (4, f"q {passage.rsplit(' ', 1)[0]} r")]
    got = {r["doc_id"]: (r["n_removed"], r["kept_text"]) for r in substrings.dedup_substrings(frame(spark, rows)).collect()}
    assert got[2] == (50, "x") and got[3] == (50, "y z") and got[1][0] == got[4][0] == 0


def test_many_copies_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(70))
    docs = frame(spark, [(i, text, 1, "z") for i in range(300)], "doc_id long, text string, a int, spots string")
    got = substrings.dedup_substrings(docs).collect()
    assert sorted(r["doc_id"] for r in got if not r["n_removed"]) == [0] and {r["n_removed"] for r in got} == {0, 70}
    assert substrings.dedup_substrings(docs.limit(0)).count() == 0


def test_greedy_parse():
    rows = np.array([(0, 60, 1, 5), (10, 100, 2, -10), (90, 150, 3, 0), (100, 160, 4, 0), (300, 350, 5, 1), (300, 360, 6, 1)])
    assert substrings._parsed(rows) == [(0, 60, 1, 5), (60, 100, 2, 50), (100, 160, 4, 100), (300, 360, 6, 301)]
    assert substrings._parsed(rows[:0]) == []
    start, n, ref, ref_start = (np.array(x) for x in ((0, 3, 20, 8), (3, 2, 5, 1), (9, 9, 9, 9), (14, 17, 34, 4)))
    found = substrings._matches(start, n, ref, ref_start, 5)  # the first two touch on one diagonal
    assert found.tolist() == [[0, 9, 9, 14], [8, 13, 9, -4], [20, 29, 9, 14]]


def test_factors_of_copied_passages(spark):
    """Two passages of different documents, adjoining: two factors, each extended to its last common word."""
    a, b = [" ".join(f"{x}{i}" for i in range(120)) for x in "ab"]
    docs = [(1, "x y " + a), (2, b + " z"), (3, "own words " + " ".join(a.split()[20:]) + " " + " ".join(b.split()[:70]) + " end")]
    row = [r for r in substrings.dedup_substrings(frame(spark, docs)).collect() if r["doc_id"] == 3][0]
    assert [tuple(f) for f in row["factors"]] == [(2, 102, 1, 22), (102, 172, 2, 0)]
    assert [tuple(s) for s in row["spans"]] == [(2, 172)] and row["kept_text"] == "own words end"
