import random

import numpy as np
import pytest

from pulseframe.llm import lines, queries
from tests.llm.texts import frame, passages, sha, table

SPACE = " \t\n\x0b\x0c\r"


def plain(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(SPACE).translate(low)
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 10:
                holders.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        kept = [x for x in ls if i is None or len(key(x)) < 10 or i == min(holders[key(x)])]
        out.append((i, len(ls), len(ls) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(2)
    pool = ["A common line of text", "a common LINE of text ", "éééééééééé", "ÉÉÉÉÉÉÉÉÉÉ", "short", "", "\t the other line \r", "123456789", "1234567890", "x" * 5000]
    rows = [(rng.choice([i, i, None, i // 2]), "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 6)))) for i in range(150)]
    return rows + [(1000, None), (1001, ""), (1002, "\n\n")] + passages(3, 50)


def test_query(spark, tmp_path):
    rows = fixture()
    got = queries.op8_line_dedup(spark, table(spark, tmp_path, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_a_frequent_line_is_dealt_over_parts(spark, tmp_path, monkeypatch):
    """One line is in every document: no part of its shard gets many of its ids, and the result is the same."""
    monkeypatch.setattr(lines, "PART_IDS", 300)
    monkeypatch.setattr(lines, "MANY_IDS", 5)
    rows = [(i, f"this line is in all documents\nand this in pairs {i // 2}\nonly here {i}") for i in range(3000)]
    got = queries.op8_line_dedup(spark, table(spark, tmp_path, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)

    schema = "h1 long, h2 long, first long, last long, n long, docs binary"
    probes = spark.createDataFrame([(7, 8, 100 * k, 100 * k + 99, 100, b"") for k in range(60)] + [(7 + 96, k, k, k, 1, b"") for k in range(50)], schema)
    held = {(r["shard"], r["part"]): r["n"] for r in lines.dealt(probes, 96, 20).groupBy("shard", "part").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert len(held) > 10 and max(held.values()) <= 1100  # of 6000 ids
    index = lines.indexed(spark.createDataFrame([(7, 8, 0, 6000), (103, 1, 1, 2)], "h1 long, h2 long, first long, n long"), 96, 20).collect()
    assert sorted(r["part"] for r in index if r["h1"] == 7) == list(range(20)) and [r["part"] for r in index if r["h1"] == 103] == [0]


def test_columns_pass_through(spark):
    docs = frame(spark, [(1, "a line of ten and more", 5, "s"), (2, "A LINE OF TEN AND MORE\nz", 6, None), (3, None, 7, "t")], "doc_id long, text string, n_lines int, source string")
    got = lines.dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "source", "n_lines", "n_dropped"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == [(1, "a line of ten and more", "s", 1, 0), (2, "z", None, 2, 1), (3, None, "t", 1, 0)]
    assert lines.dedup_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_minimal_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64))
    sizes, bits = lines.build_mph(keys)
    assert sorted(lines.slots(keys, sizes, bits).tolist()) == list(range(len(keys)))
    strangers = np.arange(50, dtype=np.uint64)
    assert all(-1 <= s < len(keys) for s in lines.slots(strangers, sizes, bits).tolist())
    assert len(bits) <= 5 * len(keys) + 64
