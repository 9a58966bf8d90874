import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseframe.llm import nearest, queries
from tests.llm.texts import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def valid(v):
    return v and all(x is not None and math.isfinite(x) for x in v)


def plain(rows, k):
    whole = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, *_ in rows if i is not None and valid(v)]
    out = []
    for n, (i, q) in enumerate(whole):
        if i % 20:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(whole) if m != n and len(v) == len(q)]
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def vectors(n, dim=8):
    rng = random.Random(n)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(dim)], 1) for i in range(n)]
    rows += [(n + i, [0.5] * dim, 2) for i in range(n // 2)]  # one vector again and again
    rows += [(5000, None, 0), (5020, [], 0), (5040, [1.0, None], 0), (5060, [float("nan")] * dim, 0), (5080, [float("inf")] * dim, 0)]
    return rows + [(None, [1.0] * dim, 0), (6000, [1.0, 2.0, 3.0], 0), (6001, [1.0, 2.0, 4.0], 0), (6020, [1.0] * 5, 0)]


@pytest.mark.parametrize("n", [10, 300])
def test_query(spark, tmp_path, monkeypatch, n):
    for name, value in (("BLOCK", 40), ("GROUP", 2), ("QUERIES", 4)):
        monkeypatch.setattr(nearest, name, value)
    rows = vectors(n)
    got = queries.op6_top_k(spark, table(spark, tmp_path, rows, SCHEMA, "embeddings"))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 20)


def test_large_components_are_exact(spark):
    rows = [(0, [2.0**40, 1.0], 0), (1, [2.0**40, 3.0], 0), (2, [2.0**40, 2.0], 0), (3, [3e38, 1.0], 0)]
    got = nearest.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, 5).orderBy("rank").collect()
    assert [r["vec_id"] for r in got][-2:] == [2, 1] or [r["vec_id"] for r in got] == [1, 2, 3]
    assert all(-(2**63) <= r["score"] < 2**63 for r in got)


def test_pruning_reads_few_vectors():
    rng = np.random.default_rng(3)
    exact = np.floor(64 * rng.normal(0, 0.2, (2000, 16)))
    import pyarrow as pa

    table_ = pa.table({"vec_id": np.arange(2000), "row": np.arange(2000), "vector": pa.array((exact / 64).tolist())})
    key = (pa.scalar(16, pa.int32()), pa.scalar(0, pa.int64()))
    block = nearest._Block(nearest.build_block(key, table_).to_pylist()[0], 16)
    assert (np.abs(block.centre - exact) <= block.half).all()
    query = exact[5]
    none = (np.empty(0, np.int64), np.empty(0, np.int64))
    read = []
    real = nearest._dot
    try:
        nearest._dot = lambda v, q: read.append(len(v)) or real(v, q)
        scores, ids = nearest._visit(block, query, block.centre @ query, np.abs(query) @ block.half, block.rows == 5, none, 20)
    finally:
        nearest._dot = real
    want = sorted((-int(s), i) for i, s in enumerate((exact @ query).astype(int)) if i != 5)[:20]
    assert [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())] == want and sum(read) < 600


def test_empty(spark):
    assert nearest.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") >= 0).count() == 0


def test_copies_of_the_index():
    """One per query block; their number stays the same over a wide range of tables."""
    assert [nearest.query_blocks(n) for n in (0, 1, 256, 257, 8192)] == [1, 1, 1, 2, 32]
    assert all(31 <= nearest.query_blocks(n) <= 32 for n in (10_000, 100_000, 500_000))
    assert nearest.query_blocks(5_000_000) <= 306


def test_bounds_in_parts(spark, tmp_path, monkeypatch):
    rows = vectors(200)
    wanted = plain(rows, 20)
    got = queries.op6_top_k(spark, table(spark, tmp_path, rows, SCHEMA, "embeddings")).collect()
    assert sorted(tuple(r) for r in got) == wanted
    index = nearest.build_block((nearest.pa.scalar(8), nearest.pa.scalar(0)), nearest.pa.table({"vec_id": list(range(50)), "row": list(range(50)), "vector": nearest.pa.array([[float(i + j) / 7 for j in range(8)] for i in range(50)])}))
    search = nearest._search(5)
    whole = search((nearest.pa.scalar(8),), index, index)
    monkeypatch.setattr(nearest, "_BOUNDS", 7)
    assert search((nearest.pa.scalar(8),), index, index).equals(whole)
