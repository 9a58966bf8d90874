"""Exact top-k search by inner product with vector-approximation files.

The vectors are cut into blocks. A block keeps, beside its exact vectors, a quantised cell per vector: in
every dimension the number of the slice its component falls in. For a query the cells give an upper
and a lower bound of each score. The k-th largest lower bound rules out most vectors by their upper
bounds; the rest are read exactly in the order of their upper bounds until the k-th best score found is
above the next bound. The blocks of one group are scanned one after the other, so what one block has
found prunes the next.

Queries are blocked as well, and a pair of a query block and a group of vector blocks is one task. A task
returns k rows per query; the groups' results are merged per query. The index is sent once per query block:
query blocks grow with the queries, so there are about QUERY_BLOCKS of them until they have MOST_QUERIES each.

Components are turned into integers first, floor(scale * x), so scores are exact.

Defined cases: vectors that are null or hold null or non-finite components, and rows without id, take no
part, neither as query nor as candidate; a row is never its own candidate, but another row with its id
is; vectors of different length are not compared; equal scores go to the smaller id; a query without
candidates has no rows; a score beyond the range of a long is cut to it; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pulseframe.llm.batches import bound_batches
from pulseframe.session import materialize, scratch_path

TOP = 20
SCALE = 64
#: slices per dimension
CELLS = 32
#: vectors in a block, blocks in a group, about
BLOCK, GROUP = 4096, 64
#: queries in a block: so many at least, and at most; between, as many as make so many blocks
QUERIES, MOST_QUERIES, QUERY_BLOCKS = 256, 16_384, 32
#: queries whose bounds against one block are held at a time
_BOUNDS = 256
#: exact vectors that are read at a time
_READ = 64
_EXACT = float(2**53)

_INDEX = "dim int, block long, ids binary, rows binary, low binary, width binary, cells binary, exact binary"


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    """The integer components of the vectors, as doubles."""
    flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat.astype(np.float64)).reshape(-1, dim)


def build_block(key: tuple, table: pa.Table) -> pa.Table:
    """Cells and exact vectors of one block."""
    dim, block = (k.as_py() for k in key)
    exact = _matrix(table, dim)
    low = exact.min(axis=0)
    width = np.floor((exact.max(axis=0) - low) / CELLS) + 1
    cells = np.minimum(np.floor((exact - low) / width), CELLS - 1).astype(np.uint8)
    small = bool((np.abs(exact) < 2**15).all())
    columns = {
        "dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int64()),
        "ids": [table["vec_id"].to_numpy().tobytes()], "rows": [table["row"].to_numpy().tobytes()],
        "low": [low.tobytes()], "width": [width.tobytes()], "cells": [cells.tobytes()],
        "exact": [exact.astype("<i2" if small else "<f8").tobytes()],
    }
    return pa.table({c: v if isinstance(v, pa.Array) else pa.array(v, pa.binary()) for c, v in columns.items()})


class _Block:
    def __init__(self, row: dict, dim: int):
        self.ids, self.rows = (np.frombuffer(row[c], np.int64) for c in ("ids", "rows"))
        small = len(row["exact"]) == 2 * dim * len(self.ids)
        self.exact = np.frombuffer(row["exact"], "<i2" if small else "<f8").reshape(-1, dim)
        low, width = (np.frombuffer(row[c], np.float64) for c in ("low", "width"))
        self.half = (width - 1) / 2
        self.centre = low + np.frombuffer(row["cells"], np.uint8).reshape(-1, dim) * width + self.half


def _dot(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer scores."""
    vectors = vectors.astype(np.float64)
    if not len(vectors) or len(query) * np.abs(vectors).max() * np.abs(query).max() < _EXACT:
        return (vectors @ query).astype(np.int64)
    own = [int(x) for x in query]
    full = [sum(int(a) * b for a, b in zip(v, own)) for v in vectors]
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in full], np.int64)


_FOUND = "query long, query_id long, vec_id long, score long"


def _search(k: int):
    def of_group(key: tuple, queries: pa.Table, index: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        best: list[tuple[np.ndarray, np.ndarray]] = []
        asked = []
        if len(index):
            for row in queries.to_pylist():
                asked.append(_Block(row, dim))
        for block in asked:
            best += [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in block.ids]
        for row in index.sort_by("block").to_pylist():
            block, at = _Block(row, dim), 0
            for some in asked:
                for low in range(0, len(some.ids), _BOUNDS):
                    wanted = some.exact[low : low + _BOUNDS].astype(np.float64)
                    middle = wanted @ block.centre.T
                    # rounding of large sums must not tighten a bound
                    slack = np.abs(wanted) @ block.half + np.abs(wanted) @ np.abs(block.centre).max(axis=0) * 1e-13
                    for i in range(len(wanted)):
                        own = block.rows == some.rows[low + i]
                        best[at] = _visit(block, wanted[i], middle[i], slack[i], own, best[at], k)
                        at += 1
        out = [[], [], [], []]
        at = 0
        for some in asked:
            for row_id, vec_id in zip(some.rows.tolist(), some.ids.tolist()):
                scores, ids = best[at]
                at += 1
                for column, values in zip(out, ([row_id] * len(ids), [vec_id] * len(ids), ids.tolist(), scores.tolist())):
                    column += values
        return pa.table([pa.array(c, pa.int64()) for c in out], ["query", "query_id", "vec_id", "score"])

    return of_group


def _visit(block: _Block, query: np.ndarray, middle: np.ndarray, slack: float, own: np.ndarray, best, k: int):
    """The k best so far, after the vectors of a block: (scores, ids), best first."""
    scores, ids = best
    upper = np.where(own, -np.inf, middle + slack)
    floor = float(scores[k - 1]) if len(scores) >= k else -np.inf
    if len(upper) - own.sum() >= k:
        lower = np.where(own, -np.inf, middle - slack)
        floor = max(floor, float(np.partition(lower, -k)[-k]))
    rest = np.flatnonzero(upper >= floor)
    rest = rest[upper[rest] > -np.inf]
    rest = rest[np.argsort(-upper[rest], kind="stable")]
    for low in range(0, len(rest), _READ):
        some = rest[low : low + _READ]
        if len(scores) >= k and upper[some[0]] < scores[k - 1]:
            break
        scores = np.concatenate([scores, _dot(block.exact[some], query)])
        ids = np.concatenate([ids, block.ids[some]])
        order = np.lexsort((ids, -scores))[:k]
        scores, ids = scores[order], ids[order]
    return scores, ids


def query_blocks(n_queries: int) -> int:
    """How many blocks the queries are dealt to: the index is copied once for each."""
    size = min(max(QUERIES, math.ceil(n_queries / QUERY_BLOCKS)), MOST_QUERIES)
    return max(1, math.ceil(n_queries / size))


def top_k(
    vectors: DataFrame, queries: Column, k: int = TOP, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """The ``k`` best other rows for each row that fulfils ``queries`` (a condition on ``vec_id``):
    ``query_id``, ``rank`` from 1, ``vec_id``, ``score``."""
    spark = vectors.sparkSession
    bound_batches(spark)
    own = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = own.where(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite)
    own = own.select("vec_id", "vector", F.size("vector").alias("dim"), F.monotonically_increasing_id().alias("row"))
    own = materialize(own, scratch_path(spark, "vectors"))

    asked = own.where(queries)
    n_blocks = max(1, math.ceil(own.count() / BLOCK))
    n_asked = query_blocks(asked.count())
    n_groups = math.ceil(n_blocks / GROUP)

    def blocks(rows: DataFrame, n: int) -> DataFrame:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n)))
        return dealt.groupBy("dim", "block").applyInArrow(build_block, _INDEX)

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = blocks(own, n_blocks).withColumn("group", F.pmod("block", F.lit(n_groups)).cast("int")).withColumn("asked", every(n_asked))
    questions = blocks(asked, n_asked).withColumn("asked", F.col("block").cast("int")).withColumn("group", every(n_groups))
    task = ["dim", "asked", "group"]
    found = questions.groupBy(*task).cogroup(index.groupBy(*task)).applyInArrow(_search(k), _FOUND)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
