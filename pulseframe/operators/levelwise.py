"""MLlib's boosted trees of full depth for a label of 0 and 1, grown over blocks of bytes.

``GBTClassifier`` walks its rows as objects, once per level of every tree, and zips three tables for it. Here rows
are binned once and kept as blocks of arrays; a task routes a block through the tree so far and counts it with a few
array operations per feature. One job gives the histograms (rows and sum of residuals per feature and bin) of all
nodes of a level, so a tree costs as many jobs as it has levels; the driver holds histograms only.

The algorithm is MLlib's: the first tree is fitted to -1 and 1, each later one to the residuals of the log loss,
by the reduction of variance; every node draws its features, every round its rows. What is drawn differs from
MLlib's; with nothing to draw the trees are the same. Splits come from the quantiles of all rows, not of a sample, and
from every value of a feature that has few. Residuals are summed as whole numbers of 2^-28, so that a
retried task cannot change a tree.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from pulseframe.operators import boosting
from pulseframe.session import materialize, scratch_path, ship_package

_SCALE = 1 << 28
#: rows of a block at most
_BLOCK = 1 << 16
#: rows of a partition of blocks, where there are more than the cores share
_ROWS = 4_000_000
#: rounds between two written tables of margins
KEEP_EVERY = 10
_BLOCKS = "number long, bins binary, y binary, margin binary, residual binary, used binary"


class LevelwiseClassifier(GBTClassifier):
    """``GBTClassifier`` for the log loss, with the same parameters and the same kind of model."""

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        spark, strategy = dataset.sparkSession, self.getFeatureSubsetStrategy()
        ship_package(spark)
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        size, n = _checked(rows)
        names = [f"x{i}" for i in range(size)]
        edges = _edges(rows, names, min(self.getMaxBins(), max(n, 2)))
        width = max(len(e) for e in edges) + 1
        share, seed, depth = self.getSubsamplingRate(), self.getSeed(), self.getMaxDepth()
        n_drawn = size if strategy == "all" else math.ceil(float(strategy) * size)
        parallel = spark.sparkContext.defaultParallelism
        parts = parallel * math.ceil(n / (parallel * _ROWS)) if n > parallel * boosting._ROWS else math.ceil(n / boosting._ROWS)
        blocks = materialize(_packed(rows, edges, width, (share, seed, 0)).repartition(parts), scratch_path(spark, "level_rows"))
        current, held = blocks.repartition(parts).persist(), []
        held.append(current)
        trees, weights = [], []
        try:
            while True:
                done = len(trees)
                root, last = _grow(current, size, width, depth, self.getMinInstancesPerNode(), n_drawn, f"{seed}:{done}", parts)
                trees.append(_as_dict(root, edges))
                weights.append(self.getStepSize() if done else 1.0)
                if done + 1 == self.getMaxIter():
                    break
                advanced = _advanced(current, root, last, weights[-1], width, (share, seed, done + 1))
                if (done + 1) % KEEP_EVERY == 0:  # cut the lineage
                    advanced = materialize(advanced, scratch_path(spark, "level_margins")).repartition(parts)
                current = advanced.persist()
                held.append(current)
                while len(held) > 2:  # the one before is read until the newest is filled
                    held.pop(0).unpersist()
        finally:
            for frame in held:
                frame.unpersist()
        model = self._copyValues(boosting.mllib_model(self.uid, trees, weights, size))
        model._transfer_params_to_java()
        return model


def _checked(rows: DataFrame) -> tuple[int, int]:
    """Number of features and of rows; like MLlib's fit, no row without a label of 0 or 1 or with a missing or infinite value."""
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf))
    right = F.coalesce(F.col("y").isin(0.0, 1.0) & finite, F.lit(False))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(~right).alias("wrong"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if not seen["n"]:
        raise ValueError("no labelled rows to train on")
    if seen["wrong"] or seen["least"] != seen["most"]:
        raise ValueError(f"{seen['wrong']} rows have a label other than 0 and 1, or a missing or infinite value")
    return seen["most"], seen["n"]


def _edges(rows: DataFrame, names: list[str], max_bins: int) -> list[list[float]]:
    """Per feature the values at which a new bin begins: between any two values if there are ``max_bins`` at most, else quantiles."""
    size = len(names)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.empty(0)] * size
        for batch in batches:
            x = _matrix(batch, size)
            for i in range(size):
                if len(found[i]) <= max_bins:  # one more tells that there are too many
                    found[i] = np.union1d(found[i], x[:, i])[: max_bins + 1]
        feature = np.repeat(np.arange(size, dtype=np.int32), [len(v) for v in found])
        yield pa.RecordBatch.from_arrays([pa.array(feature), pa.array(np.concatenate(found))], ["feature", "value"])

    some = rows.select("x").mapInArrow(of_batches, "feature int, value double").distinct()
    few = some.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.when(F.count(F.lit(1)) <= max_bins, F.sort_array(F.collect_list("value"))).alias("all"))
    values = {r["feature"]: r["all"] for r in few.collect()}
    many = [i for i in range(size) if values[i] is None]
    columns = rows.select(*[F.col("x")[i].alias(names[i]) for i in many])
    quantiles = dict(zip(many, boosting.quantile_edges(columns, [names[i] for i in many], max_bins))) if many else {}
    between = lambda v: [a + (b - a) / 2 if a + (b - a) / 2 > a else b for a, b in zip(v, v[1:])]
    return [quantiles[i] if i in quantiles else between(values[i]) for i in range(size)]


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _drawn(number: int, n: int, bag: tuple[float, int, int]) -> np.ndarray:
    """Which rows of a block are in a bag (share, seed, round): each by itself, copies too."""
    x = np.uint64(number * _BLOCK) + np.arange(n, dtype=np.uint64)
    x *= np.uint64(0x9E3779B97F4A7C15)
    return boosting._in_bag((x ^ (x >> np.uint64(32))).view(np.int64), bag)


def _block(number: int, bins: np.ndarray, y: np.ndarray, margin: np.ndarray, first: bool, bag: tuple) -> pa.RecordBatch:
    sign = 2.0 * y - 1.0
    residual = sign if first else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))
    arrays = [bins, y, margin, np.rint(residual * _SCALE).astype(np.int32), _drawn(number, len(y), bag)]
    columns = [pa.array([number], pa.int64()), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _BLOCKS.split(", ")])


def _packed(rows: DataFrame, edges: list[list[float]], width: int, bag: tuple) -> DataFrame:
    """Rows (x, y) as blocks, binned."""
    size, cuts, kind = len(edges), [np.array(e) for e in edges], boosting._bin_type(width)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        bins, y, n = [], [], 0

        def block() -> pa.RecordBatch:
            labels = np.concatenate(y)
            return _block(number, np.concatenate(bins, axis=1), labels, np.zeros(len(labels)), True, bag)

        for batch in batches:
            for begin in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(begin, _BLOCK)
                if n and n + part.num_rows > _BLOCK:
                    yield block()
                    bins, y, n, number = [], [], 0, number + 1
                x = _matrix(part, size)
                bins.append(np.stack([np.searchsorted(c, x[:, i], "right") for i, c in enumerate(cuts)]).astype(kind))
                y.append(part.column("y").to_numpy().astype(np.uint8))
                n += part.num_rows
        if n:
            yield block()

    return rows.mapInArrow(of_batches, _BLOCKS)


def _reached(route: list, bins: np.ndarray, last: int) -> np.ndarray:
    """The number of the node each row ends at. ``route`` has (node, feature, bin, left) for every inner node, parents
    first; its right child is numbered after the left one. ``last`` is the greatest number."""
    kind = np.min_scalar_type(last).type
    at = np.zeros(bins.shape[1], kind)
    for node, feature, bin_, left in route:
        here = at == node
        at += here.astype(kind) * kind(left - node) + (here & (bins[feature] > bin_)).astype(kind)
    return at


def _histograms(blocks: DataFrame, route: list, open_: list[int], last: int, size: int, width: int, parts: int) -> np.ndarray:
    """Rows and residuals in the bag per open node, feature and bin."""
    cells, kind = len(open_) * width, boosting._bin_type(width)
    places = np.full(last + 1, cells)  # rows elsewhere are counted after the last cell
    places[open_] = np.arange(len(open_)) * width

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros((2, size, cells), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                residual, used = boosting._column(batch, "residual", i, np.int32), boosting._column(batch, "used", i, bool)
                bins = boosting._column(batch, "bins", i, kind).reshape(size, -1)
                place = np.where(used, places[_reached(route, bins, last)], cells)
                weight = residual.astype(np.float64)
                for f in range(size):
                    cell = place + bins[f]
                    n[f] += np.bincount(cell, minlength=cells)[:cells]
                    # sums of integers below 2^53 are exact in doubles, and a block has no more
                    s[f] += np.bincount(cell, weight, cells)[:cells].astype(np.int64)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n.ravel()[some]), pa.array(s.ravel()[some])], ["cell", "n", "s"])

    sums = blocks.select("bins", "residual", "used").mapInArrow(of_batches, "cell long, n long, s long")
    if parts > boosting._FEW:  # the driver adds up the sums of a few tasks itself
        sums = sums.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    table = sums.toArrow()
    found = np.zeros((size * cells, 2), np.int64)
    np.add.at(found, table["cell"].to_numpy(), np.column_stack([table["n"].to_numpy(), table["s"].to_numpy()]))
    return (found.reshape(size, len(open_), width, 2) / (1, _SCALE)).transpose(1, 0, 2, 3)


def _best(histogram: np.ndarray, drawn: list[int], least_rows: int) -> tuple[float, int, int, np.ndarray, np.ndarray] | None:
    """(gain, feature, bin, totals left and right) of the split with the greatest reduction of variance, the first of equal ones."""
    left = np.cumsum(histogram[drawn], axis=1)[:, :-1]
    total = histogram[0].sum(axis=0)
    right = total - left
    enough = (left[..., 0] >= max(least_rows, 1)) & (right[..., 0] >= max(least_rows, 1))
    if not enough.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0] - total[1] ** 2 / total[0]) / total[0]
    gain = np.where(enough, gain, -np.inf)
    place, bin_ = divmod(int(gain.argmax()), gain.shape[1])
    if gain[place, bin_] <= 1e-14:
        return None
    return float(gain[place, bin_]), drawn[place], bin_, left[place, bin_], right[place, bin_]


def _grow(blocks: DataFrame, size: int, width: int, depth: int, least_rows: int, n_drawn: int, seed: str, parts: int) -> tuple[dict, int]:
    """The tree of the rows in the blocks' bag, as nested nodes (number, total, and of inner ones feature, bin, gain, left, right),
    and its greatest number."""
    root = {"number": 0, "total": np.zeros(2)}
    level, last = [root], 0
    for height in range(max(depth, 1)):
        found = _histograms(blocks, _route(root), [n["number"] for n in level], last, size, width, parts)
        below = []
        for node, histogram in zip(level, found):
            if node is root:
                root["total"] = histogram[0].sum(axis=0)
            drawn = sorted(random.Random(f"{seed}:{node['number']}").sample(range(size), n_drawn))
            if height == depth or (best := _best(histogram, drawn, least_rows)) is None:
                continue
            node["gain"], node["feature"], node["bin"], *parted = best
            node["left"], node["right"] = ({"number": last + 1 + i, "total": t} for i, t in enumerate(parted))
            last += 2
            below += [n for n in (node["left"], node["right"]) if n["total"][0] >= 2 * max(least_rows, 1)]
        level = below
        if not level:
            break
    return root, last


def _nodes(root: dict) -> list[dict]:
    """All nodes of a tree, parents first."""
    return [root, *_nodes(root["left"]), *_nodes(root["right"])] if "left" in root else [root]


def _route(root: dict) -> list:
    return [(n["number"], n["feature"], n["bin"], n["left"]["number"]) for n in _nodes(root) if "left" in n]


def _value(node: dict) -> float:
    return float(node["total"][1] / node["total"][0]) if node["total"][0] else 0.0


def _as_dict(node: dict, edges: list[list[float]]) -> dict:
    own = {"value": _value(node), "n": int(node["total"][0])}
    if "left" not in node:
        return own
    left, right = _as_dict(node["left"], edges), _as_dict(node["right"], edges)
    return {**own, "feature": node["feature"], "below": edges[node["feature"]][node["bin"]], "gain": node["gain"], "left": left, "right": right}


def _advanced(blocks: DataFrame, root: dict, last: int, weight: float, width: int, bag: tuple) -> DataFrame:
    """The blocks after a tree, for one that is grown on ``bag``."""
    route, kind = _route(root), boosting._bin_type(width)
    values = np.zeros(last + 1)
    for node in _nodes(root):
        values[node["number"]] = weight * _value(node)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                y, margin = boosting._column(batch, "y", i, np.uint8), boosting._column(batch, "margin", i, np.float64)
                bins = boosting._column(batch, "bins", i, kind).reshape(-1, len(y))
                yield _block(batch.column("number")[i].as_py(), bins, y, margin + values[_reached(route, bins, last)], False, bag)

    return blocks.select("number", "bins", "y", "margin").mapInArrow(of_batches, _BLOCKS)
