"""Boosted trees grown leaf by leaf, for a label of 0 and 1.

Rows are binned once and kept, in blocks of bytes, with their margin (the log-odds so far), gradient and curvature; a task
reads a block's arrays as they are, and of these only what a job needs. One aggregation gives the histograms
(rows, gradient and curvature per feature and bin) of many open leaves at a time; the driver holds histograms only,
whose size is leaves x features x bins whatever the table. The leaf with the largest gain is split next, until a tree
has its leaves. When the children of a leaf are needed, those of all leaves that may still be split are counted in the
same job, the smaller child of each; the larger one is the difference. So a tree costs about as many jobs as
it has levels, and is the tree that splitting one leaf at a time would give.

Gradients are summed as whole numbers of 2^-20, so that neither partitioning nor a retried task can change a tree.
Every tree draws its share of the features; every few rounds a share of the rows is drawn by a hash of their
content. After each round the validation loss is taken, and the fit ends when it has not improved for some
rounds. With a state folder, the trees are stored every few rounds, and a fit that is started again goes on from there.

The result becomes an MLlib model, so that it is saved, loaded and applied like any other.
"""

from __future__ import annotations

import functools
import heapq
import math
import random
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pulseframe import fixed
from pulseframe.session import child_folders, folder_exists, materialize, scratch_path, ship_package
from pulseframe.sinks.files import read_document, write_document

_SCALE = 1 << 20
#: curvature that a leaf needs at least
_LEAST_CURVATURE = 1e-3
#: rounds between two written tables of margins, and between two stored states
KEEP_EVERY = 10
#: a small table is kept in one partition per so many rows; jobs over it are many and short
_ROWS = 200_000
#: rows of a block at most, but for what is left of a batch
_BLOCK = 1 << 16

Histogram = np.ndarray  # features x bins x (rows, gradient, curvature)


@dataclass
class Node:
    number: int
    total: np.ndarray  # rows, gradient, curvature
    gain: float = 0.0
    feature: int = -1
    bin: int = -1  # rows of this bin and those below go left
    parts: tuple[np.ndarray, np.ndarray] | None = None  # totals of the children
    histogram: Histogram | None = None
    children: tuple[Node, Node] | None = None
    split: bool = False

    @property
    def value(self) -> float:
        return float(-self.total[1] / self.total[2]) if self.total[2] > 0 else 0.0


@dataclass
class Fit:
    """``trees`` are nested dicts: {feature, bin, below, gain, n, left, right} or {value, n}."""

    features: list[str]
    edges: list[list[float]]
    base: float
    learning_rate: float
    trees: list[dict] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)  # validation loss after each round that was built
    used: list[list[int]] = field(default_factory=list)  # features each tree drew
    finished: bool = False

    @property
    def best(self) -> int:
        """Rounds to keep."""
        return int(np.argmin(self.losses)) + 1 if self.losses else len(self.trees)


# ---------------------------------------------------------------------------------- binning


def quantile_edges(df: DataFrame, features: list[str], max_bins: int, error: float = 1e-4) -> list[list[float]]:
    """Per feature the distinct values (``max_bins`` - 1 at most) at which a new bin begins."""
    probabilities = [i / max_bins for i in range(1, max_bins)]
    finite = [F.when(~F.isnan(c) & F.col(c).isNotNull(), F.col(c).cast("double")).alias(c) for c in features]
    found = df.select(*finite).approxQuantile(features, probabilities, error)
    return [sorted(set(values)) for values in found]


def binned(df: DataFrame, features: list[str], edges: list[list[float]]) -> DataFrame:
    """Columns ``b0``, ``b1``, ... with the bin of each feature; missing values have a bin of their own, the last."""
    inputs, outputs = [f"_x{i}" for i in range(len(features))], [f"_y{i}" for i in range(len(features))]
    plain = df.withColumns({x: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for x, c in zip(inputs, features)})
    splits = [[-math.inf, *e, math.inf] if e else [-math.inf, 0.0, math.inf] for e in edges]
    rows = Bucketizer(splitsArray=splits, inputCols=inputs, outputCols=outputs, handleInvalid="keep").transform(plain)
    rows = rows.withColumns({f"b{i}": F.col(y).cast("smallint") for i, y in enumerate(outputs)})
    return rows.drop(*inputs, *outputs)


def n_bins(edges: list[list[float]]) -> list[int]:
    return [max(len(e), 1) + 2 for e in edges]  # between and around the edges, and the missing values


# ------------------------------------------------------------------------------- histograms

_SUMS = "node int, cell int, n long, g long, h long"
#: tasks whose sums the driver adds up itself
_FEW = 16
_LOSS = -1  # the node whose sums are the validation rows and their loss


def _whole(x: np.ndarray) -> np.ndarray:
    return np.rint(x * _SCALE).astype(np.int64)


def _reached(route: list, bins: Callable[[int], np.ndarray], places: np.ndarray) -> dict[int, np.ndarray]:
    """The places that reach each end of a route. ``route`` has (node, feature, bin, left, right) for every inner node,
    parents first."""
    at = {0: places}
    for node, feature, bin_, left, right in route:
        here = at.pop(node)
        low = bins(feature)[here] <= bin_
        at[left], at[right] = here[low], here[~low]
    return at


def _towards(route: list, open_: list[int]) -> list:
    """The part of a route that leads to the open nodes."""
    wanted, kept = set(open_), []
    for step in reversed(route):
        if step[3] in wanted or step[4] in wanted:
            wanted.add(step[0])
            kept.append(step)
    return kept[::-1]


_BLOCKS = "bins binary, y binary, held_out binary, key binary, margin binary, g binary, h binary, used binary, n_held long, lost long"


def _bin_type(width: int) -> type:
    return np.uint8 if width <= 1 << 8 else np.uint16


def _block(bins: np.ndarray, y: np.ndarray, held: np.ndarray, key: np.ndarray, margin: np.ndarray, bag: tuple) -> pa.RecordBatch:
    """Some rows as one: their gradients and curvatures, whether the next tree is grown on them, and the loss of those that
    are held out."""
    p = 1.0 / (1.0 + np.exp(-margin))
    right = np.clip(np.where(y[held] == 1, p[held], 1.0 - p[held]), 1e-15, 1.0)
    g, h = _whole(p - y).astype(np.int32), _whole(p * (1.0 - p)).astype(np.int32)
    arrays = [bins, y, held, key, margin, g, h, ~held & _in_bag(key, bag)]
    columns = [pa.array([x.tobytes()], pa.binary()) for x in arrays]
    columns += [pa.array([int(x)], pa.int64()) for x in (held.sum(), _whole(-np.log(right)).sum())]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _BLOCKS.split(", ")])


def _column(batch: pa.RecordBatch, name: str, place: int, kind: type) -> np.ndarray:
    return np.frombuffer(batch.column(name)[place].as_buffer(), kind)


def _packed(rows: DataFrame, n_features: int, width: int, bag: tuple) -> DataFrame:
    """Rows (b0, b1, ..., y, held_out, key, margin) as blocks."""

    def block(waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(waiting)
        column = lambda name: table[name].to_numpy()
        bins = np.stack([column(f"b{i}") for i in range(n_features)]).astype(_bin_type(width))
        return _block(bins, *(column(name) for name in ("y", "held_out", "key", "margin")), bag)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            for begin in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(begin, _BLOCK)
                if waiting and n + part.num_rows > _BLOCK:
                    yield block(waiting)
                    waiting, n = [], 0
                waiting.append(part)
                n += part.num_rows
        if waiting:
            yield block(waiting)

    return rows.mapInArrow(of_batches, _BLOCKS)


def _summing(route: list, open_: list[int], features: list[int], width: int, loss: bool):
    """Sums per open node and cell of the rows of a task that are in the bag; on demand the loss of its validation rows."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, against = np.zeros((3, len(open_), len(features), width), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                if loss:
                    against += (batch.column("n_held")[i].as_py(), batch.column("lost")[i].as_py())
                g, h = _column(batch, "g", i, np.int32), _column(batch, "h", i, np.int32)
                bins = _column(batch, "bins", i, _bin_type(width)).reshape(-1, len(g))
                at = _reached(route, lambda f: bins[f], np.flatnonzero(_column(batch, "used", i, bool)))
                for k, node in enumerate(open_):
                    here = at[node]
                    weights = g[here].astype(np.float64), h[here].astype(np.float64)
                    for j, f in enumerate(features):
                        cell = bins[f][here].astype(np.intp)
                        # sums of integers below 2^53 are exact in doubles, and a block has no more
                        total[0, k, j] += np.bincount(cell, minlength=width)
                        for of_weight, weight in zip(total[1:, k, j], weights):
                            of_weight += np.bincount(cell, weight, width).astype(np.int64)
        total = total.reshape(3, -1)
        some = np.flatnonzero(total[0])
        node = np.array(open_, np.int32)[some // (len(features) * width)]
        sums = [total[0][some], total[1][some], total[2][some]]
        cells = (some % (len(features) * width)).astype(np.int32)
        if against[0]:
            node, cells = np.append(node, np.int32(_LOSS)), np.append(cells, np.int32(0))
            sums = [np.append(a, b) for a, b in zip(sums, (against[0], against[1], 0))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (node.astype(np.int32), cells, *sums)], ["node", "cell", "n", "g", "h"])

    return of_batches


def cell_sums(blocks: DataFrame, route: list, open_: list[int], features: list[int], width: int, loss: bool, shuffled: bool) -> DataFrame:
    """(node, cell, n, g, h): rows, gradients and curvatures (in 2^-20) per open node and bin of a feature. Tasks sum up before
    anything is shuffled; a task sends nodes x features x bins rows at most. The sums of a few tasks need no shuffle."""
    needed = blocks.select("bins", "g", "h", "used", *(["n_held", "lost"] if loss else []))
    sums = needed.mapInArrow(_summing(_towards(route, open_), open_, features, width, loss), _SUMS)
    if not shuffled:
        return sums
    return sums.groupBy("node", "cell").agg(F.sum("n").alias("n"), F.sum("g").alias("g"), F.sum("h").alias("h"))


def _histograms(sums: DataFrame, n_features: int, width: int) -> tuple[dict[int, Histogram], float | None]:
    """The histograms of the open nodes, and the validation loss; their size does not depend on the rows."""
    table = sums.toArrow()
    number, cell = table["node"].to_numpy(), table["cell"].to_numpy()
    n, g, h = (table[c].to_numpy() for c in ("n", "g", "h"))
    found = {}
    for k in np.unique(number[number != _LOSS]):
        mine = number == k
        histogram = np.zeros((n_features * width, 3), np.int64)
        np.add.at(histogram, cell[mine], np.column_stack([n[mine], g[mine], h[mine]]))
        found[int(k)] = histogram.reshape(n_features, width, 3) / (1, _SCALE, _SCALE)
    lost = number == _LOSS
    return found, float(g[lost].sum() / _SCALE / n[lost].sum()) if lost.any() else None


def root_gains(df: DataFrame, edges: dict[str, list[float]], label: str) -> DataFrame:
    """(feature, below, n_left, n_right, gain) for every split of all labelled rows at the given edges: the
    gains from which a first tree's root chooses. Splits that leave one side empty have no gain."""
    names = list(edges)
    own = df.where(F.col(label).isNotNull()).select(*names, F.col(label).cast("double").alias("y"))
    rows = binned(own, names, list(edges.values()))
    p = F.lit(own.agg(F.avg("y").alias("p")).first()["p"]).cast("double")
    g, h = F.round((p - F.col("y")) * _SCALE), F.round(p * (1 - p) * _SCALE)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"b{i}").alias("bin")) for i, c in enumerate(names)])
    each = rows.select(g.cast("long").alias("g"), h.cast("long").alias("h"), F.explode(cells).alias("c"))
    sums = each.groupBy("c.feature", "c.bin").agg(F.count(F.lit(1)).alias("n"), F.sum("g").alias("g"), F.sum("h").alias("h"))
    every = df.sparkSession.createDataFrame([(c, i, float(e)) for c in names for i, e in enumerate(edges[c])], "feature string, bin int, below double")
    filled = every.join(sums, ["feature", "bin"], "full")
    so_far = Window.partitionBy("feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("feature")
    total = {c: F.sum(F.coalesce(c, F.lit(0))).over(whole) for c in ("n", "g", "h")}
    left = {c: F.sum(F.coalesce(c, F.lit(0))).over(so_far) for c in ("n", "g", "h")}
    sides = filled.select("feature", "below", *[left[c].alias(f"l{c}") for c in left], *[total[c].alias(f"t{c}") for c in total])
    part = lambda g, h: F.pow(g / _SCALE, F.lit(2)) / F.nullif(h / _SCALE, F.lit(0.0))
    left, right = part(F.col("lg"), F.col("lh")), part(F.col("tg") - F.col("lg"), F.col("th") - F.col("lh"))
    return sides.where("below IS NOT NULL").select(
        "feature", "below", F.col("ln").alias("n_left"), (F.col("tn") - F.col("ln")).alias("n_right"),
        (left + right - part(F.col("tg"), F.col("th"))).alias("gain"),
    )


def best_split(histogram: Histogram, least_rows: int) -> tuple[float, int, int] | None:
    """(gain, place of the feature, bin) of the best split; the first of several equal ones."""
    left = np.cumsum(histogram, axis=1)[:, :-1]
    total = histogram[0].sum(axis=0)
    right = total - left
    enough = (left[..., 0] >= least_rows) & (right[..., 0] >= least_rows)
    enough &= (left[..., 2] >= _LEAST_CURVATURE) & (right[..., 2] >= _LEAST_CURVATURE)
    if not enough.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[..., 1] ** 2 / left[..., 2] + right[..., 1] ** 2 / right[..., 2] - total[1] ** 2 / total[2]
    gain = np.where(enough, gain, -np.inf)
    at = int(gain.argmax())
    feature, bin_ = divmod(at, gain.shape[1])
    return (float(gain[feature, bin_]), feature, bin_) if gain[feature, bin_] > 1e-10 else None


# ------------------------------------------------------------------------------ one tree


def _route(node: Node, accepted: bool) -> list:
    if node.children is None or accepted and not node.split:
        return []
    left, right = node.children
    return [(node.number, node.feature, node.bin, left.number, right.number), *_route(left, accepted), *_route(right, accepted)]


def grow(
    blocks: DataFrame, features: list[int], width: int, leaves: int, least_rows: int, loss: bool = False, shuffled: bool = True
) -> tuple[Node | None, float | None]:
    """The tree of the rows that are in the blocks' bag, None if nothing splits them; and the loss of those that are held
    out, before this tree."""
    numbers = iter(range(1 << 30))

    def judge(node: Node) -> None:
        found = best_split(node.histogram, least_rows)
        if found is None:
            node.histogram = None
            return
        node.gain, place, node.bin = found
        node.feature = features[place]
        left = node.histogram[place, : node.bin + 1].sum(axis=0)
        node.parts = left, node.total - left

    def expand(wave: list[Node]) -> None:
        smaller: dict[int, tuple[Node, Node, Node]] = {}
        for node in wave:
            node.children = tuple(Node(next(numbers), total) for total in node.parts)
            few, many = sorted(node.children, key=lambda c: (c.total[0], c.number))
            if many.total[0] >= 2 * least_rows:
                smaller[few.number] = few, many, node
            else:
                node.histogram = None
        if not smaller:
            return
        sums = cell_sums(blocks, _route(root, False), list(smaller), features, width, False, shuffled)
        found, _ = _histograms(sums, len(features), width)
        for few, many, node in smaller.values():
            few.histogram = found[few.number]
            many.histogram = node.histogram - few.histogram
            node.histogram = None
            for child in (few, many):
                judge(child)

    found, before = _histograms(cell_sums(blocks, [], [0], features, width, loss, shuffled), len(features), width)
    if 0 not in found:
        return None, before
    root = Node(next(numbers), found[0][0].sum(axis=0), histogram=found[0])
    judge(root)
    heap, n_leaves = [(-root.gain, root.number, root)] if root.parts else [], 1
    while heap and n_leaves < leaves:
        _, _, node = heapq.heappop(heap)
        if node.children is None:
            others = [n for _, _, n in heapq.nsmallest(leaves - n_leaves - 1, heap) if n.children is None]
            expand([node, *others])
        node.split = True
        n_leaves += 1
        for child in node.children:
            if child.parts:
                heapq.heappush(heap, (-child.gain, child.number, child))
    return (root if root.split else None), before


def _as_dict(node: Node, edges: list[list[float]]) -> dict:
    if not node.split:
        return {"value": node.value, "n": int(node.total[0])}
    own = edges[node.feature] or [0.0]
    # the last split leaves only the missing values on the right
    below = own[node.bin] if node.bin < len(own) else math.inf
    left, right = (_as_dict(c, edges) for c in node.children)
    return {"feature": node.feature, "bin": node.bin, "below": below, "gain": node.gain, "n": int(node.total[0]), "left": left, "right": right}


def least_leaf(tree: dict) -> int:
    """Rows (of the bag) in the smallest leaf."""
    return tree["n"] if "value" in tree else min(least_leaf(tree["left"]), least_leaf(tree["right"]))


def n_leaves(tree: dict) -> int:
    return 1 if "value" in tree else n_leaves(tree["left"]) + n_leaves(tree["right"])


# ---------------------------------------------------------------------------------- the fit


def _drawn(features: int, share: float, seed: int, tree: int) -> list[int]:
    return sorted(random.Random(f"{seed}:{tree}").sample(range(features), max(1, math.ceil(share * features))))


def _in_bag(key: np.ndarray, bag: tuple[float, int, int]) -> np.ndarray:
    """Whether rows are in a bag (share, seed, number), by the hash of their content."""
    share, seed, number = bag
    if share >= 1:
        return np.ones(len(key), bool)
    x = key.view(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03) % 2**64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.float64) < share * 2.0**32


def _flat(tree: dict) -> tuple[list, np.ndarray]:
    """The route through a tree, and the value at each of its nodes."""
    route, values = [], []

    def walk(node: dict) -> int:
        number = len(values)
        values.append(node.get("value", 0.0))
        if "value" not in node:
            place = len(route)
            route.append(None)
            left, right = walk(node["left"]), walk(node["right"])
            route[place] = number, node["feature"], node["bin"], left, right
        return number

    walk(tree)
    return route, np.array(values)


def _raised(margin: np.ndarray, flat: list, rate: float, bins: Callable[[int], np.ndarray]) -> np.ndarray:
    """The margins after trees."""
    margin = margin.copy()
    for route, values in flat:
        for node, here in _reached(route, bins, np.arange(len(margin))).items():
            margin[here] += rate * values[node]
    return margin


def _advanced(rows: DataFrame, model: Fit, trees: list[dict]) -> DataFrame:
    """``rows`` with the margins after these trees."""
    flat, rate, at = [_flat(t) for t in trees], model.learning_rate, rows.columns.index("margin")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = _raised(batch.column(at).to_numpy(), flat, rate, lambda f: batch.column(f"b{f}").to_numpy())
            yield batch.set_column(at, "margin", pa.array(margin))

    return rows.mapInArrow(of_batches, rows.schema)


def _next(blocks: DataFrame, model: Fit, width: int, bag: tuple) -> DataFrame:
    """The blocks after the last tree, for a tree that is grown on ``bag``."""
    flat, rate = [_flat(model.trees[-1])], model.learning_rate

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                kinds = {"y": np.float64, "held_out": bool, "key": np.int64, "margin": np.float64}
                *kept, margin = (_column(batch, name, i, kind) for name, kind in kinds.items())
                bins = _column(batch, "bins", i, _bin_type(width)).reshape(-1, len(margin))
                yield _block(bins, *kept, _raised(margin, flat, rate, lambda f: bins[f]), bag)

    return blocks.select("bins", "y", "held_out", "key", "margin").mapInArrow(of_batches, _BLOCKS)


def fit(
    train_df: DataFrame,
    validation_df: DataFrame | None = None,
    features: list[str] = fixed.SCALED_FEATURES,
    label: str = fixed.LABEL,
    params: dict = fixed.BOOSTING,
    state: str | None = None,
) -> Fit:
    """Grow trees round by round until ``rounds`` are built or the validation loss has not improved for
    ``early_stopping_rounds``. Rows without label are left out; missing features go right.

    ``state`` is a folder for the binned rows and the trees so far. A fit that finds trees there goes on after them; its inputs
    and parameters must be those it was started with.
    """
    spark = train_df.sparkSession
    ship_package(spark)
    folder = (state or scratch_path(spark, "boosting")).rstrip("/")
    model, rows = _started(spark, train_df, validation_df, features, label, params, folder)
    width = max(n_bins(model.edges))
    bag = lambda tree: (params["bagging_fraction"], params["seed"], tree // params["bagging_every"])
    if model.trees:  # a resumed fit: the margins of the trees so far
        rows = _advanced(rows, model, model.trees)
    shuffled = rows.rdd.getNumPartitions() > _FEW
    current = _packed(rows, len(features), width, bag(len(model.trees))).persist()
    patience, held = params["early_stopping_rounds"], [current]
    while not model.finished:
        done = len(model.trees)
        drawn = _drawn(len(features), params["feature_fraction"], params["seed"], done)
        last = done >= params["rounds"]  # only the loss of the last tree is wanted
        leaves = 1 if last else params["leaves"]
        tree, loss = grow(current, drawn, width, leaves, params["min_data_in_leaf"], True, shuffled)
        if loss is not None and 0 < done > len(model.losses):
            model.losses.append(loss)
        if state and done and done % KEEP_EVERY == 0:
            _store(spark, model, folder)
        if tree is None or patience and model.losses and done - model.best >= patience:
            break
        model.trees.append(_as_dict(tree, model.edges))
        model.used.append(drawn)
        advanced = _next(current, model, width, bag(done + 1))
        if (done + 1) % KEEP_EVERY == 0:  # cut the lineage
            advanced = materialize(advanced, scratch_path(spark, "margins"))
        current = advanced.persist()
        held.append(current)
        while len(held) > 2:  # the one before is read until the newest is filled
            held.pop(0).unpersist()
    for frame in held:
        frame.unpersist()
    model.finished = True
    if state:
        _store(spark, model, folder)
    return model


def _started(spark, train_df, validation_df, features, label, params, folder) -> tuple[Fit, DataFrame]:
    """The fit so far and the binned rows with their first margin."""
    names = [f"b{i}" for i in range(len(features))]
    if folder_exists(spark, f"{folder}/edges"):
        start = read_document(spark, f"{folder}/edges")
        model = Fit(features, start["edges"], start["base"], params["learning_rate"])
        newest = _newest(spark, folder)
        if newest is not None:
            model.trees, model.losses, model.used = newest["trees"], newest["losses"], newest["used"]
            model.finished = newest["finished"]
        rows = spark.read.parquet(f"{folder}/rows")
        return model, rows.withColumn("margin", F.lit(model.base))
    kept = [F.col(c).cast("double").alias(c) for c in features]
    own = train_df.where(F.col(label).isNotNull()).select(*kept, F.col(label).cast("double").alias("y"))
    known = own.agg(F.avg("y").alias("y"), F.count("y").alias("n")).first()
    if not known["n"]:
        raise ValueError("no labelled rows to train on")
    share = min(max(known["y"], 1e-6), 1 - 1e-6)
    edges = quantile_edges(own, features, params["max_bins"])
    both = own.withColumn("held_out", F.lit(False))
    if validation_df is not None:
        others = validation_df.where(F.col(label).isNotNull()).select(*kept, F.col(label).cast("double").alias("y"))
        both = both.unionByName(others.withColumn("held_out", F.lit(True)))
    key = F.xxhash64(*features, "y").alias("key")
    rows = binned(both, features, edges).select(*names, "y", "held_out", key)
    if (wanted := math.ceil(known["n"] / _ROWS)) <= _FEW:
        rows = rows.coalesce(wanted)
    rows = materialize(rows, f"{folder}/rows")
    model = Fit(features, edges, math.log(share / (1 - share)), params["learning_rate"])
    write_document(spark, {"edges": edges, "base": model.base}, f"{folder}/edges")
    return model, rows.withColumn("margin", F.lit(model.base))


def _store(spark: SparkSession, model: Fit, folder: str) -> None:
    """Each state goes to a folder of its own: one that was not completed is passed over."""
    document = {"trees": model.trees, "losses": model.losses, "used": model.used, "finished": model.finished}
    name = "finished" if model.finished else f"rounds={len(model.trees)}"
    write_document(spark, document, f"{folder}/states/{name}")


def _newest(spark: SparkSession, folder: str) -> dict | None:
    if not folder_exists(spark, f"{folder}/states"):
        return None
    names = child_folders(spark, f"{folder}/states")
    ranked = sorted(names, key=lambda n: math.inf if n == "finished" else int(n.split("=")[1]), reverse=True)
    for name in ranked:
        if folder_exists(spark, f"{folder}/states/{name}/_SUCCESS"):
            return read_document(spark, f"{folder}/states/{name}")
    return None


# ------------------------------------------------------------------------------ as MLlib model


def to_mllib(model: Fit, rounds: int | None = None) -> GBTClassificationModel:
    """The first ``rounds`` trees (by default those of the best validation loss) as a model over the vector ``features``.

    MLlib's probability is that of twice its margin, and it has no starting margin: leaves are halved, and
    the first tree contains the base.
    """
    trees = model.trees[: model.best if rounds is None else rounds] or [{"value": 0.0, "n": 0}]
    rate = model.learning_rate

    def halved(tree: dict, extra: float) -> dict:
        if "value" in tree:
            return {**tree, "value": tree["value"] / 2 + extra}
        return {**tree, "value": 0.0, "left": halved(tree["left"], extra), "right": halved(tree["right"], extra)}

    own = [halved(tree, model.base / (2 * rate) if i == 0 else 0.0) for i, tree in enumerate(trees)]
    return mllib_model("leafwise", own, [rate] * len(own), len(model.features))


def mllib_model(uid: str, trees: list[dict], weights: list[float], n_features: int) -> GBTClassificationModel:
    """Trees as a model: nested dicts {value, n}, inner nodes with feature, below, gain, left and right."""
    gateway = SparkSession.active().sparkContext._gateway
    ml, double = gateway.jvm.org.apache.spark.ml, gateway.jvm.double
    # each name is a call to the JVM: they are looked up once and not per node
    calculator = gateway.jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    leaf_node, inner_node, continuous = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit

    @functools.cache
    def impurity(n: int):
        stats = gateway.new_array(double, 3)
        stats[0], stats[1], stats[2] = float(n), 0.0, 0.0
        return calculator(stats, n)

    def node(tree: dict):
        if "left" not in tree:
            return leaf_node(tree["value"], 0.0, impurity(tree["n"]))
        # MLlib goes left up to and including the threshold
        threshold = math.nextafter(tree["below"], -math.inf)
        split = continuous(tree["feature"], threshold)
        return inner_node(tree["value"], 0.0, tree["gain"], node(tree["left"]), node(tree["right"]), split, impurity(tree["n"]))

    kind = ml.regression.DecisionTreeRegressionModel
    fitted, factors = gateway.new_array(kind, len(trees)), gateway.new_array(double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        fitted[i], factors[i] = kind(f"tree{i}", node(tree), n_features), weight
    return GBTClassificationModel(ml.classification.GBTClassificationModel(uid, fitted, factors, n_features))
