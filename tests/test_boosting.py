import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from pulseframe import fixed
from pulseframe.operators import boosting, model

PARAMS = {
    **fixed.BOOSTING, "rounds": 7, "leaves": 6, "min_data_in_leaf": 5, "max_bins": 12, "feature_fraction": 0.6, "bagging_every": 2,
}
FEATURES = ["a", "b", "c"]


def rows(n, seed=1):
    """Two informative features, one of noise with few values; some are missing."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        a, b, c = rng.gauss(0, 1), rng.gauss(0, 1), float(rng.randrange(4))
        label = int(a * a + b + rng.gauss(0, 0.5) > 1)
        out.append((label, None if rng.random() < 0.05 else a, float("nan") if rng.random() < 0.05 else b, c))
    return out


def frame(spark, values, parts=3):
    return spark.createDataFrame(values, "label int, a double, b double, c double").repartition(parts)


def by_hand(table, edges, base, params, rounds):
    """The same trees, one leaf after the other, each row looked at again for every candidate."""
    bins = np.array([[r[f"b{i}"] for i in range(len(edges))] for r in table])
    y, key = np.array([r["y"] for r in table]), np.array([r["key"] for r in table], np.int64)
    margin, width, trees = np.full(len(table), base), max(boosting.n_bins(edges)), []
    for t in range(rounds):
        drawn = boosting._drawn(len(edges), params["feature_fraction"], params["seed"], t)
        bag = boosting._in_bag(key, (params["bagging_fraction"], params["seed"], t // params["bagging_every"]))
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * 2**20) / 2**20, np.rint(p * (1 - p) * 2**20) / 2**20

        def best(mine):
            found = None
            for f in drawn:
                for cut in range(width - 1):
                    left, right = mine & (bins[:, f] <= cut), mine & (bins[:, f] > cut)
                    if min(left.sum(), right.sum()) < params["min_data_in_leaf"] or min(h[left].sum(), h[right].sum()) < 1e-3:
                        continue
                    gain = sum(g[s].sum() ** 2 / h[s].sum() * w for s, w in ((left, 1), (right, 1), (mine, -1)))
                    if gain > 1e-10 and (found is None or gain > found[0] + 1e-9):
                        found = gain, f, cut, left, right
            return found

        leaves = [[bag, best(bag), np.ones(len(table), bool)]]
        while len(leaves) < params["leaves"]:
            able = [x for x in leaves if x[1]]
            if not able:
                break
            chosen = max(able, key=lambda x: x[1][0])
            leaves = [x for x in leaves if x is not chosen]
            _, f, cut, left, right = chosen[1]
            low = bins[:, f] <= cut
            leaves += [[left, best(left), chosen[2] & low], [right, best(right), chosen[2] & ~low]]
        for mine, _, everywhere in leaves:
            margin[everywhere] -= params["learning_rate"] * g[mine].sum() / h[mine].sum()
        trees.append(sorted((int(m.sum()), round(float(-g[m].sum() / h[m].sum()), 6)) for m, _, _ in leaves))
    return trees, margin


def leaves_of(tree):
    return [(tree["n"], round(tree["value"], 6))] if "value" in tree else leaves_of(tree["left"]) + leaves_of(tree["right"])


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("boosting"))
    values = rows(400)
    return boosting.fit(frame(spark, values), None, FEATURES, params=PARAMS, state=folder), folder, values


def test_trees_equal_those_grown_by_hand(spark, fitted):
    fit, folder, _ = fitted
    table = spark.read.parquet(f"{folder}/rows").collect()
    trees, margin = by_hand(table, fit.edges, fit.base, PARAMS, PARAMS["rounds"])
    assert [sorted(leaves_of(t)) for t in fit.trees] == trees
    # and the MLlib model has their margins
    scored = spark.read.parquet(f"{folder}/rows").withColumn("margin", F.lit(fit.base))
    got = sorted(r["margin"] for r in boosting._advanced(scored, fit, fit.trees).collect())
    assert got == pytest.approx(sorted(margin.tolist()), abs=1e-9)


def test_limits_of_trees(fitted):
    fit, _, _ = fitted
    assert len(fit.trees) == PARAMS["rounds"] and fit.losses == [] and fit.best == PARAMS["rounds"]
    for tree, used in zip(fit.trees, fit.used):
        assert 2 <= boosting.n_leaves(tree) <= PARAMS["leaves"]
        assert min(n for n, _ in leaves_of(tree)) >= PARAMS["min_data_in_leaf"]
        features = lambda t: set() if "value" in t else {t["feature"]} | features(t["left"]) | features(t["right"])
        assert len(used) == math.ceil(0.6 * 3) and features(tree) <= set(used)
    assert len({tuple(u) for u in fit.used}) > 1  # each tree draws its own


def test_a_bag_lasts_some_rounds():
    key = np.random.default_rng(1).integers(-(2**63), 2**63, 20_000)
    bags = [boosting._in_bag(key, (0.8, 42, tree // 5)) for tree in range(11)]
    assert all((bags[0] == b).all() for b in bags[:5]) and (bags[4] != bags[5]).any() and (bags[9] != bags[10]).any()
    assert all(0.78 < b.mean() < 0.82 for b in bags)
    assert boosting._in_bag(key, (1.0, 42, 0)).all()


def test_partitioning_changes_nothing(spark, fitted, monkeypatch):
    fit, _, values = fitted
    monkeypatch.setattr(boosting, "_FEW", 0)  # sums are shuffled, as for large tables
    monkeypatch.setattr(boosting, "_ROWS", 1)
    other = boosting.fit(frame(spark, values[::-1], 7), None, FEATURES, params={**PARAMS, "rounds": 3})
    assert other.trees == fit.trees[:3]


def test_mllib_model(spark, fitted, tmp_path):
    fit, folder, values = fitted
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    fitted_model = PipelineModel([assembler, boosting.to_mllib(fit)])
    model.save_model(fitted_model, str(tmp_path), 1)
    loaded, _ = model.load_model(spark, str(tmp_path), 1)
    assert model.boosted_rounds(loaded) == PARAMS["rounds"]
    df = frame(spark, values)
    binned = boosting.binned(df, FEATURES, fit.edges).withColumns({"margin": F.lit(fit.base), "key": F.lit(0)})
    own = boosting._advanced(binned, fit, fit.trees).withColumn("own", 1 / (1 + F.exp(-F.col("margin"))))
    both = model.predict(own, loaded, "p")
    assert both.count() == len(values) and both.where("abs(p - own) > 1e-12").isEmpty()
    short = boosting.to_mllib(fit, 2)
    assert short.getNumTrees == 2


def test_the_fit_ends_when_the_loss_stops_improving(spark):
    """Labels are noise, so the validation loss soon rises; no tree is built after the patience is used up."""
    rng = random.Random(3)
    noise = [(rng.randrange(2), rng.random(), rng.random(), 0.0) for _ in range(600)]
    params = {**PARAMS, "rounds": 60, "early_stopping_rounds": 3, "learning_rate": 0.3}
    fit = boosting.fit(frame(spark, noise[:300]), frame(spark, noise[300:]), FEATURES, params=params)
    assert len(fit.trees) == len(fit.losses) == fit.best + 3 < 60
    assert fit.losses[fit.best - 1] == min(fit.losses)
    assert boosting.to_mllib(fit).getNumTrees == fit.best


def test_an_interrupted_fit_goes_on(spark, fitted, tmp_path, monkeypatch):
    _, _, values = fitted
    params, df = {**PARAMS, "rounds": 14}, frame(spark, values)
    held_out = frame(spark, rows(100, 2))
    whole = boosting.fit(df, held_out, FEATURES, params=params)
    real, built = boosting._as_dict, []

    def failing(*args):
        if len(args[0].children or ()) and args[0].number == 0:
            built.append(1)
            if len(built) == 13:
                raise RuntimeError("stopped")
        return real(*args)

    monkeypatch.setattr(boosting, "_as_dict", failing)
    with pytest.raises(RuntimeError):
        boosting.fit(df, held_out, FEATURES, params=params, state=str(tmp_path))
    resumed = boosting.fit(df, held_out, FEATURES, params=params, state=str(tmp_path))
    assert resumed.trees == whole.trees and resumed.losses == pytest.approx(whole.losses, abs=1e-12)
    assert len(built) == 13 + 4  # the ten stored trees were not grown again
    again = boosting.fit(df, held_out, FEATURES, params=params, state=str(tmp_path))
    assert again.trees == whole.trees and len(built) == 17


def test_leaf_wise_loss_is_no_worse_than_that_of_full_depth(spark):
    # MLlib does not train on missing values
    df, held_out = (frame(spark, v).dropna() for v in (rows(1500, 5), rows(500, 6)))
    options = dict(features=FEATURES, rounds=12, leaves=8, learning_rate=0.3, feature_fraction=1.0, bagging_fraction=1.0)
    losses = {}
    for growth in ("leaf", "level"):
        fit = model.train(df, held_out, growth=growth, **options)
        losses[growth] = model.evaluate(model.predict(held_out, fit)).first()["log_loss"]
    assert losses["leaf"] <= losses["level"] + 0.01


def test_one_class_and_no_rows(spark):
    ones = boosting.fit(frame(spark, [(1, 1.0, 2.0, 3.0)] * 50), None, FEATURES, params=PARAMS)
    assert ones.trees == [] and boosting.to_mllib(ones).getNumTrees == 1
    with pytest.raises(ValueError):
        boosting.fit(frame(spark, [(None, 1.0, 2.0, 3.0)]), None, FEATURES, params=PARAMS)
    with pytest.raises(ValueError):
        model.train(frame(spark, rows(10)), features=FEATURES, growth="wide")


def test_rows_travel_as_blocks(spark, fitted, monkeypatch):
    """A job over the rows hands Python a few blocks and not every value; blocks of any size give the same trees."""
    fit, folder, values = fitted
    width, table = max(boosting.n_bins(fit.edges)), spark.read.parquet(f"{folder}/rows").withColumn("margin", F.lit(fit.base))
    blocks = boosting._packed(table.coalesce(1), 3, width, (0.8, 42, 0))
    assert blocks.count() == 1
    (block,) = blocks.collect()
    keys = [r["key"] for r in table.coalesce(1).collect()]
    assert np.frombuffer(block["key"], np.int64).tolist() == keys and len(block["bins"]) == 3 * len(keys)
    assert (np.frombuffer(block["used"], bool) == boosting._in_bag(np.array(keys), (0.8, 42, 0))).all()
    sums = boosting.cell_sums(blocks, [], [0], [0, 1, 2], width, True, False)
    assert "MapInArrow" in sums._jdf.queryExecution().executedPlan().toString()
    assert sums.agg(F.sum("n")).first()[0] == 3 * np.frombuffer(block["used"], bool).sum()
    monkeypatch.setattr(boosting, "_BLOCK", 7)
    small = boosting._packed(table.coalesce(1), 3, width, (0.8, 42, 0))
    assert small.count() == math.ceil(len(keys) / 7)
    other = lambda b: sorted(map(tuple, boosting.cell_sums(b, [], [0], [0, 1, 2], width, True, False).collect()))
    assert other(small) == other(blocks)


def test_root_gains(spark):
    values = rows(300, 9)
    edges = {"a": [-1.0, 0.0, 1.0], "c": [1.0, 2.0, 9.0]}
    got = {(r["feature"], r["below"]): r for r in boosting.root_gains(frame(spark, values), edges, "label").collect()}
    y = np.array([v[0] for v in values], float)
    g, h = np.rint((y.mean() - y) * 2**20) / 2**20, np.full(len(y), np.rint(y.mean() * (1 - y.mean()) * 2**20) / 2**20)
    for place, feature in ((1, "a"), (3, "c")):
        x = np.array([np.nan if v[place] is None else v[place] for v in values])
        for below in edges[feature]:
            left, r = x < below, got[feature, below]
            assert (r["n_left"], r["n_right"]) == (left.sum(), (~left).sum())
            if left.all():
                assert r["gain"] is None
            else:
                want = g[left].sum() ** 2 / h[left].sum() + g[~left].sum() ** 2 / h[~left].sum() - g.sum() ** 2 / h.sum()
                assert r["gain"] == pytest.approx(want)
    assert boosting.root_gains(frame(spark, values).where("false"), edges, "label").where("n_left > 0").isEmpty()
