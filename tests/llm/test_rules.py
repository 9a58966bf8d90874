import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseframe.llm import queries, rules
from tests.llm.texts import frame, passages, words

SF = "/root/testdata/sf0.1"


def plain_statistics(text):
    t, w = text or "", words(text)
    n, points = max(len(w), 1), max(len(t), 1)
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    return (
        len(w), sum(map(len, w)) / n, len(set(w)) / n, len(set(triples)) / max(len(triples), 1),
        sum(a == b for a, b in zip(w, w[1:])) / n, len(re.findall(r"[#$%&*|<>@^~=+\\{}\[\]_]", t)) / n,
        len(re.findall(r"[.,;:!?'\"()\-/]", t)) / n, t.count("\n") / n, len(re.findall("[A-Z]", t)) / points,
        len(re.findall("[0-9]", t)) / points, sum(ord(c) > 127 for c in t) / points, max(map(len, w), default=0),
    )


def test_statistics(spark):
    rows = passages(21, 80) + [(900, None), (901, ""), (902, " \n\t"), (903, "Éa É-1 É-1\n{x}"), (904, "é" * 4000), (905, "a"), (906, "a b")]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    got = {r["doc_id"]: tuple(r["_statistics"]) for r in rules.measure(frame(spark, rows)).collect()}
    for k, t in rows:
        assert got[k] == pytest.approx(plain_statistics(t)), t


def labelled(seed, n=400):
    """Good texts are varied, bad ones repeat themselves or are full of symbols."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        k = rng.randint(5, 120)
        good = rng.random() < 0.8
        w = [f"w{rng.randrange(4000)}" for _ in range(k)]
        if not good:
            w = [rng.choice(w[:2]) for _ in w] if rng.random() < 0.5 else [x + "$$" for x in w]
        docs.append((i, " ".join(w)))
        labels.append((i, int(good)))
    return docs, labels


def by_hand(model, text):
    s = dict(zip(rules.STATISTICS, plain_statistics(text)))
    odds = model.intercept
    for rule in model.rules:
        odds += rule.weight * all((a is None or s[x] > a) and (b is None or s[x] <= b) for x, a, b in rule.bounds)
    return 1 / (1 + math.exp(-odds))


def test_fit_and_score(spark):
    docs, labels = labelled(1)
    model = rules.fit(frame(spark, docs), frame(spark, labels, "doc_id long, quality int"))
    assert 0 < len(model.rules) < 100 and all(r.weight for r in model.rules)
    unseen, truth = labelled(2)
    rows = {r["doc_id"]: r["score"] for r in rules.score(frame(spark, unseen), model).collect()}
    assert np.mean([(rows[i] >= 0.3) == bool(y) for i, y in truth]) > 0.95
    for i, t in unseen:  # the compiled column is the model
        assert rows[i] == pytest.approx(by_hand(model, t))
    table = model.table(spark).collect()
    assert len(table) == len(model.rules) and abs(table[0]["weight"]) >= abs(table[-1]["weight"])
    again = rules.fit(frame(spark, docs[::-1]).repartition(7), frame(spark, labels, "doc_id long, quality int"))
    assert {str(r) for r in again.rules} == {str(r) for r in model.rules}


def test_sample_keeps_both_classes(spark):
    labels = [(i, int(i % 50 > 0)) for i in range(10_000)] + [(1, 1)] * 3000 + [(None, 1), (2, None)]
    docs = [(i, f"text {i}") for i in range(10_000)] + [(1, "again")] * 3000 + [(None, "x")]
    rows = rules.examples(frame(spark, docs), frame(spark, labels, "doc_id long, quality int"), "quality", 1000).collect()
    good, bad = [[r for r in rows if r["y"] == y] for y in (1.0, 0.0)]
    assert len(bad) == 200 and 700 < len(good) < 900  # all of the rare class; the other fills the sample
    assert sum(r["weight"] for r in rows) == pytest.approx(10_000, rel=0.1)
    assert len({r["doc_id"] for r in rows}) == len(rows)


@pytest.mark.parametrize("labels, value", [([], 0.5), ([(None, 1), (1, None)], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)])
def test_without_both_classes(spark, labels, value):
    docs = frame(spark, [(1, "a", 5), (2, None, 6), (None, "", 7)], "doc_id long, text string, score int")
    model = rules.fit(docs, frame(spark, labels, "doc_id long, quality int"))
    got = rules.score(docs, model)
    assert got.columns == ["doc_id", "score"]
    assert {r["score"] for r in got.collect()} == {value}
    assert rules.score(docs.limit(0), model).count() == 0


def test_texts_alike(spark):
    docs, labels = frame(spark, [(i, "same text") for i in range(20)]), frame(spark, [(i, i % 4 and 1) for i in range(20)], "doc_id long, quality int")
    model = rules.fit(docs, labels)
    assert model.rules == () and rules.score(docs, model).first()["score"] == pytest.approx(0.75)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_held_out_accuracy(spark):
    rows = queries.op12_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 500
    for r in rows:
        assert zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["predicted"] == (r["score"] >= 0.3)
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.98
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    assert np.mean(bad) < 0.05


def test_query_covers_every_row(spark, tmp_path):
    docs, labels = labelled(3, 120)
    docs += [(500, None), (501, ""), (None, "no id"), (1, "twice")]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, labels, "doc_id long, quality int").withColumn("toxic", F.lit(0)).write.parquet(f"{tmp_path}/labels.parquet")
    rows = queries.op12_quality_classifier(spark, str(tmp_path)).collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {False}
