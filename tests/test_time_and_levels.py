import math
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import difference, incremental, levels, scaling, timejoin


def moments(n, seed, keys=4, reach=400):
    rng = random.Random(seed)
    return [
        (i, rng.choice([None, *"abcd"[:keys]]), None if rng.random() < 0.05 else rng.randint(-reach, reach)) for i in range(n)
    ]


@pytest.mark.parametrize("width, tolerance", [(1, None), (7, 30), (64, None), (10_000, 5)])
def test_as_of_join(spark, width, tolerance):
    left, right = moments(300, 1), moments(120, 2, reach=300)
    l_df = spark.createDataFrame(left, "id int, k string, t long").repartition(3)
    r_df = spark.createDataFrame(right, "rid int, k string, rt long").repartition(3)
    got = timejoin.as_of_join(l_df, r_df, ["k"], "t", width, right_time="rt", ties=["rid"], tolerance=tolerance)
    assert got.columns == ["id", "k", "t", "matched"]
    want = []
    for i, k, t in left:
        before = [(rt, rid) for rid, rk, rt in right if None not in (k, t, rk, rt) and rk == k and rt <= t]
        last = max(before, default=None)
        if last and tolerance is not None and t - last[0] > tolerance:
            last = None
        want.append((i, k, t, last and last[1]))
    rows = [(r["id"], r["k"], r["t"], r["matched"] and r["matched"]["rid"]) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_as_of_join_of_empty_tables(spark):
    left = spark.createDataFrame([(1, "a", 5)], "id int, k string, t long")
    right = spark.createDataFrame([("a", 5, 7.0)], "k string, t long, v double")
    some = timejoin.as_of_join(left, right.where("false"), ["k"], "t", 10)
    assert [tuple(r) for r in some.collect()] == [(1, "a", 5, None)]
    assert timejoin.as_of_join(left.where("false"), right, ["k"], "t", 10).isEmpty()
    assert timejoin.as_of_join(left, right, ["k"], "t", 10).first()["matched"]["v"] == 7.0


def test_as_of_join_meets_a_key_in_buckets(spark):
    """All rows have one key: no window holds more than the rows of a bucket, or one row per bucket."""
    left = spark.range(5000).select(F.lit("a").alias("k"), F.col("id").alias("t"))
    right = spark.range(0, 5000, 50).select(F.lit("a").alias("k"), F.col("id").alias("t"))
    got = timejoin.as_of_join(left, right, ["k"], "t", 100)
    assert got.where("matched.t <> t - t % 50").isEmpty() and got.count() == 5000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SortMergeJoin" not in plan


def test_interval_join(spark):
    rng = random.Random(4)
    points = moments(300, 5)
    spans = [(i, k, a, None if a is None or rng.random() < 0.05 else a + rng.choice([-3, 0, 1, 2, 3, 17, 64, 65, 700])) for i, k, a in moments(100, 6)]
    spans += [(900, "a", -(2**40), 2**40)]
    p_df = spark.createDataFrame(points, "id int, k string, t long").repartition(3)
    s_df = spark.createDataFrame(spans, "sid int, k string, a long, b long").repartition(2)
    got = [(r["id"], r["interval"]["sid"]) for r in timejoin.interval_join(p_df, s_df, ["k"], "t", "a", "b").collect()]
    want = [
        (i, s) for i, k, t in points for s, sk, a, b in spans if None not in (k, t, a, b) and k == sk and a <= t < b
    ]
    assert sorted(got) == sorted(want) and len(want) > 200
    assert timejoin.interval_join(p_df, s_df.where("false"), ["k"], "t", "a", "b").isEmpty()


def test_levels(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.randrange(9)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a string, b int, v int")
    got = levels.aggregate_levels(df, ["a", "b"], levels.cube_sets(["a", "b"]), n=F.count(F.lit(1)), v=F.sum("v"))
    want = Counter(), Counter()
    for n in range(3):
        for chosen in combinations(range(2), n):
            for r in rows:
                key = (*(r[i] if i in chosen else None for i in range(2)), ",".join("ab"[i] for i in chosen))
                want[0][key] += 1
                want[1][key] += r[2]
    found = {(r["a"], r["b"], r["level"]): (r["n"], r["v"]) for r in got.collect()}
    assert found == {k: (n, want[1][k]) for k, n in want[0].items()}  # a null of the data is not the null of a level
    assert levels.rollup_sets(["a", "b"]) == [("a", "b"), ("a",), ()]
    assert levels.aggregate_levels(df.where("false"), ["a"], levels.rollup_sets(["a"]), n=F.count(F.lit(1))).isEmpty()
    with pytest.raises(ValueError):
        levels.aggregate_levels(df, ["a"], [("b",)], n=F.count(F.lit(1)))


def test_difference(spark):
    schema = "k string, x double, y int"
    nan = float("nan")
    old = spark.createDataFrame([("a", 1.0, 1), ("b", nan, 2), ("c", None, 3), ("d", 4.0, None), (None, 5.0, 5), ("f", 1.0, 1), ("f", 1.0, 1)], schema)
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", nan), (4, "c", 3.0), (None, "d", None), (6, None, 5.0), (9, "e", 9.0), (1, "f", 1.0)], "y int, k string, x double")
    rows = {r["k"]: r for r in difference.snapshot_difference(old, new, ["k"]).collect()}
    assert {k: (r["change"], r["columns"]) for k, r in rows.items()} == {
        "c": ("changed", ["x", "y"]), "d": ("changed", ["x"]), None: ("changed", ["y"]), "e": ("added", []),
    }
    assert tuple(rows["c"]["before"]) == (None, 3) and tuple(rows["c"]["after"]) == (3.0, 4) and rows["e"]["before"] is None
    every = difference.snapshot_difference(old, new, ["k"], same=True)
    assert Counter(r["change"] for r in every.collect()) == {"changed": 3, "same": 3, "added": 1}
    gone = difference.snapshot_difference(old, new.where("false"), ["k"]).collect()
    assert len(gone) == 6 and {r["change"] for r in gone} == {"removed"}
    with pytest.raises(ValueError):
        difference.snapshot_difference(old, new.drop("y"), ["k"])
    assert difference.common_rows(old, new).count() == 3
    assert sorted(r["k"] or "" for r in difference.missing_rows(old, new).collect()) == ["", "c", "d", "f"]


def test_moments_merge_to_those_of_all_rows(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i % 6, 1e6 + rng.gauss(0, 1), None if rng.random() < 0.3 else rng.gauss(5, 2), 7.0, None) for i in range(3000)]
    df = spark.createDataFrame(rows, "part int, a double, b double, c double, d double").repartition(4)
    cols = ["a", "b", "c", "d"]
    for number in (0, 1, 2, 3, 4, 5, 9, 1):  # an empty batch, and one that is stored twice
        part = incremental.moments(df.where(F.col("part") == number), cols)
        incremental.keep_batch(part, str(tmp_path), number)
    merged = incremental.merge_moments(incremental.kept_batches(part, str(tmp_path)))
    got = {r["feature"]: (r["mean"], r["std"]) for r in incremental.scaler_of(merged).collect()}
    for c, s in scaling.stats_values(scaling.fit_scaler(df, ["a", "b", "d"])).items():
        assert got[c] == pytest.approx((s["mean"], s["std"]), rel=1e-9)
    exact = [r[1] for r in rows]
    mean = math.fsum(exact) / len(exact)
    deviation = math.sqrt(math.fsum((x - mean) ** 2 for x in exact) / (len(exact) - 1))
    assert got["a"] == pytest.approx((mean, deviation), rel=1e-9)  # nothing cancels out
    assert got["c"] == (7.0, 1.0) and got["d"] == (0.0, 1.0)
    assert {r["feature"]: r["n"] for r in merged.collect()}["d"] == 0


def test_sketches_merge_within_their_error(spark, tmp_path):
    df = spark.range(60_000).select((F.col("id") % 5).alias("day"), (F.col("id") % 20_011).alias("u"), F.lit("x").alias("c"), F.lit(None).cast("string").alias("e"))
    for number in range(5):
        part = incremental.distinct_sketches(df.where(F.col("day") == number), ["day"], ["u", "c", "e"])
        incremental.keep_batch(part, str(tmp_path), number)
    kept = incremental.kept_batches(part, str(tmp_path))
    got = {r["column_name"]: r["estimate"] for r in incremental.merge_sketches(kept, []).collect()}
    assert abs(got["u"] - 20_011) <= 3 * incremental.RELATIVE_ERROR * 20_011 and got["c"] == 1 and got["e"] == 0
    whole = incremental.distinct_sketches(df, ["c"], ["u"]).withColumn("n", F.hll_sketch_estimate("sketch")).first()
    assert whole["n"] == pytest.approx(got["u"], rel=0.02)
    assert kept.agg(F.max(F.octet_length("sketch"))).first()[0] < 10_000
