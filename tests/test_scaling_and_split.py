import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pulseframe.operators import scaling, split


def test_scale_centres_and_normalises(spark):
    df = spark.range(1000).select((F.col("id") * 1.7 + 3).alias("x"), F.sin("id").alias("y"))
    stats = scaling.fit_scaler(df, ["x", "y"])
    scaled = scaling.scale(df, stats)
    for c in ("x_scaled", "y_scaled"):
        mean, std = scaled.agg(F.avg(c), F.stddev_samp(c)).first()
        assert abs(mean) < 1e-9 and abs(std - 1) < 1e-9
    saved = scaling.scale(df, scaling.stats_values(stats))
    worst = scaled.join(saved, ["x", "y"]).count()
    assert worst == 1000
    assert scaled.exceptAll(saved).isEmpty()


def test_degenerate_statistics(spark):
    df = spark.createDataFrame([(5.0, None)], "x double, y double")
    assert scaling.stats_values(scaling.fit_scaler(df, ["x", "y"])) == {
        "x": {"mean": 5.0, "std": 1.0},
        "y": {"mean": 0.0, "std": 1.0},
    }
    constant = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert scaling.stats_values(scaling.fit_scaler(constant, ["x"]))["x"]["std"] == 1.0
    assert [r["feature"] for r in scaling.stats_table(scaling.fit_scaler(df, ["x", "y"])).collect()] == ["x", "y"]


def test_lazy_scaling_reads_the_statistics_once(spark, tmp_path):
    spark.range(100).select(*[(F.col("id") * k).alias(f"c{k}") for k in range(1, 8)]).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    cols = [f"c{k}" for k in range(1, 8)]
    plan = scaling.scale(df, scaling.fit_scaler(df, cols))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("FileScan") == 2  # the rows and one pass for all statistics


def sides(df):
    return {r["id"]: r["split"] for r in df.select("id", "split").collect()}


def test_random_split_is_stable_and_near_share(spark):
    one = sides(split.random_split(spark.range(0, 5000, 1, 1), "id"))
    many = sides(split.random_split(spark.range(0, 5000, 1, 7).repartition(5), "id"))
    assert one == many and set(one.values()) == {"train", "validation"}
    share = sum(v == "train" for v in one.values()) / 5000
    assert abs(share - 0.8) < 0.02
    assert sides(split.random_split(spark.range(5000), "id", seed=1)) != one


def expected_sides(rows, share, seed=42):
    """Brute force: per label order keys by hash; keys train while fewer rows than
    floor(share * n) come before them."""
    digest = lambda key: hashlib.md5(f"{seed}:{key}".encode()).hexdigest()
    by_label = defaultdict(Counter)
    for key, label in rows:
        by_label[label][digest(key)] += 1
    train = set()
    for label, hashes in by_label.items():
        wanted, before = math.floor(sum(hashes.values()) * share), 0
        for h in sorted(hashes):
            if before < wanted:
                train.add((label, h))
            before += hashes[h]
    return Counter((k, lab, "train" if (lab, digest(k)) in train else "validation") for k, lab in rows)


def split_rows(spark, rows, share, partitions=4):
    df = spark.createDataFrame(rows, "id bigint, label int").repartition(partitions)
    return Counter(tuple(r) for r in split.stratified_split(df, "id", share=share).collect())


@pytest.mark.parametrize("threshold", ["10m", "-1"])  # with and without a broadcast of the bounds
def test_stratified_split_matches_brute_force(spark, monkeypatch, threshold):
    monkeypatch.setattr(split, "SALTS", 8)
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, threshold)
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 0, 0, 1, None])) for i in range(3000)]
    rows += [(7_000_000, 0)] * 1500  # one key holds a third of the rows
    try:
        for share in (0.8, 0.0, 1.0):
            assert split_rows(spark, rows, share) == expected_sides(rows, share)
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)


def test_stratified_split_with_coarse_prefix(spark, monkeypatch):
    """Many keys per prefix, so the bound lies inside a crowded prefix."""
    monkeypatch.setattr(split, "PREFIX_BITS", 4)
    rows = [(i, i % 3) for i in range(2000)]
    assert split_rows(spark, rows, 0.73) == expected_sides(rows, 0.73)


@settings(max_examples=8, deadline=None)
@given(
    rows=st.lists(st.tuples(st.integers(0, 60), st.integers(0, 2)), min_size=1, max_size=80),
    share=st.sampled_from([0.5, 0.8, 0.33]),
    partitions=st.integers(1, 6),
)
def test_stratified_split_property(spark, rows, share, partitions):
    assert split_rows(spark, rows, share, partitions) == expected_sides(rows, share)


def test_stratified_counts_are_exact(spark):
    df = spark.range(10_001).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    placed = split.stratified_split(df, "id")
    counts = {(r["label"], r["split"]): r["count"] for r in placed.groupBy("label", "split").count().collect()}
    assert counts[0, "train"] == math.floor(9000 * 0.8) and counts[1, "train"] == math.floor(1001 * 0.8)
    train, validation = split.train_validation(placed)
    assert train.count() + validation.count() == 10_001 and train.columns == ["id", "label"]


def test_stratified_split_is_lazy_and_broadcasts_measured_bounds(spark):
    df = spark.range(1000).withColumn("label", (F.col("id") % 2).cast("int"))
    group = "lazy-split"
    spark.sparkContext.setJobGroup(group, "")
    placed = split.stratified_split(df, "id")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("other", "")
    placed.collect()
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan.split("Initial Plan")[0]


def test_copies_of_a_row_meet_their_bound_in_many_parts(spark):
    df = spark.createDataFrame([(7, 0)] * 10_000 + [(i, 0) for i in range(100, 20_100)], "id bigint, label int")
    salts = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(split.SALTS)))
    most = salts.where("id = 7").groupBy("_salt").count().agg(F.max("count")).first()[0]
    assert most <= 2 * 10_000 / split.SALTS


def test_split_without_key_uses_whole_row(spark):
    df = spark.createDataFrame([(i, float(i % 7), None) for i in range(300)], "id bigint, x double, y string")
    a, b = sides(split.random_split(df)), sides(split.random_split(df.repartition(3)))
    assert a == b and len(set(a.values())) == 2
