import math
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pulseframe import fixed
from pulseframe.operators import model
from pulseframe.operators.scaling import fit_scaler, stats_values
from pulseframe.plans import etl, scoring, training
from pulseframe.sinks import files
from pulseframe.sources import labelled_csv, payload, record_log, synthetic

AS_OF = datetime(2024, 2, 1, 12, 30, 45, 678901, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("etl")
    rows = synthetic.synthetic(spark, 3000, partitions=4)
    bad = spark.createDataFrame(
        [("C9", "x", "0.9", "7", "500", "0"), ("C8", "30", "0.9", "7", "500", "0"), ("C7", "80", "", "7", "500", "1")],
        list(fixed.TRAINING_CSV),
    )
    copies = rows.limit(100)
    text = rows.unionByName(copies).select([F.col(c).cast("string") for c in rows.columns]).unionByName(bad)
    text.write.csv(f"{root}/source", header=True)
    result = etl.run_etl(spark, f"{root}/source", f"{root}/out", AS_OF, table="processed_vitals")
    return str(root), result


def test_etl_counts(prepared):
    _, r = prepared
    assert r["raw"] == 3103 and r["after_nulls"] == 3101 and r["after_range"] == 3100 and r["anomalies"] == 1
    assert r["train"] + r["validation"] == r["after_clean"] <= 3000
    assert r["removed"] == r["raw"] - r["after_clean"]
    nulls = {a["column_name"]: a["n_null"] for a in r["audit"]}
    assert nulls == {"average_heart_beat_rate": 1, "o2_content": 1, "sleep_time": 0, "calories_burned": 0}


def test_etl_outputs(spark, prepared):
    root, r = prepared
    processed = spark.read.parquet(f"{root}/out/processed")
    assert processed.columns == [*list(fixed.TRAINING_CSV)[1:], *fixed.CATEGORIES, *fixed.ENGINEERED, *fixed.SCALED_FEATURES]
    assert processed.count() == r["after_clean"]
    train = labelled_csv.read_split_csv(spark, f"{root}/out/train/train.csv")
    validation = labelled_csv.read_split_csv(spark, f"{root}/out/validation/validation.csv")
    assert (train.count(), validation.count()) == (r["train"], r["validation"])
    both = train.unionByName(validation)
    want = processed.select(fixed.LABEL, *fixed.SCALED_FEATURES)
    assert both.exceptAll(want).isEmpty() and want.exceptAll(both).isEmpty()
    for label, n in Counter(x["label"] for x in processed.select("label").collect()).items():
        assert train.where(F.col("label") == label).count() == math.floor(n * 0.8)
    shown = spark.read.json(f"{root}/out/reports/sample").collect()
    order = lambda r: tuple(r[c] for c in etl.ROW_KEY)
    assert sorted(map(order, shown)) == sorted(map(order, processed.collect()))[: etl.SAMPLE_ROWS]
    assert {c for r in shown for c in r.asDict()} == {*etl.ROW_KEY, *fixed.CATEGORIES, *fixed.ENGINEERED}
    document = files.read_document(spark, f"{root}/out/config/normalization_stats.json")
    assert document["total_processed"] == r["after_clean"] and document["features"] == fixed.NUMERIC_FEATURES
    shown = {x["key"]: x["value"] for x in spark.sql("SHOW TBLPROPERTIES processed_vitals").collect()}
    assert shown["recordCount"] == str(r["after_clean"]) and shown["featureCount"] == "7"


def test_etl_rerun_and_train_statistics(spark, prepared, tmp_path):
    root, r = prepared
    again = etl.run_etl(spark, f"{root}/source", str(tmp_path), AS_OF)
    assert (again["train"], again["after_clean"]) == (r["train"], r["after_clean"])
    fitted = etl.run_etl(spark, f"{root}/source", str(tmp_path), AS_OF, split="random", fit_on="train")
    train = spark.read.parquet(f"{tmp_path}/processed")
    assert fitted["train"] + fitted["validation"] == train.count()
    assert fitted["stats"]["o2_content"] != r["stats"]["o2_content"]
    scaled = labelled_csv.read_split_csv(spark, f"{tmp_path}/train/train.csv")
    assert abs(scaled.agg(F.avg("o2_content_scaled")).first()[0]) < 1e-9
    with pytest.raises(ValueError):
        etl.run_etl(spark, f"{root}/source", str(tmp_path), AS_OF, split="other")


@pytest.fixture(scope="module")
def fitted(spark, prepared):
    root, _ = prepared
    return training.run_training(spark, f"{root}/out", f"{root}/models", 3, rounds=12), root


def test_training_quality(fitted):
    result, _ = fitted
    assert 1 <= result["rounds"] <= 12 and result["log_loss"] < 0.35
    wrong = sum(n for (label, cls), n in result["confusion"].items() if (label == 1) != (cls == "unhealthy"))
    assert wrong / result["validation"] < 0.05 and sum(result["confusion"].values()) == result["validation"]


def test_model_round_trip(spark, fitted):
    result, root = fitted
    loaded, stats = model.load_model(spark, f"{root}/models", 3)
    assert result["path"].endswith("version=3") and set(stats) == set(fixed.NUMERIC_FEATURES)
    assert model.boosted_rounds(loaded) == result["rounds"]
    model.save_model(loaded, f"{root}/models", 4)
    assert model.load_model(spark, f"{root}/models", 4)[1] is None


def test_best_round():
    assert model.best_round([3, 2, 1], 10) == 3
    assert model.best_round([3, 1, 2, 2, 0], 2) == 2
    assert model.best_round([3, 1, 2, 0], 3) == 4
    assert model.best_round([1.0], 10) == 1


def test_unknown_training_parameter(spark):
    with pytest.raises(ValueError):
        model.train(spark.range(1), rounds=1, depth=3)


def test_early_stop_keeps_the_first_trees_of_one_fit(spark, monkeypatch):
    """Labels are noise: validation loss soon rises and the model keeps the best rounds."""
    fits = []
    real = model.GBTClassifier.fit
    monkeypatch.setattr(model.GBTClassifier, "fit", lambda self, data: fits.append(1) or real(self, data))
    from pulseframe.functions import as_fraction, hash_long

    df = spark.range(0, 600, 1, 2).select(
        as_fraction(hash_long([F.col("id")], "x")).alias("x"),
        (as_fraction(hash_long([F.col("id")], "y")) < 0.5).cast("int").alias("label"),
        "id",
    )
    fit = model.train(
        df.where("id < 300"), df.where("id >= 300"), ["x"], "label", "level",
        rounds=20, early_stopping_rounds=3, min_data_in_leaf=1,
    )
    assert len(fits) == 1
    kept = model.boosted_rounds(fit)
    full = model.train(df.where("id < 300"), None, ["x"], growth="level", rounds=20, min_data_in_leaf=1)
    shorter = model.train(df.where("id < 300"), None, ["x"], growth="level", rounds=kept, min_data_in_leaf=1)
    both = model.predict(model.predict(df, fit, "p"), shorter, "q")
    assert both.where("p <> q").isEmpty()
    assert kept < 20 and model.boosted_rounds(full) == 20

    def splits(fitted, rounds):
        return [t.toDebugString.split("\n", 1)[1] for t in fitted.stages[-1].trees[:rounds]]

    assert splits(fit, kept) == splits(full, kept)


def raw_rows(spark):
    return spark.createDataFrame(
        [
            ("a", 1, 80.0, 0.98, 7.5, 500), ("b", 1, 150.0, 0.98, 7.5, 500), ("c", 1, 80.0, None, 7.5, 500),
            ("d", 1, 80.0, 0.98, None, None), (None, 1, 80.0, 0.98, 7.5, 500), ("e", 1, 80.0, 0.90, 7.5, 500),
        ],
        "citizen_id string, timestamp bigint, average_heart_beat_rate double, o2_content double, sleep_time double, calories_burned int",
    )


def test_score(spark, fitted):
    _, root = fitted
    trees, stats = model.load_model(spark, f"{root}/models", 3)
    rows = {r["citizen_id"]: r for r in model.score(raw_rows(spark), trees, stats, AS_OF).collect()}
    classes = {c: r["classification"] for c, r in rows.items()}
    assert classes == {"a": "healthy", "b": "unhealthy", "e": "unhealthy"}
    assert {r["inference_timestamp"] for r in rows.values()} == {"2024-02-01T12:30:45.678Z"}
    everything = model.score_all(raw_rows(spark), trees, stats, AS_OF)
    failed = {r["citizen_id"]: r["reason"] for r in everything.where("outcome = 'failed'").collect()}
    assert failed == {None: "no citizen", "c": "missing reading", "d": "missing reading"}
    # on demand a missing value counts as 0: no oxygen reading or no sleep is unhealthy
    rows = {r["citizen_id"]: r for r in model.score(raw_rows(spark), trees, stats, AS_OF, missing_as_zero=True).collect()}
    assert rows["c"]["classification"] == rows["d"]["classification"] == "unhealthy"
    assert rows["c"]["o2_content"] is None and rows["d"]["calories_burned"] is None  # stored as received


def test_score_equals_training_path(spark, prepared, fitted):
    """Scoring a training record from its raw values gives the probability of its stored
    scaled features."""
    root, result = prepared
    trees, stats = model.load_model(spark, f"{root}/models", 3)
    processed = spark.read.parquet(f"{root}/out/processed")
    direct = model.predict(processed, trees, "p")
    raw = processed.select(F.lit("x").alias("citizen_id"), F.lit(1).cast("bigint").alias("timestamp"), *fixed.VITALS, "label")
    through = model.predict(model.prepare(raw, stats), trees, "q").select("_record.*", "q")
    both = direct.join(through, [*fixed.VITALS, "label"])
    assert both.count() == processed.count() and both.where("p <> q").isEmpty()


def append(spark, log, number, rows):
    df = spark.createDataFrame(rows, "seq bigint, citizen_id string, timestamp bigint, average_heart_beat_rate int")
    body = F.to_json(F.struct("citizen_id", "timestamp", "average_heart_beat_rate", F.lit(0.98).alias("o2_content"), F.lit(7.5).alias("sleep_time"), F.lit(500).alias("calories_burned")))
    messages = df.select("seq", F.base64(body.cast("binary")).alias("data"))
    record_log.append_batch(payload.route(messages), log, number)


def keys(df):
    return sorted((r["citizen_id"], r["timestamp"]) for r in df.collect())


def test_scoring_runs(spark, fitted, tmp_path):
    _, root = fitted
    trees, stats = model.load_model(spark, f"{root}/models", 3)
    log, analytics, results = (str(tmp_path / n) for n in ("log", "analytics", "results"))
    later = AS_OF + timedelta(minutes=15)
    append(spark, log, 0, [(1, "a", 1, 80), (2, "b", 1, 150), (3, "x", 1, 20)])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scoring.dashboard(spark, analytics)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scoring.run_scoring(spark, f"{log}-mistyped", trees, stats, analytics, AS_OF)
    first = scoring.run_scoring(spark, log, trees, stats, analytics, AS_OF, only_new=True, results=results)
    append(spark, log, 1, [(1, "c", 1, 80)])
    second = scoring.run_scoring(spark, log, trees, stats, analytics, later, only_new=True)
    assert keys(scoring.analytics_of(spark, analytics, first)) == [("a", 1), ("b", 1)]
    assert keys(scoring.analytics_of(spark, analytics, second)) == [("c", 1)]
    # the second run repeated, as after a lost driver, changes nothing
    scoring.run_scoring(spark, log, trees, stats, analytics, later, only_new=True)
    assert keys(scoring.read_analytics(spark, analytics)) == [("a", 1), ("b", 1), ("c", 1)]
    third = scoring.run_scoring(spark, log, trees, stats, analytics, later + timedelta(minutes=15))
    assert keys(scoring.analytics_of(spark, analytics, third)) == [("a", 1), ("b", 1), ("c", 1)]

    exported = spark.read.csv(f"{results}/results_20240201123045_{first}", header=True)
    assert exported.columns == fixed.ANALYTICS_COLUMNS and exported.count() == 2
    shown = scoring.dashboard(spark, analytics)
    assert shown["summary"].first() == (6, 4, 2)
    assert shown["rows"].count() == 6 and shown["latest"].count() == 3 and shown["json"].count() == 6


def test_streamed_scoring(spark, fitted, tmp_path):
    _, root = fitted
    trees, stats = model.load_model(spark, f"{root}/models", 3)
    log, analytics, state = (str(tmp_path / n) for n in ("log", "analytics", "state"))
    for number, rows in enumerate([[(1, "a", 1, 80), (2, "a", 1, 90), (3, "x", 1, 20)], [(1, "b", 1, 150)]]):
        append(spark, log, number, rows)
        query = scoring.start_scoring(spark, log, trees, stats, analytics, state, interval=None, clock=lambda: AS_OF)
        query.awaitTermination()
        assert query.exception() is None
    got = {(r["run"], r["citizen_id"], r["classification"]) for r in scoring.read_analytics(spark, analytics).collect()}
    assert got == {("0.0", "a", "healthy"), ("0.1", "b", "unhealthy")}
    # a replayed batch, and another checkpoint that starts from the beginning, double nothing
    append(spark, log, 0, [(1, "a", 1, 80), (2, "a", 1, 90), (3, "x", 1, 20)])
    for checkpoint in (state, str(tmp_path / "second")):
        scoring.start_scoring(spark, log, trees, stats, analytics, checkpoint, None, lambda: AS_OF).awaitTermination()
    assert scoring.read_runs(spark, analytics).count() == 2
    assert scoring.dashboard(spark, analytics)["summary"].first() == (2, 1, 1)
    # a correction is scored again
    append(spark, log, 2, [(9, "a", 1, 150)])
    scoring.start_scoring(spark, log, trees, stats, analytics, state, None, lambda: AS_OF).awaitTermination()
    newest = scoring.newest_classes(scoring.read_analytics(spark, analytics))
    assert {r["citizen_id"]: r["classification"] for r in newest.collect()} == {"a": "unhealthy", "b": "unhealthy"}


def test_a_corrected_record_is_pending_again(spark, fitted, tmp_path):
    _, root = fitted
    trees, stats = model.load_model(spark, f"{root}/models", 3)
    log, analytics = str(tmp_path / "log"), str(tmp_path / "analytics")
    append(spark, log, 0, [(1, "a", 1, 80), (2, "b", 1, 80)])
    scoring.run_scoring(spark, log, trees, stats, analytics, AS_OF, only_new=True)
    append(spark, log, 1, [(1, "a", 1, 150)])
    second = scoring.run_scoring(spark, log, trees, stats, analytics, AS_OF + timedelta(milliseconds=300), only_new=True, after=0)
    assert keys(scoring.analytics_of(spark, analytics, second)) == [("a", 1)]
    newest = {r["citizen_id"]: r["classification"] for r in scoring.newest_classes(scoring.read_analytics(spark, analytics)).collect()}
    assert newest == {"a": "unhealthy", "b": "healthy"}
    # runs within one second keep apart
    assert scoring.read_runs(spark, analytics).select("run").distinct().count() == 2


def test_results_of_one_second_stay_apart(spark, fitted, tmp_path):
    _, root = fitted
    trees, stats = model.load_model(spark, f"{root}/models", 3)
    log, analytics, results = (str(tmp_path / n) for n in ("log", "analytics", "results"))
    append(spark, log, 0, [(1, "a", 1, 80)])
    runs = [scoring.run_scoring(spark, log, trees, stats, analytics, AS_OF + timedelta(milliseconds=m), results=results) for m in (0, 200, 0)]
    names = sorted(p.name for p in (tmp_path / "results").iterdir())
    assert names == sorted(f"results_20240201123045_{r}" for r in set(runs)) and len(names) == 2


def test_a_backlog_is_scored_in_steps(spark, fitted, tmp_path):
    _, root = fitted
    trees, stats = model.load_model(spark, f"{root}/models", 3)
    log, analytics, state = (str(tmp_path / n) for n in ("log", "analytics", "state"))
    for number in range(5):
        append(spark, log, number, [(1, f"c{number}", 1, 80)])
    query = scoring.start_scoring(spark, log, trees, stats, analytics, state, None, lambda: AS_OF, files_per_trigger=2)
    query.awaitTermination()
    assert sum(p.numInputRows > 0 for p in query.recentProgress) >= 3
    assert keys(scoring.read_runs(spark, analytics)) == [(f"c{n}", 1) for n in range(5)]


def test_csv_columns_by_name(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = spark.createDataFrame([("1", "80", "0.9", "7", "500", "a", "x")], ["label", *fixed.VITALS, "citizen_id", "note"])
    rows.write.csv(path, header=True)
    assert labelled_csv.read_training_csv(spark, path).first() == ("a", "80", "0.9", "7", "500", "1")
    rows.drop("label").write.csv(f"{path}2", header=True)
    with pytest.raises(ValueError, match="label"):
        labelled_csv.read_training_csv(spark, f"{path}2")


def test_a_moved_table_reads_its_new_folder(spark, tmp_path):
    for n in (3, 7):
        spark.range(n).write.parquet(str(tmp_path / f"t{n}"))
        assert files.register_table(spark, "moved_table", str(tmp_path / f"t{n}"), {"recordCount": str(n)})
        assert spark.table("moved_table").count() == n


def test_feature_vector_defaults(spark):
    rows = model.feature_vector(raw_rows(spark)).where("citizen_id = 'd'").first()
    assert rows["features"] == [80.0, 0.98, 0.0, 0.0]


def test_statistics_of_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    assert stats_values(fit_scaler(empty, ["x"])) == {"x": {"mean": 0.0, "std": 1.0}}
