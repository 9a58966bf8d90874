import math

from pyspark.sql import functions as F

from pulseframe import fixed
from pulseframe.operators import clean, features, profile

SCHEMA = "citizen_id string, average_heart_beat_rate int, o2_content double, sleep_time double, calories_burned int, label int"
ROWS = [
    ("C001", 40, 0.97, 7.0, 500, 0),
    ("C002", 200, 0.80, 1.0, 500, 1),
    ("C003", 39, 0.97, 7.0, 500, 0),
    ("C004", 201, 0.97, 7.0, 500, 0),
    ("C005", 80, None, 7.0, 500, 0),
    ("C006", 80, float("nan"), 7.0, 500, 0),
    ("C007", 80, 0.97, 7.0, 500, None),
    ("C008", 80, 1.2, 15.0, 500, 0),
    ("C009", 80, 1.0, 14.0, 500, 0),
    (None, 80, 1.1, 14.5, 500, 0),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_clean_chain(spark):
    got = rows_of(clean.clean(frame(spark)))
    # an absent citizen does not matter: the column goes first; three rows clip to the same values
    assert got == [(40, 0.97, 7.0, 500, 0), (80, 1.0, 14.0, 500, 0), (200, 0.85, 2.0, 500, 1)]


def test_drop_incomplete_equals_dropna(spark):
    df = frame(spark)
    assert rows_of(clean.drop_incomplete(df)) == rows_of(df.dropna())
    got = clean.drop_incomplete(df, ["label"]).count()
    assert got == len(ROWS) - 1


def test_null_filter_reaches_the_scan(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "t"))
    plan = clean.keep_range(clean.drop_incomplete(spark.read.parquet(str(tmp_path / "t"))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(o2_content)" in text and "GreaterThanOrEqual(average_heart_beat_rate,40)" in text


def test_keep_range_is_inclusive(spark):
    assert rows_of(clean.keep_range(frame(spark)).select("average_heart_beat_rate").distinct()) == [(40,), (80,), (200,)]


def test_dedupe_with_keys_keeps_smallest(spark):
    df = spark.createDataFrame([("a", 3, 1.0), ("a", 2, 9.0), ("b", 1, None), ("b", 1, 5.0)], "k string, x int, y double")
    want = [("a", 2, 9.0), ("b", 1, None)]
    for partitions in (1, 4):
        assert rows_of(clean.dedupe(df.repartition(partitions), ["k"])) == want


def test_dedupe_merges_copies_before_the_shuffle(spark):
    """A row that makes up a third of the input crosses the shuffle once per task."""
    rows = spark.range(0, 30000, 1, 4).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("x"))
    plan = clean.dedupe(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
    assert clean.dedupe(rows).count() == 20001


def test_coerce(spark):
    df = spark.createDataFrame([("C1", "72.9", "0.9", "x", "", "1", "kept")], "citizen_id string, average_heart_beat_rate string, o2_content string, sleep_time string, calories_burned string, label string, other string")
    got = clean.coerce(df)
    assert got.first() == ("C1", 72, 0.9, None, None, 1, "kept")
    assert dict(got.dtypes)["label"] == "int" and dict(got.dtypes)["o2_content"] == "double"


def test_categories_at_bounds(spark):
    rows = [
        ("a", 59, 0.9299, 4.99, 1, 0), ("b", 60, 0.93, 5.0, 1, 0), ("c", 100, 0.9499, 6.99, 1, 0),
        ("d", 101, 0.95, 7.0, 1, 0), ("e", 75, 1.0, 9.0, 1, 0), ("f", None, None, 9.01, 1, 0),
    ]
    got = rows_of(features.add_categories(frame(spark, rows)).select("citizen_id", *fixed.CATEGORIES))
    assert got == [
        ("a", "Bradycardia", "Hypoxia_Risk", "Insufficient"),
        ("b", "Normal", "Borderline", "Below_Recommended"),
        ("c", "Normal", "Borderline", "Below_Recommended"),
        ("d", "Tachycardia", "Normal", "Optimal"),
        ("e", "Normal", "Normal", "Optimal"),
        ("f", "Tachycardia", "Normal", "Extended"),
    ]


def test_label_rule_ignores_unknown_values(spark):
    rows = [("a", 100, 0.95, 5.0, 1, 0), ("b", 101, None, None, 1, 0), ("c", None, None, 6.0, 1, 0), ("d", 80, 0.94, 8.0, 1, 0)]
    got = rows_of(features.risk_label(frame(spark, rows)).select("citizen_id", "label"))
    assert got == [("a", 0), ("b", 1), ("c", 0), ("d", 1)]


def test_engineered_numbers(spark):
    got = features.engineer(frame(spark, [("a", 90, 0.9, 6.0, 450, 0)])).first()
    assert got["calorie_efficiency"] == 450 / 90
    assert got["composite_risk_score"] == abs(90 - 75) / 75.0 * 0.3 + (1.0 - 0.9) / 0.1 * 0.4 + abs(6.0 - 8.0) / 8.0 * 0.3
    assert got["hr_sleep_interaction"] == 90 * (10.0 - 6.0) / 100.0


def test_audit(spark):
    got = {r["column_name"]: r for r in profile.audit(frame(spark)).collect()}
    rate = got["average_heart_beat_rate"]
    assert (rate["n_null"], rate["n_total"], rate["min"], rate["max"]) == (0, 10, 39.0, 201.0)
    assert got["o2_content"]["n_null"] == 1
    empty = profile.audit(frame(spark, [])).collect()
    assert len(empty) == 4 and all(r["n_total"] == 0 and r["mean"] is None and r["min"] is None for r in empty)


def test_funnel_and_profile_agree(spark):
    df = frame(spark)
    got = profile.funnel(df).first().asDict()
    assert got == {"raw": 10, "after_nulls": 7, "after_range": 5, "after_clean": 3, "removed": 7}
    seen = profile.profile(df).first()
    assert (seen["raw"], seen["after_nulls"], seen["after_range"], seen["n_anomalies"]) == (10, 7, 5, 2)
    assert profile.funnel(frame(spark, [])).first().asDict() == dict.fromkeys(got, 0)


def test_anomalies_and_counts(spark):
    assert profile.count_anomalies(frame(spark)).first()[0] == 2
    counts = {r["label"]: r["count"] for r in profile.value_counts(frame(spark)).collect()}
    assert counts == {0: 8, 1: 1, None: 1}


def test_summary(spark):
    df = spark.createDataFrame([("a", "healthy"), ("a", "unhealthy"), ("b", "healthy"), ("c", None)], "citizen_id string, classification string")
    assert profile.summary(df, distinct_citizens=True).first() == (4, 2, 1, 3)
    assert profile.summary(df.limit(0)).first() == (0, 0, 0)


def test_nan_rate_is_not_counted_as_complete(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in clean.drop_incomplete(df).collect()] == [1.0]
    assert math.isnan(df.first()[0])
