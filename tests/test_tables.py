import json
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pulseframe import fixed
from pulseframe.operators import keyed, nested, report
from pulseframe.sinks import files
from pulseframe.sources import labelled_csv, synthetic
from pulseframe.operators.clean import coerce

AS_OF = datetime(2024, 2, 1, 12, 30, 45, 678901, tzinfo=timezone.utc)


def test_decimals_at_any_depth(spark):
    schema = (
        "a decimal(10,2), b array<decimal(4,1)>, c map<string, struct<x: decimal(3,2), y: string>>, "
        "d struct<e: array<map<string, decimal(5,3)>>>, n int"
    )
    row = (
        Decimal("1.25"), [Decimal("0.5"), None], {"k": (Decimal("0.75"), "s")}, ([{"m": Decimal("1.125")}],), 7,
    )
    got = nested.decimals_to_double(spark.createDataFrame([row, (None,) * 5], schema))
    assert "decimal" not in got.schema.simpleString()
    first = got.collect()[0]
    assert first["a"] == 1.25 and first["b"] == [0.5, None] and first["c"]["k"]["x"] == 0.75
    assert first["c"]["k"]["y"] == "s" and first["d"]["e"][0]["m"] == 1.125 and first["n"] == 7
    assert got.collect()[1]["a"] is None


def test_upsert_and_pending(spark):
    schema = "citizen_id string, timestamp bigint, v int, seq bigint"
    table = spark.createDataFrame([("a", 1, 10, 1), ("a", 2, 20, 2)], schema)
    batch = spark.createDataFrame([("a", 1, 11, 3), ("b", 1, 30, 4), ("b", 1, 31, 5)], schema)
    got = sorted(tuple(r) for r in keyed.upsert(table, batch).collect())
    assert got == [("a", 1, 11, 3), ("a", 2, 20, 2), ("b", 1, 31, 5)]
    left = keyed.pending(keyed.upsert(table, batch), table)
    assert [tuple(r) for r in left.select("citizen_id", "timestamp").collect()] == [("b", 1)]


def test_defaults(spark):
    df = spark.createDataFrame([(None, ""), (1.0, None), (2.0, "x")], "n double, s string")
    got = report.with_defaults(df, {"n": 0, "s": "unknown"}).collect()
    assert [tuple(r) for r in got] == [(0.0, "unknown"), (1.0, "unknown"), (2.0, "x")]


ANALYTICS = (
    "citizen_id string, timestamp bigint, average_heart_beat_rate double, o2_content double, "
    "sleep_time double, calories_burned int, classification string, inference_timestamp string"
)


def analytics(spark):
    return spark.createDataFrame(
        [
            ("C001", 1, 80.0, 0.9525, 7.25, 400, "healthy", "2024-02-01T12:30:45.678Z"),
            (None, 2, None, None, None, None, "", None),
        ],
        ANALYTICS,
    )


def test_report_rows(spark):
    got = [tuple(r) for r in report.report_rows(analytics(spark)).collect()]
    assert got == [
        ("C001", "80 bpm", "95.3%", "7.25h", "400 kcal", "healthy", "2024-02-01T12:30:45.678Z"),
        ("", "- bpm", "-", "-h", "- kcal", "unknown", "-"),
    ]


def test_json_records_keep_nulls(spark):
    got = [json.loads(r[0]) for r in report.json_records(analytics(spark)).collect()]
    assert got[0]["o2_content"] == 0.9525 and got[1]["o2_content"] is None and len(got[1]) == 8


def test_preview_is_a_top_n(spark):
    df = spark.range(100).withColumn("x", 100 - F.col("id"))
    top = report.preview(df, ["x"], 3, ["x"])
    assert [r["x"] for r in top.collect()] == [1, 2, 3]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_export_csv(spark, tmp_path):
    path = files.export_csv(analytics(spark).coalesce(1), str(tmp_path), AS_OF)
    assert path.endswith("results_20240201123045")
    back = spark.read.schema(ANALYTICS).csv(path, header=True)
    assert back.where("citizen_id = 'C001'").first()["calories_burned"] == 400 and back.count() == 2
    assert files.export_csv(analytics(spark).limit(0), str(tmp_path / "none"), AS_OF) is None
    assert not (tmp_path / "none").exists()


def test_export_json(spark, tmp_path):
    files.export_json(analytics(spark), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).count() == 2


def test_training_csv_round_trip(spark, tmp_path):
    row = {c: float(i) / 3 for i, c in enumerate(fixed.SCALED_FEATURES)}
    df = spark.createDataFrame([{**row, "label": 1}]).select(*fixed.SCALED_FEATURES, F.col("label").cast("int"))
    files.write_training_csv(df, str(tmp_path / "t"))
    text = spark.read.text(str(tmp_path / "t")).first()[0]
    assert text.startswith("1,0.0,0.333")
    assert labelled_csv.read_split_csv(spark, str(tmp_path / "t")).first() == (1, *row.values())


def test_labelled_csv_with_bad_cells(spark, tmp_path):
    (tmp_path / "x.csv").write_text(
        "citizen_id,average_heart_beat_rate,o2_content,sleep_time,calories_burned,label\n"
        "C001,72.5,0.97,7,500,0\nC002,bad,,7.5,1e3,1\n"
    )
    got = sorted(tuple(r) for r in coerce(labelled_csv.read_training_csv(spark, str(tmp_path / "x.csv"))).collect())
    assert got == [("C001", 72, 0.97, 7.0, 500, 0), ("C002", None, None, 7.5, None, 1)]


def test_statistics_document(spark, tmp_path):
    stats = {"x": {"mean": 1 / 3, "std": 2 / 3}}
    document = files.stats_document(stats, 8, 2, 10, AS_OF)
    files.write_document(spark, document, str(tmp_path / "s"))
    back = files.read_document(spark, str(tmp_path / "s"))
    assert back["stats"]["x"] == {"mean": 0.333333, "std": 0.666667} and back["features"] == ["x"]
    assert (back["train_count"], back["val_count"], back["total_processed"]) == (8, 2, 10)
    assert files.stats_document(stats, 8, 2, 10, AS_OF, None)["stats"]["x"]["mean"] == 1 / 3


def test_register_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    properties = files.table_properties(3, 2, 1, 7, AS_OF, "in's.csv")
    assert files.register_table(spark, "registered", path, properties)
    assert files.register_table(spark, "registered", path, {**properties, "recordCount": "4"})
    shown = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES registered").collect()}
    assert shown["recordCount"] == "4" and shown["sourceKey"] == "in's.csv" and spark.table("registered").count() == 3
    assert files.register_table(spark, "no_such_db.t", path, properties) is False  # reported, not raised
    spark.sql("DROP TABLE registered")


def test_synthetic_data(spark):
    df = synthetic.synthetic(spark, 20_000, partitions=3)
    again = synthetic.synthetic(spark, 20_000, partitions=8)
    assert df.exceptAll(again).isEmpty()
    assert dict(df.dtypes) == fixed.TRAINING_CSV
    s = df.agg(
        F.count("*").alias("n"), F.avg("average_heart_beat_rate").alias("hr"), F.stddev("average_heart_beat_rate").alias("hr_sd"),
        F.avg("sleep_time").alias("sleep"), F.min("o2_content").alias("o2_low"), F.max("o2_content").alias("o2_high"),
        F.min("calories_burned").alias("cal_low"), F.max("calories_burned").alias("cal_high"), F.avg("label").alias("sick"),
    ).first()
    assert s["n"] == 20_000 and abs(s["hr"] - 74.5) < 0.5 and abs(s["hr_sd"] - 15) < 0.5 and abs(s["sleep"] - 7) < 0.1
    assert s["o2_low"] == 0.92 and s["o2_high"] == 1.0 and s["cal_low"] == 200 and s["cal_high"] == 900
    # P(hr > 100 or o2 < .95 or sleep < 5) for the three independent normals
    assert abs(s["sick"] - 0.2726) < 0.02
    ids = {r[0] for r in df.select("citizen_id").where("citizen_id in ('C001', 'C999', 'C20000')").collect()}
    assert ids == {"C001", "C999", "C20000"}
    assert synthetic.synthetic(spark, 100, seed=1).exceptAll(synthetic.synthetic(spark, 100)).count() > 90


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_synthetic(spark, n):
    assert synthetic.synthetic(spark, n).count() == n
