"""

Queries read the given tables. ``vitals`` (health records derived from ``events``) and
``feed`` (the same with redelivered records) are views built identically in both engines.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseframe import fixed
from pulseframe.functions import clip
from pulseframe.operators import clean as cleaning
from pulseframe.operators import boosting, difference, features, incremental, keyed, levels, model, nested, profile, report, scaling, split, timejoin
from pulseframe.plans.etl import run_etl
from pulseframe.plans.scoring import newest_classes, read_runs, run_scoring
from pulseframe.session import scratch_path
from pulseframe.sinks import files
from pulseframe.sources import labelled_csv, payload, record_log, synthetic
from pulseframe.streaming import events
from pulseframe.streaming.ingest import read_feed, run_ingest
from spark_entry_oracle import oracle_sql as own_oracle_sql

TESTDATA = "/root/testdata"
AS_OF = datetime(2024, 2, 1, 12, 30, 45, 678901, tzinfo=timezone.utc)
LATER = datetime(2024, 2, 1, 12, 45, 45, 678901, tzinfo=timezone.utc)
LAST = datetime(2024, 2, 1, 12, 45, 45, 678902, tzinfo=timezone.utc)
# records before this time belong to the first delivery or scoring run
CUTOFF_MS = 1705363200000  # 2024-01-16T00:00:00Z

# ---------------------------------------------------------------------------- inputs

_VITALS = """
SELECT event_id, {fmt}('C%03d', user_id) AS citizen_id, {ms} AS timestamp,
 CAST(CASE WHEN event_id % 41 = 0 THEN 210 WHEN event_id % 43 = 0 THEN 35
      ELSE 50 + (event_id * 7919 + user_id * 31) % 61 END AS INT) AS average_heart_beat_rate,
 CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 0.8e0
      ELSE CAST(9400 + (event_id * 104729) % 651 AS DOUBLE) / 10000 END AS o2_content,
 CASE WHEN event_id % 59 = 0 THEN 15.5e0 WHEN event_id % 61 = 0 THEN 1.0e0
      ELSE CAST(450 + (event_id * 15485863) % 601 AS DOUBLE) / 100 END AS sleep_time,
 CAST(200 + floor(value) AS INT) AS calories_burned, event_type FROM {events}"""

_REDELIVERED = """
SELECT event_id + 1000000000000 AS seq, event_id, citizen_id, timestamp, average_heart_beat_rate, o2_content,
 sleep_time, calories_burned + CASE WHEN event_id % 70 = 0 THEN 0 ELSE 1 END AS calories_burned, event_type
FROM {vitals} WHERE event_id % 10 = 0"""


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    # zoned times and their text are read as UTC by every query
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _vitals(spark: SparkSession, sf: str) -> DataFrame:
    text = _VITALS.format(fmt="format_string", ms="unix_millis(CAST(ts AS TIMESTAMP))", events="{events}")
    return spark.sql(text, events=_table(spark, sf, "events"))


def _redelivered(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(_REDELIVERED, vitals=_vitals(spark, sf))


def _feed(spark: SparkSession, sf: str) -> DataFrame:
    first = _vitals(spark, sf).withColumn("seq", F.col("event_id"))
    return first.unionByName(_redelivered(spark, sf))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """The training table: vital signs with their label."""
    return features.risk_label(_vitals(spark, sf)).select(*fixed.TRAINING_CSV)


def _engineered(spark: SparkSession, sf: str) -> DataFrame:
    return features.engineer(cleaning.clean(_labelled(spark, sf)))


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    """Vital signs with a probability (the clipped risk score), class and run time."""
    scored = features.risk_score(_vitals(spark, sf))
    scored = scored.withColumn("p", clip(F.col("composite_risk_score"), 0.0, 1.0))
    return report.stamp(report.add_classification(scored, "p"), AS_OF)


def _messages(df: DataFrame) -> DataFrame:
    """Records as stream messages: seq and base64 JSON."""
    body = F.to_json(F.struct(*fixed.RAW_COLUMNS))
    return df.select("seq", F.base64(body.cast("binary")).alias("data"))


def _round(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# ------------------------------------------------------------- sources and projections


def coerce_props(spark, sf):
    k = F.get_json_object("props", "$.k")
    text = (
        F.when(F.col("event_type") == "view", F.concat(k, F.lit(".5")))
        .when(F.col("event_type") == "click", F.lit("n/a"))
        .when(F.col("event_type") == "error", F.concat(F.lit(" "), k))
        .otherwise(k)
    )
    texts = _table(spark, sf, "events").select("event_id", text.alias("k_int"), text.alias("k_double"))
    return cleaning.coerce(texts, {"k_int": "int", "k_double": "double"})


def csv_round_trip(spark, sf):
    path = scratch_path(spark, "labelled.csv")
    rows = _labelled(spark, sf)  # the header names the columns: another order, and one more
    rows.select(F.lit("x").alias("note"), *reversed(rows.columns)).write.csv(path, header=True)
    return cleaning.coerce(labelled_csv.read_training_csv(spark, path))


def decode_payload(spark, sf):
    decoded = payload.decode_payload(_messages(_feed(spark, sf)))
    return payload.read_fields(decoded).select("seq", *fixed.RAW_COLUMNS)


def topic_route(spark, sf):
    return payload.select_topic(_table(spark, sf, "events"), "click", "event_type").select(
        "event_id", "user_id", "value", "props"
    )


def raw_current(spark, sf):
    path = scratch_path(spark, "raw")
    accepted = payload.route(_messages(_feed(spark, sf)))
    record_log.append_batch(accepted, path, 0)
    return record_log.current(spark, path).drop("stream", "batch_id")


def snapshot_current(spark, sf):
    """The same content when read from a snapshot of batch 0 and the later batch."""
    path = scratch_path(spark, "raw")
    snapshot = scratch_path(spark, "snapshot")
    for number, part in enumerate(
        [_vitals(spark, sf).withColumn("seq", F.col("event_id")), _redelivered(spark, sf)]
    ):
        record_log.append_batch(payload.route(_messages(part)), path, number)
    record_log.write_snapshot(spark, path, snapshot, upto=0)
    return record_log.current(spark, path).drop("stream", "batch_id")


def synthetic_labelled(spark, sf):
    return synthetic.synthetic_for(_table(spark, sf, "customer").select("c_custkey"), "c_custkey")


def drop_incomplete(spark, sf):
    return cleaning.drop_incomplete(_vitals(spark, sf)).select("event_id", *fixed.VITALS)


def keep_range(spark, sf):
    return cleaning.keep_range(_vitals(spark, sf)).select("event_id", fixed.HEART_RATE)


def clip_values(spark, sf):
    return cleaning.clip_values(_vitals(spark, sf)).select("event_id", fixed.O2, fixed.SLEEP)


def clean_full(spark, sf):
    return cleaning.clean(_labelled(spark, sf))


def dedupe(spark, sf):
    return cleaning.dedupe(_vitals(spark, sf).select(fixed.CITIZEN, fixed.HEART_RATE))


def dedupe_by_key(spark, sf):
    rows = _vitals(spark, sf).select(fixed.CITIZEN, fixed.TIMESTAMP, fixed.CALORIES)
    return cleaning.dedupe(rows, [fixed.CITIZEN])


def zones(spark, sf):
    return features.add_categories(_vitals(spark, sf)).select("event_id", *fixed.CATEGORIES)


def risk_label(spark, sf):
    return features.risk_label(_vitals(spark, sf)).select("event_id", fixed.LABEL)


def safe_ratio(spark, sf):
    return features.add_safe_ratio(_vitals(spark, sf)).select("event_id", "calorie_efficiency")


def risk_score(spark, sf):
    return features.risk_score(_vitals(spark, sf)).select("event_id", "composite_risk_score")


def interaction(spark, sf):
    return features.add_interaction(_vitals(spark, sf)).select("event_id", "hr_sleep_interaction")


def risk_matrix(spark, sf):
    """Flagship: cleaned, categorised population with its mean risk."""
    rows = cleaning.clean(_vitals(spark, sf).select(fixed.CITIZEN, *fixed.VITALS))
    rows = features.engineer(rows)
    return rows.groupBy("heart_rate_zone", "o2_risk").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("composite_risk_score"), 6).alias("mean_risk")
    )


def classify(spark, sf):
    return _classified(spark, sf).select("event_id", fixed.CLASSIFICATION)


def iso_stamp(spark, sf):
    return report.stamp(_table(spark, sf, "events"), F.col("ts")).select("event_id", fixed.INFERENCE_TS)


def defaults(spark, sf):
    kind = F.col("event_type")
    rows = _vitals(spark, sf).withColumn(
        fixed.CLASSIFICATION, F.when(kind == "view", "").when(kind != "error", fixed.HEALTHY)
    )
    filled = report.with_defaults(rows, {fixed.O2: 0.0, fixed.CLASSIFICATION: fixed.UNKNOWN})
    return filled.select("event_id", fixed.O2, fixed.CLASSIFICATION)


def report_rows(spark, sf):
    """Sleep times are also moved to where only a few digits behind the point are left, and far beyond."""
    rows = _classified(spark, sf).withColumn(fixed.CITIZEN, F.concat(F.lit("<"), F.col(fixed.CITIZEN)))
    far = F.element_at(F.array(*[F.lit(x) for x in FAR_VALUES]), (F.col("event_id") % 7 + 1).cast("int"))
    return report.report_rows(rows.withColumn(fixed.SLEEP, F.when(F.col("event_id") % 20 == 0, far).otherwise(F.col(fixed.SLEEP))))


#: sleep times shown as numbers from 2**40 to 1e21, and the text that a browser gives
FAR_VALUES = [1500000000000.5, 2.0**40 + 0.25, 2.0**52 - 0.5, 2.0**53, 2.0**60, 123456789012345680000.0, 1e21]
FAR_TEXT = [
    "1500000000000.50", "1099511627776.25", "4503599627370495.50", "9007199254740992", "1152921504606847000",
    "123456789012345680000", "1e+21",
]


def json_records(spark, sf):
    return report.json_records(_vitals(spark, sf).select(*fixed.RAW_COLUMNS))


def preview(spark, sf):
    cols = ["event_id", *fixed.VITALS]
    return report.preview(_vitals(spark, sf), cols, 5, ["event_id"])


# ------------------------------------------------------------------------ aggregations


def label_distribution(spark, sf):
    return profile.value_counts(_labelled(spark, sf))


def _audited(df, cols):
    return _round(profile.audit(df, cols), ["mean", "stddev"])


def audit(spark, sf):
    return _audited(_vitals(spark, sf), fixed.VITALS)


LINEITEM_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def audit_lineitem(spark, sf):
    return _audited(_table(spark, sf, "lineitem"), LINEITEM_NUMBERS)


def anomaly_count(spark, sf):
    return profile.count_anomalies(_vitals(spark, sf))


def clean_funnel(spark, sf):
    return profile.funnel(_labelled(spark, sf))


def ingest_counts(spark, sf):
    return payload.route_counts(payload.route(_messages(_feed(spark, sf))))


def summary_cards(spark, sf):
    return profile.summary(_classified(spark, sf), distinct_citizens=True)


# ------------------------------------------------------------------- scaling and splits


def scaler_stats(spark, sf):
    stats = scaling.stats_table(scaling.fit_scaler(_engineered(spark, sf)))
    return _round(stats, ["mean", "std"])


def standard_scale(spark, sf):
    rows = _engineered(spark, sf)
    scaled = scaling.scale(rows, scaling.fit_scaler(rows))
    return _round(scaled.select(*fixed.VITALS, fixed.LABEL, *fixed.SCALED_FEATURES), fixed.SCALED_FEATURES)


def scale_lineitem(spark, sf):
    rows = _table(spark, sf, "lineitem")
    scaled = scaling.scale(rows, scaling.fit_scaler(rows, LINEITEM_NUMBERS))
    cols = [f"{c}_scaled" for c in LINEITEM_NUMBERS]
    return _round(scaled.select("l_orderkey", "l_linenumber", *cols), cols)


def training_frame(spark, sf):
    rows = _engineered(spark, sf)
    frame = scaling.training_frame(scaling.scale(rows, scaling.fit_scaler(rows)))
    return _round(frame, fixed.SCALED_FEATURES)


def random_split(spark, sf):
    rows = split.random_split(_vitals(spark, sf), "event_id")
    return rows.select("event_id", "split")


def stratified_split(spark, sf):
    rows = features.risk_label(_vitals(spark, sf)).select("event_id", fixed.LABEL)
    return split.stratified_split(rows, "event_id")


def stratified_orders(spark, sf):
    rows = _table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return split.stratified_split(rows, "o_orderkey", label="o_orderpriority")


# --------------------------------------------------------------- nested and keyed tables


def decimals_to_double(spark, sf):
    d = lambda c: F.col(c).cast("decimal(12,2)")
    rows = _table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        d("l_quantity").alias("quantity"),
        F.array(d("l_extendedprice"), d("l_tax")).alias("amounts"),
        F.create_map(F.lit("discount"), F.struct(d("l_discount").alias("value"))).alias("named"),
    )
    native = nested.decimals_to_double(rows)
    return native.select(
        "l_orderkey",
        "l_linenumber",
        "quantity",
        F.col("amounts")[0].alias("extendedprice"),
        F.col("amounts")[1].alias("tax"),
        F.col("named")["discount"]["value"].alias("discount"),
    )


def upsert_latest(spark, sf):
    first = _vitals(spark, sf).withColumn("seq", F.col("event_id"))
    return keyed.upsert(first, _redelivered(spark, sf)).select("seq", *fixed.RAW_COLUMNS)


def pending_records(spark, sf):
    """Records that are new, or were corrected since an earlier run."""
    first = _vitals(spark, sf).withColumn("seq", F.col("event_id"))
    raw = keyed.upsert(first, _redelivered(spark, sf))
    done = _classified(spark, sf).where(F.col(fixed.TIMESTAMP) < CUTOFF_MS).withColumn("seq", F.col("event_id"))
    return keyed.pending(raw, done, [*fixed.RAW_KEY, "seq"]).select("event_id", "seq", *fixed.RAW_KEY)


def analytics_upsert(spark, sf):
    """The analytics table by its key: a later row of a citizen and inference time replaces the earlier one."""
    stamped = report.stamp(_feed(spark, sf), F.timestamp_millis(F.col(fixed.TIMESTAMP)))
    first, later = (stamped.where(c) for c in ("seq < 1000000000000", "seq >= 1000000000000"))
    rows = keyed.upsert(first, later, fixed.ANALYTICS_KEY)
    return rows.select("seq", *fixed.ANALYTICS_KEY, fixed.CALORIES)


def latest_per_citizen(spark, sf):
    rows = keyed.latest_per_citizen(_vitals(spark, sf), [fixed.TIMESTAMP, "event_id"])
    return rows.select("event_id", *fixed.RAW_COLUMNS)


# ------------------------------------------------------------------------------ streams


def route_feed(spark, sf):
    """Messages whose heart rate is absent, null or quoted depending on the event type."""
    kind, rate = F.col("event_type"), F.col(fixed.HEART_RATE)
    note = F.when(F.col("event_id") % 5 == 0, F.repeat(F.lit("long "), F.lit(300))).alias("note")
    number = F.to_json(F.struct(*fixed.RAW_COLUMNS, note))
    others = [c for c in fixed.RAW_COLUMNS if c != fixed.HEART_RATE]
    absent = F.to_json(F.struct(*others, note))
    null = F.to_json(F.struct(*others, F.lit(None).cast("int").alias(fixed.HEART_RATE), note), {"ignoreNullFields": "false"})
    quoted = F.to_json(F.struct(*others, rate.cast("string").alias(fixed.HEART_RATE), note))
    body = (
        F.when(kind == "error", quoted).when(kind == "signup", absent).when(kind == "purchase", null).otherwise(number)
    )
    messages = _feed(spark, sf).select("seq", F.base64(body.cast("binary")).alias("data"))
    routed = payload.route(messages)
    return routed.select("seq", "route", "reason")


def stream_ingest(spark, sf):
    """Deliver the feed as files in two steps to a stream that restarts in between."""
    feed, log = scratch_path(spark, "feed"), scratch_path(spark, "raw")
    checkpoint = scratch_path(spark, "stream")
    first = _vitals(spark, sf).withColumn("seq", F.col("event_id"))
    for part in (first, _redelivered(spark, sf)):
        _messages(part).write.mode("append").json(feed)
        run_ingest(read_feed(spark, feed), log, checkpoint)
    return record_log.current(spark, log).drop("stream", "batch_id")


def stream_counts(spark, sf):
    """Stored and dropped records of a streamed feed, per route."""
    feed, log = scratch_path(spark, "feed"), scratch_path(spark, "raw")
    _messages(_feed(spark, sf)).write.json(feed)
    run_ingest(read_feed(spark, feed, maxFilesPerTrigger="4"), log, scratch_path(spark, "stream"))
    counts = record_log.ingest_counts(spark, log)
    return counts.groupBy("route").agg(F.sum("count").alias("n"))


DAY_MS = 24 * 3_600_000
STATE_PARTITIONS = 4


def _replayed(spark, sf, results):
    """What a streamed ``results(records)`` emits for the readings, delivered in five parts in order of time and a last one
    that closes all windows. Each delivery is a micro-batch of all its files; the query is stopped after it and started again."""
    feed, out, checkpoint = (scratch_path(spark, n) for n in ("feed", "emitted", "stream"))
    rows = _vitals(spark, sf).withColumn("seq", F.col("event_id"))
    ends = rows.agg(F.min(fixed.TIMESTAMP).alias("a"), F.max(fixed.TIMESTAMP).alias("b")).first()
    fifth = F.floor((F.col(fixed.TIMESTAMP) - ends["a"]) * 5 / (ends["b"] - ends["a"] + 1))
    last = events.closing(spark, ends["b"] + 100 * DAY_MS).withColumn("seq", F.lit(-1).cast("long"))
    for part in [*(rows.where(fifth == k) for k in range(5)), last]:
        _messages(part).write.mode("append").json(feed)
        emitted = results(payload.route(read_feed(spark, feed)).where(F.col("route") == payload.KEPT))
        events.run(emitted, out, checkpoint, STATE_PARTITIONS)
    return events.read(emitted, out)


def stream_windows(spark, sf):
    """Readings per citizen and day, of windows that slide by half a day, from a stream."""
    return _replayed(spark, sf, lambda rows: events.window_readings(rows, "1 day", "12 hours", delay="1 hour"))


def stream_sessions(spark, sf):
    """Readings per citizen and session, which ends after half a day without reading, from a stream."""
    return _replayed(spark, sf, lambda rows: events.session_readings(rows, "12 hours", delay="1 hour"))


def stream_alerts(spark, sf):
    """Silence of more than two days and three unusual readings in a row, per citizen, from a stream with state."""
    return _replayed(spark, sf, lambda rows: events.alerts(rows, 2 * DAY_MS, 3, (60.0, 100.0), delay="1 hour"))


# ------------------------------------------------------ time, levels, differences, merged statistics

HOUR_MS = 3_600_000


def asof_readings(spark, sf):
    """For every error event the last reading of its citizen, at most two days old."""
    rows = _vitals(spark, sf)
    errors = rows.where("event_type = 'error'").select("event_id", "citizen_id", "timestamp")
    readings = rows.where("event_type <> 'error'").select(
        "citizen_id", "timestamp", F.col("event_id").alias("reading_id"), fixed.HEART_RATE, fixed.O2
    )
    joined = timejoin.as_of_join(errors, readings, ["citizen_id"], "timestamp", 12 * HOUR_MS, ties=["reading_id"], tolerance=48 * HOUR_MS)
    return joined.select("event_id", "citizen_id", "timestamp", "matched.reading_id", f"matched.{fixed.HEART_RATE}", f"matched.{fixed.O2}")


def asof_orders(spark, sf):
    """For every order the customer's order before it, whatever its age; orders of one day go by their key."""
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.datediff("o_orderdate", F.lit("1970-01-01")).alias("day"))
    moments = orders.withColumn("until", F.col("day") - 1)
    earlier = orders.select("o_custkey", "day", F.col("o_orderkey").alias("previous"))
    joined = timejoin.as_of_join(moments, earlier, ["o_custkey"], "until", 90, right_time="day", ties=["previous"])
    return joined.select("o_orderkey", "o_custkey", "day", F.col("matched.previous").alias("previous"), (F.col("day") - F.col("matched.day")).alias("days"))


def interval_readings(spark, sf):
    """The readings of a citizen within the alarm that an error raises, which lasts an hour to a week."""
    rows = _vitals(spark, sf)
    lasts = (1 + F.col("event_id") * 37 % 168) * HOUR_MS
    alarms = rows.where("event_type = 'error'").select("citizen_id", F.col("event_id").alias("alarm_id"), F.col("timestamp").alias("since"), (F.col("timestamp") + lasts).alias("until"))
    readings = rows.select("event_id", "citizen_id", "timestamp", fixed.HEART_RATE)
    joined = timejoin.interval_join(readings, alarms, ["citizen_id"], "timestamp", "since", "until")
    return joined.select("event_id", "citizen_id", "timestamp", fixed.HEART_RATE, "interval.alarm_id")


def _measured(spark, sf):
    rows = _engineered(spark, sf)
    return rows, {
        "n": F.count(F.lit(1)), "unhealthy": F.sum(fixed.LABEL), "least": F.min(fixed.HEART_RATE), "most": F.max(fixed.HEART_RATE),
        "calories": F.sum(fixed.CALORIES),
    }


def vitals_cube(spark, sf):
    """Counts and sums for every choice of zone, oxygen class, sleep class and label."""
    rows, aggregates = _measured(spark, sf)
    dimensions = [*fixed.CATEGORIES, fixed.LABEL]
    return levels.aggregate_levels(rows, dimensions, levels.cube_sets(dimensions), **aggregates)


def orders_rollup(spark, sf):
    """Orders by year, month and priority, by year and month, by year, and all."""
    orders = _table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), F.col("o_orderpriority").alias("priority"), "o_custkey"
    )
    dimensions = ["year", "month", "priority"]
    return levels.aggregate_levels(orders, dimensions, levels.rollup_sets(dimensions), n=F.count(F.lit(1)), customers=F.count_distinct("o_custkey"))


def vitals_grouping_sets(spark, sf):
    """Chosen levels only: zone with label, sleep class, all."""
    rows, aggregates = _measured(spark, sf)
    dimensions = ["heart_rate_zone", "sleep_quality", fixed.LABEL]
    return levels.aggregate_levels(rows, dimensions, [("heart_rate_zone", fixed.LABEL), ("sleep_quality",), ()], **aggregates)


def _states(spark, sf):
    """The raw table as of the first delivery, and as of all but some records."""
    rows = _vitals(spark, sf).select("event_id", *fixed.RAW_COLUMNS)
    old = rows.where(F.col("event_id") % 7 != 0)
    corrected = F.when(F.col("event_id") % 10 == 0, F.col(fixed.CALORIES) + 1).otherwise(F.col(fixed.CALORIES))
    new = rows.where(F.col("event_id") % 11 != 0).withColumn(fixed.CALORIES, corrected)
    return old, new.withColumn(fixed.O2, F.when(F.col("event_id") % 13 == 0, None).otherwise(F.col(fixed.O2)))


def state_difference(spark, sf):
    """Records added, removed and changed between two states of the table, and what changed."""
    old, new = _states(spark, sf)
    rows = difference.snapshot_difference(old, new, ["event_id"])
    return rows.select("event_id", "change", F.array_join("columns", ",").alias("columns"), F.col(f"before.{fixed.CALORIES}").alias("old_calories"), F.col(f"after.{fixed.CALORIES}").alias("new_calories"))


def state_common(spark, sf):
    return difference.common_rows(*_states(spark, sf))


def state_missing(spark, sf):
    """Readings without their ids that the first state has more often than the second."""
    old, new = [s.select(fixed.CITIZEN, fixed.HEART_RATE, fixed.SLEEP) for s in _states(spark, sf)]
    return difference.missing_rows(old, new)


def incremental_scaler(spark, sf):
    """Scaling statistics from the stored moments of daily batches, one of them stored twice."""
    rows, path = features.engineer(cleaning.drop_incomplete(_vitals(spark, sf))), scratch_path(spark, "moments")
    day = F.floor(F.col(fixed.TIMESTAMP) / (24 * HOUR_MS))
    for number in [0, 1, 2, 3, 2]:
        part = incremental.moments(rows.where(day % 4 == number))
        incremental.keep_batch(part, path, number)
    merged = incremental.merge_moments(incremental.kept_batches(part, path))
    return _round(incremental.scaler_of(merged).join(merged.select("feature", "n"), "feature"), ["mean", "std"])


def distinct_citizens(spark, sf):
    """Distinct citizens and timestamps per event type from daily sketches: whether the estimate is within three standard errors."""
    rows, path = _vitals(spark, sf), scratch_path(spark, "sketches")
    daily = rows.withColumn("day", F.floor(F.col(fixed.TIMESTAMP) / (24 * HOUR_MS)))
    part = incremental.distinct_sketches(daily, ["day", "event_type"], [fixed.CITIZEN, fixed.TIMESTAMP])
    incremental.keep_batch(part, path, 0)
    merged = incremental.merge_sketches(incremental.kept_batches(part, path), ["event_type"])
    exact = rows.groupBy("event_type").agg(F.count_distinct(fixed.CITIZEN).alias(fixed.CITIZEN), F.count_distinct(fixed.TIMESTAMP).alias(fixed.TIMESTAMP))
    exact = exact.unpivot("event_type", [fixed.CITIZEN, fixed.TIMESTAMP], "column_name", "exact")
    near = F.abs(F.col("estimate") - F.col("exact")) <= 3 * incremental.RELATIVE_ERROR * F.col("exact")
    return merged.join(exact, ["event_type", "column_name"]).select("event_type", "column_name", "exact", near.alias("near"))


# ------------------------------------------------------------------------ model and jobs

_RUNS: dict[tuple, object] = {}


def _once(kind: str, spark: SparkSession, sf: str, build: Callable[[], object]):
    """Share one ETL run and one trained model among the queries of a session."""
    key = (kind, spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        _RUNS[key] = build()
    return _RUNS[key]


def _table_name(root: str) -> str:
    """A catalog name of its own for each run: from the unique part of its folder."""
    return f"pulseframe_{root.rstrip('/').split('/')[-2]}"


def run_etl_fresh(spark: SparkSession, sf: str) -> tuple[str, dict]:
    root = scratch_path(spark, "etl")
    _labelled(spark, sf).write.csv(f"{root}/source.csv", header=True)
    return root, run_etl(spark, f"{root}/source.csv", f"{root}/data", AS_OF, table=_table_name(root))


def _etl(spark, sf):
    return _once("etl", spark, sf, lambda: run_etl_fresh(spark, sf))


def _trained(spark, sf):
    """Boosted trees on the ETL's training channel, with their statistics."""

    def build():
        root, result = _etl(spark, sf)
        training = labelled_csv.read_split_csv(spark, f"{root}/data/{fixed.TRAIN_FILE}")
        validation = labelled_csv.read_split_csv(spark, f"{root}/data/{fixed.VALIDATION_FILE}")
        return model.train(training, validation, growth="level"), result["stats"]

    return _once("model", spark, sf, build)


def etl_processed(spark, sf):
    root, _ = _etl(spark, sf)
    return _round(spark.read.parquet(f"{root}/data/processed"), fixed.SCALED_FEATURES)


def etl_channels(spark, sf):
    root, _ = _etl(spark, sf)
    parts = [
        labelled_csv.read_split_csv(spark, f"{root}/data/{side}/{side}.csv").withColumn("split", F.lit(side))
        for side in (split.TRAIN, split.VALIDATION)
    ]
    return profile.split_counts(parts[0].unionByName(parts[1]))


def etl_statistics(spark, sf):
    root, _ = _etl(spark, sf)
    text = spark.read.text(f"{root}/data/{fixed.CONFIG}/{fixed.STATISTICS_FILE}")
    schema = (
        "features ARRAY<STRING>, stats MAP<STRING, STRUCT<mean DOUBLE, std DOUBLE>>, "
        "train_count BIGINT, val_count BIGINT, total_processed BIGINT, created_at STRING"
    )
    rows = text.select(F.from_json("value", schema).alias("d")).select("d.*")
    rows = rows.select("train_count", "val_count", "total_processed", "created_at", F.explode("stats"))
    return rows.select(
        F.col("key").alias("feature"), "value.mean", "value.std",
        "train_count", "val_count", "total_processed", "created_at",
    )


def etl_table_properties(spark, sf):
    """The table that the job registered: its properties, and the rows it reads."""
    root, _ = _etl(spark, sf)
    rows = spark.table(_table_name(root)).agg(F.lit("rows").alias("key"), F.count(F.lit(1)).cast("string").alias("value"))
    stored = spark.sql(f"SHOW TBLPROPERTIES {_table_name(root)}").where(F.col("key").isin(*fixed.TABLE_PROPERTIES))
    value = F.when(F.col("key") == "sourceKey", F.substring_index("value", "/", -1)).otherwise(F.col("value"))
    return stored.select("key", value.alias("value")).unionByName(rows)


def results_export(spark, sf):
    """Classified rows written as CSV with a header and read back."""
    rows = _classified(spark, sf).select(*fixed.ANALYTICS_COLUMNS)
    path = files.export_csv(rows, scratch_path(spark, "results"), AS_OF)
    return spark.read.schema(rows.schema).csv(path, header=True)


def feature_vector(spark, sf):
    rows = model.feature_vector(_vitals(spark, sf))
    return rows.select("event_id", *[F.col("features")[i].alias(f"f{i}") for i in range(len(fixed.VITALS))])


def log_loss(spark, sf):
    rows = features.risk_label(_classified(spark, sf))
    return _round(model.evaluate(rows, "p"), ["log_loss"])


#: least accuracy of the trees on the held-out side
ACCURACY = 0.95


def gbt_confusion(spark, sf):
    """Per label the held-out rows, and whether enough of them are classified rightly."""
    root, _ = _etl(spark, sf)
    trees, _ = _trained(spark, sf)
    held_out = labelled_csv.read_split_csv(spark, f"{root}/data/{fixed.VALIDATION_FILE}")
    return _accuracy(model.confusion(model.predict(held_out, trees)))


def _accuracy(counts: DataFrame) -> DataFrame:
    right = F.col(fixed.CLASSIFICATION) == F.when(F.col(fixed.LABEL) == 1, fixed.UNHEALTHY).otherwise(fixed.HEALTHY)
    return counts.groupBy(fixed.LABEL).agg(
        F.sum("count").alias("n"), (F.sum(F.when(right, F.col("count")).otherwise(0)) >= ACCURACY * F.sum("count")).alias("accurate")
    )


def _leafwise(spark, sf):
    """A leaf-wise fit on the ETL's channels that ends by its validation loss."""

    def build():
        root, _ = _etl(spark, sf)
        channels = [labelled_csv.read_split_csv(spark, f"{root}/data/{f}") for f in (fixed.TRAIN_FILE, fixed.VALIDATION_FILE)]
        return boosting.fit(*channels, params={**fixed.BOOSTING, "learning_rate": 0.5, "early_stopping_rounds": 2})

    return _once("leafwise", spark, sf, build)


def leafwise_confusion(spark, sf):
    """As ``gbt_confusion``, with trees grown leaf by leaf."""
    root, _ = _etl(spark, sf)
    trees = PipelineModel([model.assembler(fixed.SCALED_FEATURES), boosting.to_mllib(_leafwise(spark, sf))])
    held_out = labelled_csv.read_split_csv(spark, f"{root}/data/{fixed.VALIDATION_FILE}")
    return _accuracy(model.confusion(model.predict(held_out, trees)))


def leafwise_trees(spark, sf):
    """Per tree its limits: leaves, features, and whether it was built before the patience was used up."""
    fit, p = _leafwise(spark, sf), fixed.BOOSTING
    rows = [(len(fit.trees) - fit.best <= 2, boosting.n_leaves(t) <= p["leaves"], boosting.least_leaf(t) >= p["min_data_in_leaf"], len(u)) for t, u in zip(fit.trees, fit.used)]
    df = spark.createDataFrame(rows, "in_time boolean, few_leaves boolean, full_leaves boolean, features int")
    return df.groupBy("in_time", "few_leaves", "full_leaves", "features").agg((F.count(F.lit(1)) <= p["rounds"]).alias("few_rounds"))


#: where bins begin in ``split_gains``
GAIN_EDGES = {
    fixed.HEART_RATE: [float(x) for x in range(45, 200, 5)], fixed.O2: [x / 200 for x in range(171, 200)],
    fixed.SLEEP: [x / 4 for x in range(9, 56)], fixed.CALORIES: [float(x) for x in range(200, 900, 25)],
}


def split_gains(spark, sf):
    """What every split of the first tree's root would gain, feature by feature and bin by bin."""
    rows = _labelled(spark, sf)
    return boosting.root_gains(rows, GAIN_EDGES, fixed.LABEL).withColumn("gain", F.round("gain", 6))


#: statistics and two trees, given as data, so that SQL can follow a record to its class
GIVEN_STATS = {
    c: {"mean": m, "std": d}
    for c, (m, d) in zip(fixed.NUMERIC_FEATURES, [(75.0, 15.0), (0.97, 0.02), (7.0, 1.5), (500.0, 150.0), (3.0, 2.0), (0.25, 0.125), (2.25, 1.5)])
}
GIVEN_TREES = [
    {"feature": 0, "bin": 0, "below": 1.0, "gain": 1.0, "n": 3, "right": {"value": 1.2, "n": 1},
     "left": {"feature": 1, "bin": 0, "below": -1.0, "gain": 1.0, "n": 2, "left": {"value": 0.8, "n": 1}, "right": {"value": -0.9, "n": 1}}},
    {"feature": 2, "bin": 0, "below": -1.3, "gain": 1.0, "n": 3, "left": {"value": 1.0, "n": 1},
     "right": {"feature": 4, "bin": 0, "below": 1.5, "gain": 1.0, "n": 2, "left": {"value": -0.3, "n": 1}, "right": {"value": 0.2, "n": 1}}},
]


def score_classes(spark, sf):
    """The class of every record by two given trees: clipping, engineering, scaling, trees and threshold."""
    given = boosting.Fit(fixed.SCALED_FEATURES, [], 0.1, 0.5, GIVEN_TREES)
    trees = PipelineModel([model.assembler(fixed.SCALED_FEATURES), boosting.to_mllib(given)])
    records = _vitals(spark, sf).select("event_id", *fixed.RAW_COLUMNS)
    rows = model.score_all(records, trees, GIVEN_STATS, AS_OF, carry=["event_id"])
    return rows.select("event_id", fixed.CITIZEN, fixed.CLASSIFICATION, "outcome", "reason")


def score_batch(spark, sf):
    """All records with their outcome; of the class, whether there is one."""
    trees, stats = _trained(spark, sf)
    rows = model.score_all(_vitals(spark, sf).select(*fixed.RAW_COLUMNS), trees, stats, AS_OF)
    known = F.col(fixed.CLASSIFICATION).isin(fixed.HEALTHY, fixed.UNHEALTHY)
    return rows.withColumn("classified", F.coalesce(known, F.lit(False))).drop(fixed.CLASSIFICATION)


def model_round_trip(spark, sf):
    """Rows on which a saved and reloaded model version gives the same probability."""
    trees, stats = _trained(spark, sf)
    path = scratch_path(spark, "models")
    model.save_model(trees, path, 1, stats)
    loaded, loaded_stats = model.load_model(spark, path, 1)
    rows = model.predict(model.prepare(_vitals(spark, sf).select(*fixed.RAW_COLUMNS), stats), trees, "p")
    both = rows.select(F.struct("*").alias("first"), "_record.*")
    both = model.predict(model.prepare(both, loaded_stats), loaded, "q")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_record.first.p") == F.col("q")).alias("n_equal"))


def scheduled_scoring(spark, sf):
    """Runs over a growing log. The second scores only new and corrected records, the third finds nothing to do;
    a replayed batch changes nothing."""
    trees, stats = _trained(spark, sf)
    log, analytics = scratch_path(spark, "raw"), scratch_path(spark, "analytics")
    rows = _vitals(spark, sf).withColumn("seq", F.col("event_id"))
    early = F.col(fixed.TIMESTAMP) < CUTOFF_MS
    corrected = _redelivered(spark, sf)
    for number, (part, as_of) in enumerate([(rows.where(early), AS_OF), (rows.where(~early).unionByName(corrected), LATER)]):
        for _ in range(2):  # each batch comes twice
            record_log.append_batch(payload.route(_messages(part)), log, number)
        run_scoring(spark, log, trees, stats, analytics, as_of, only_new=True)
    run_scoring(spark, log, trees, stats, analytics, LAST, only_new=True)
    stored = newest_classes(read_runs(spark, analytics))
    known = F.coalesce(F.col(fixed.CLASSIFICATION).isin(fixed.HEALTHY, fixed.UNHEALTHY), F.lit(False))
    return stored.select(*fixed.RAW_COLUMNS, fixed.INFERENCE_TS, "outcome", "reason", "source_seq", known.alias("classified"))


# ------------------------------------------------------------------------------ contract

_QUERIES = [
    coerce_props, csv_round_trip, decode_payload, topic_route, raw_current, snapshot_current,
    synthetic_labelled, drop_incomplete, keep_range, clip_values, clean_full, dedupe, dedupe_by_key,
    zones, risk_label, safe_ratio, risk_score, interaction, risk_matrix, classify, iso_stamp, defaults,
    report_rows, json_records, preview, label_distribution, audit, audit_lineitem, anomaly_count,
    clean_funnel, ingest_counts, summary_cards, scaler_stats, standard_scale, scale_lineitem,
    training_frame, random_split, stratified_split, stratified_orders, decimals_to_double, upsert_latest,
    pending_records, analytics_upsert, latest_per_citizen, route_feed, stream_ingest, stream_counts, etl_processed,
    etl_channels, etl_statistics, etl_table_properties, results_export, feature_vector, log_loss,
    stream_windows, stream_sessions, stream_alerts, asof_readings, asof_orders, interval_readings, vitals_cube, orders_rollup, vitals_grouping_sets, state_difference,
    state_common, state_missing, incremental_scaler, distinct_citizens, gbt_confusion, leafwise_confusion, leafwise_trees, split_gains, score_classes, score_batch, model_round_trip, scheduled_scoring,
]


def entry(spark: SparkSession) -> DataFrame:
    return risk_matrix(spark, f"{TESTDATA}/sf0.001")


def _training_data() -> tuple[dict[str, Callable], dict[str, str]]:
    """Queries and SQL of the training-data operators, where they are installed."""
    try:
        import corpus_pipeline
        from pulseframe.llm import oracle as llm_oracle, queries as llm_queries
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "pulseframe.llm"):
            raise
        return {}, {}
    found = {q.__name__: q for q in llm_queries.QUERIES} | {"pipeline": corpus_pipeline.run}
    sql = llm_oracle.ORACLE | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES} | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return own_oracle_sql() | _training_data()[1]
