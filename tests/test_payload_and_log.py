import base64
import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pulseframe.sources import payload, record_log
from pulseframe.streaming.ingest import read_feed, run_ingest, start_ingest


def b64(text):
    raw = text if isinstance(text, bytes) else text.encode()
    return base64.b64encode(raw).decode()


def message(**fields):
    base = {
        "citizen_id": "C001", "average_heart_beat_rate": 80, "o2_content": 0.97, "sleep_time": 7.5,
        "calories_burned": 400, "timestamp": 1000,
    }
    base.update(fields)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


CASES = [
    (b64(message()), "kept"),
    (b64(message(average_heart_beat_rate=40)), "kept"),
    (b64(message(average_heart_beat_rate=200)), "kept"),
    (b64(message(average_heart_beat_rate=40.0)), "kept"),
    (b64(message(average_heart_beat_rate=39)), "anomaly"),
    (b64(message(average_heart_beat_rate=39.9)), "anomaly"),
    (b64(message(average_heart_beat_rate=200.5)), "anomaly"),
    (b64(message(average_heart_beat_rate=1e300)), "anomaly"),
    (b64(message(average_heart_beat_rate=10**50)), "anomaly"),
    (b64(message(average_heart_beat_rate=...)), "anomaly"),
    (b64(message(average_heart_beat_rate=..., citizen_id=...)), "anomaly"),
    (b64(message(average_heart_beat_rate=True)), "anomaly"),
    (b64("{}"), "anomaly"),
    (b64(message(average_heart_beat_rate=None)), "error"),
    (b64(message(average_heart_beat_rate="80")), "error"),
    (b64(message(average_heart_beat_rate=[80])), "error"),
    (b64(message(average_heart_beat_rate={"v": 80})), "error"),
    (b64(message(citizen_id=...)), "error"),
    (b64(message(citizen_id=None)), "error"),
    (b64(message(timestamp=...)), "error"),
    (b64(message(timestamp=None)), "error"),
    (b64(message(o2_content=..., sleep_time=..., calories_burned=...)), "kept"),
    (b64(message(o2_content=None)), "kept"),
    (b64("  \n" + message()), "kept"),
    (b64('{"average_heart_beat_rate":10,"average_heart_beat_rate":80,"citizen_id":"a","timestamp":1}'), "kept"),
    (b64(message(o2_content="x")), "kept"),
    (b64(message(timestamp="12")), "kept"),
    (b64(message(timestamp=1000.0)), "kept"),
    (b64(message(calories_burned=500.7)), "kept"),
    (b64(message(citizen_id=7)), "kept"),
    (b64(message(note={"a": [{}]})), "kept"),
    (b64(message(note="}{")), "kept"),
    (b64(message(note={"a": 1}, average_heart_beat_rate=30)), "anomaly"),
    (b64(message() + " xyz"), "error"),
    (b64(message() + message()), "error"),
    (b64(message() + "}"), "error"),
    (b64(message() + "]"), "error"),
    (b64(message() + "," + message()), "error"),
    (b64(message() + '], [{"a": 1}'), "error"),
    (b64(message(note={}) + ', "q": {}'), "error"),
    (b64("{'average_heart_beat_rate': 80}"), "error"),
    (b64(message(average_heart_beat_rate="NaN")), "error"),
    (b64(message().replace("80", "080")), "error"),
    (b64(message().replace("average_heart", "Average_heart")), "anomaly"),
    (b64("[1, 2]"), "error"),
    (b64("80"), "error"),
    (b64("null"), "error"),
    (b64("not json"), "error"),
    (b64('{"average_heart_beat_rate": NaN}'), "error"),
    (b64('{"average_heart_beat_rate": 80'), "error"),
    (b64(b"\xff\xfe{}"), "error"),
    (b64(""), "error"),
    ("%%%", "error"),
    ("YWJj$", "error"),
    ("e", "error"),
    (None, "error"),
    (b64(message())[:10] + "\n*" + b64(message())[10:], "kept"),
]


@pytest.fixture(scope="module")
def routed(spark):
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(CASES)], "seq bigint, data string")
    rows = payload.route(df).collect()
    return {r["seq"]: r for r in rows}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_route(routed, i):
    assert routed[i]["route"] == CASES[i][1], (CASES[i], routed[i])
    assert (routed[i]["reason"] is None) == (CASES[i][1] == "kept")


def test_fields_of_kept_record(routed):
    row = routed[0]
    assert (row["citizen_id"], row["timestamp"], row["average_heart_beat_rate"]) == ("C001", 1000, 80.0)
    assert (row["o2_content"], row["sleep_time"], row["calories_burned"]) == (0.97, 7.5, 400)


def test_values_of_unusual_types(spark):
    texts = [
        message(timestamp="12"), message(timestamp=1000.0), message(calories_burned=500.7),
        message(o2_content="x"), message(citizen_id=7), message(note={"a": [{}]}),
    ]
    df = spark.createDataFrame([(i, b64(t)) for i, t in enumerate(texts)], "seq bigint, data string")
    rows = {r["seq"]: r for r in payload.route(df).collect()}
    assert rows[0]["timestamp"] == 12 and rows[1]["timestamp"] == 1000
    assert rows[2]["calories_burned"] == 500 and rows[3]["o2_content"] is None and rows[4]["citizen_id"] == "7"
    assert rows[5]["o2_content"] == 0.97
    # the direct reading agrees with the fields of the decoded payload
    fields = ["seq", "citizen_id", "timestamp", "average_heart_beat_rate", "o2_content", "sleep_time", "calories_burned"]
    decoded = payload.read_fields(payload.decode_payload(df)).select(fields)
    assert sorted(decoded.collect()) == sorted(payload.route(df).select(fields).collect())


def test_route_counts(spark):
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(CASES)], "seq bigint, data string")
    counts = payload.route_counts(payload.route(df)).first()
    want = [sum(r == side for _, r in CASES) for side in ("kept", "anomaly", "error")]
    assert list(counts) == want


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-(10**6), 10**6) | st.floats(-1e6, 1e6) | st.text(max_size=5),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=4), inner, max_size=3),
    max_leaves=4,
)


def plain_route(text):
    """The routing rule on one decoded message."""
    data = json.loads(text)
    if not isinstance(data, dict):
        return "error"
    rate = data.get("average_heart_beat_rate", 0)
    if not isinstance(rate, (int, float)):
        return "error"
    if rate < 40 or rate > 200:
        return "anomaly"
    return "error" if data.get("citizen_id") is None or data.get("timestamp") is None else "kept"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(json_values, st.fixed_dictionaries({}, optional={
    "average_heart_beat_rate": json_values | st.integers(30, 210), "citizen_id": st.text("abc", min_size=1) | st.none(),
    "timestamp": st.integers(0, 10**12) | st.none(), "o2_content": json_values, "note": json_values,
})), min_size=1, max_size=30))
def test_every_message_has_the_expected_route(spark, values):
    texts = [json.dumps(v) for v in values]
    df = spark.createDataFrame([(i, b64(t)) for i, t in enumerate(texts)], "seq bigint, data string")
    got = {r["seq"]: r["route"] for r in payload.route(df).select("seq", "route").collect()}
    assert got == {i: plain_route(t) for i, t in enumerate(texts)}


def test_select_topic(spark):
    df = spark.createDataFrame([("citizen/health", 1), ("other", 2)], "topic string, x int")
    got = payload.select_topic(df)
    assert got.columns == ["x"] and [r["x"] for r in got.collect()] == [1]


def feed_rows(*rows):
    return [(seq, b64(message(citizen_id=c, timestamp=t, calories_burned=cal))) for seq, c, t, cal in rows]


def route_all(spark, rows):
    df = spark.createDataFrame(rows, "seq bigint, data string")
    return payload.route(df)


def content(df):
    return sorted((r["citizen_id"], r["timestamp"], r["calories_burned"]) for r in df.collect())


def test_log_replay_and_snapshot(spark, tmp_path):
    log = str(tmp_path / "log")
    first = feed_rows((1, "a", 10, 100), (2, "a", 10, 101), (3, "b", 10, 200)) + [(4, "%%%")]
    second = feed_rows((1, "b", 10, 201), (2, "c", 10, 300))
    for number, rows in ((0, first), (1, second), (1, second), (0, first)):  # replays
        record_log.append_batch(route_all(spark, rows), log, number)
    want = [("a", 10, 101), ("b", 10, 201), ("c", 10, 300)]
    assert content(record_log.current(spark, log)) == want
    counts = {(r["batch_id"], r["route"]): r["count"] for r in record_log.ingest_counts(spark, log).collect()}
    assert counts == {(0, "kept"): 3, (0, "error"): 1, (1, "kept"): 2}

    snap0, snap1 = str(tmp_path / "s0"), str(tmp_path / "s1")
    assert record_log.write_snapshot(spark, log, snap0, upto=0) == {record_log.BY_HAND: 0}
    assert content(record_log.current(spark, log)) == want
    assert record_log.write_snapshot(spark, log, snap1) == {record_log.BY_HAND: 1}
    assert record_log.published_snapshot(spark, log) == (snap1, {record_log.BY_HAND: 1})
    assert content(record_log.current(spark, log)) == want == content(record_log.current(spark, log, snapshot=False))
    bad = record_log.read_log(spark, log, "error").count()
    assert bad == 1


def test_error_rows_keep_their_payload(spark, tmp_path):
    log = str(tmp_path / "log")
    record_log.append_batch(route_all(spark, feed_rows((1, "a", 1, 1)) + [(2, "%%%")]), log, 0)
    rows = {r["seq"]: r for r in record_log.read_log(spark, log, None).collect()}
    assert rows[1]["data"] is None and rows[2]["data"] == "%%%" and rows[2]["reason"]


def write_feed(spark, path, rows):
    spark.createDataFrame(rows, "seq bigint, data string").coalesce(1).write.mode("append").json(path)


def test_stream_restart_equals_batch(spark, tmp_path):
    feed, log, state = (str(tmp_path / n) for n in ("feed", "log", "state"))
    parts = [
        feed_rows((1, "a", 1, 1), (2, "a", 1, 2)),
        feed_rows((3, "a", 1, 3), (4, "b", 1, 4)) + [(5, "%%%")],
        feed_rows((6, "b", 1, 6)),
    ]
    for rows in parts:
        write_feed(spark, feed, rows)
        run_ingest(read_feed(spark, feed), log, state)
    run_ingest(read_feed(spark, feed), log, state)  # nothing new
    assert content(record_log.current(spark, log)) == [("a", 1, 3), ("b", 1, 6)]
    whole = str(tmp_path / "whole")
    record_log.append_batch(route_all(spark, sum(parts, [])), whole, 0)
    assert content(record_log.current(spark, whole)) == content(record_log.current(spark, log))


def test_failed_micro_batch_is_replayed_once(spark, tmp_path, monkeypatch):
    """The sink dies after writing; the restarted query writes the same batch again."""
    from pulseframe.streaming import ingest

    feed, log, state = (str(tmp_path / n) for n in ("feed", "log", "state"))
    write_feed(spark, feed, feed_rows((1, "a", 1, 1), (2, "b", 1, 2)))
    real = ingest.append_batch

    def dies(batch, path, number, stream):
        real(batch, path, number, stream)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "append_batch", dies)
    with pytest.raises(Exception, match="lost"):
        run_ingest(read_feed(spark, feed), log, state)
    monkeypatch.setattr(ingest, "append_batch", real)
    run_ingest(read_feed(spark, feed), log, state)
    assert record_log.read_log(spark, log).count() == 2
    assert content(record_log.current(spark, log)) == [("a", 1, 1), ("b", 1, 2)]


def test_interval_trigger(spark, tmp_path):
    feed, log, state = (str(tmp_path / n) for n in ("feed", "log", "state"))
    write_feed(spark, feed, feed_rows((1, "a", 1, 1)))
    query = start_ingest(read_feed(spark, feed), log, state, interval="1 second")
    try:
        query.processAllAvailable()
        write_feed(spark, feed, feed_rows((2, "a", 1, 2)))
        query.processAllAvailable()
    finally:
        query.stop()
    assert content(record_log.current(spark, log)) == [("a", 1, 2)]


def test_hot_citizen_is_reduced_before_the_shuffle(spark, tmp_path):
    from pulseframe.operators.keyed import latest_per_citizen

    df = spark.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("citizen_id"),
        F.col("id").alias("timestamp"),
    )
    latest = latest_per_citizen(df)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert latest.where("citizen_id = 'hot'").first()["timestamp"] == 8997
    assert latest.count() == 6001


def test_missing_log_fails_and_later_batches(spark, tmp_path):
    log = str(tmp_path / "log")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        record_log.current(spark, log)
    record_log.append_batch(route_all(spark, feed_rows((1, "a", 1, 1), (2, "b", 1, 2))), log, 0)
    record_log.append_batch(route_all(spark, feed_rows((3, "b", 1, 3))), log, 1)
    assert content(record_log.current(spark, log, after=0)) == [("b", 1, 3)]


def test_snapshot_limits_the_listing(spark, tmp_path, monkeypatch):
    """After a snapshot only the groups that may hold newer batches are listed."""
    monkeypatch.setattr(record_log, "GROUP", 2)
    log = str(tmp_path / "log")
    for number in range(5):
        record_log.append_batch(route_all(spark, feed_rows((1, "a", 1, number), (2, f"c{number}", 1, 0))), log, number)
    record_log.write_snapshot(spark, log, str(tmp_path / "snap"), upto=2)
    folders = record_log.newer_folders(spark, log, {record_log.BY_HAND: 2})
    assert [f.rsplit("=", 1)[1] for f in folders] == ["1", "2"]
    current = record_log.current(spark, log)
    assert content(current) == [("a", 1, 4)] + [(f"c{i}", 1, 0) for i in range(5)]
    assert not any("group=0" in f for f in current.inputFiles())
    # a stream that begins after the snapshot is read from its first batch
    record_log.append_batch(route_all(spark, feed_rows((1, "z", 1, 7))), log, 0, stream="1")
    assert ("z", 1, 7) in content(record_log.current(spark, log))


def test_two_feeds_fill_one_log(spark, tmp_path):
    log = str(tmp_path / "log")
    for name, rows in (("x", feed_rows((1, "a", 1, 1))), ("y", feed_rows((1, "b", 1, 2)))):
        write_feed(spark, str(tmp_path / name), rows)
        run_ingest(read_feed(spark, str(tmp_path / name)), log, str(tmp_path / f"state-{name}"))
    assert content(record_log.current(spark, log)) == [("a", 1, 1), ("b", 1, 2)]


def test_lost_checkpoint_overwrites_nothing(spark, tmp_path):
    feed, log = str(tmp_path / "feed"), str(tmp_path / "log")
    for rows in (feed_rows((1, "a", 1, 1), (2, "b", 1, 1)), feed_rows((3, "a", 1, 2))):
        write_feed(spark, feed, rows)
        run_ingest(read_feed(spark, feed), log, str(tmp_path / "state"))
    before = content(record_log.current(spark, log))
    write_feed(spark, feed, feed_rows((4, "b", 1, 3)))
    run_ingest(read_feed(spark, feed), log, str(tmp_path / "another state"))
    assert before == [("a", 1, 2), ("b", 1, 1)]
    assert content(record_log.current(spark, log)) == [("a", 1, 2), ("b", 1, 3)]
    assert record_log.read_log(spark, log).count() == 3 + 4


def test_routing_needs_the_duplicate_key_setting(spark):
    key = "spark.sql.variant.allowDuplicateKeys"
    spark.conf.set(key, "false")
    try:
        with pytest.raises(ValueError, match=key):
            payload.route(spark.createDataFrame([(1, "")], "seq bigint, data string"))
    finally:
        spark.conf.set(key, "true")


def test_pending_merges_copies_and_sees_corrections(spark):
    from pulseframe.operators.keyed import pending

    raw = spark.createDataFrame([("a", 1, 5), ("b", 1, 6), ("c", 1, 7)], "citizen_id string, timestamp bigint, seq bigint")
    done = spark.createDataFrame([("a", 1, 5)] * 500 + [("b", 1, 2)] * 500, raw.schema)
    left = pending(raw, done, ["citizen_id", "timestamp", "seq"])
    assert sorted(r["citizen_id"] for r in left.collect()) == ["b", "c"]
    plan = pending(raw, done)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan
