import random

import pytest
from pyspark.sql import functions as F

from pulseframe import fixed
from pulseframe.streaming import events

SCHEMA = "citizen_id string, timestamp bigint, average_heart_beat_rate double, o2_content double, sleep_time double, calories_burned int"
MINUTE = 60_000


def records(rows):
    return [(c, t * MINUTE, float(rate), 0.94 if t % 2 else 0.98, 7.0, t) for c, t, rate in rows]


def write(spark, folder, rows):
    spark.createDataFrame(records(rows), SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(folder)


def close(spark, folder, minute):
    last = events.closing(spark, minute * MINUTE)
    last.select(*[F.col(f.name).cast(f.dataType) for f in spark.createDataFrame([], SCHEMA).schema.fields]).coalesce(1).write.mode("append").parquet(folder)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def deliveries(seed):
    """Records in order of time, but for a shuffle within ten minutes, in four deliveries."""
    rng = random.Random(seed)
    rows = [(rng.choice("abc"), t, rng.choice([50, 70, 90, 130])) for t in sorted(rng.sample(range(1000), 120))]
    return [[r for r in rows if k * 250 <= r[1] < (k + 1) * 250] for k in range(4)]


@pytest.mark.parametrize(
    "shape", [lambda r: events.window_readings(r, "1 hour", "30 minutes"), lambda r: events.session_readings(r, "20 minutes")], ids=["windows", "sessions"]
)
def test_replay_with_a_restart_equals_batch(spark, tmp_path, shape):
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "checkpoint"))
    parts = deliveries(1)
    for part in parts[:2]:
        write(spark, feed, part)
    assert events.run(shape(stream(spark, feed)), out, checkpoint, 2) == 0
    for part in parts[2:]:
        write(spark, feed, part)
    close(spark, feed, 10_000)
    emitted = shape(stream(spark, feed))
    assert events.run(emitted, out, checkpoint, 2) == 0
    batch = shape(spark.createDataFrame(records(sum(parts, [])), SCHEMA))
    got = rows_of(events.read(emitted, out))
    assert got == rows_of(batch) and len(got) > 20
    events.run(emitted, out, checkpoint, 2)  # nothing new: nothing is emitted twice
    assert rows_of(events.read(emitted, out)) == got


def test_late_records_are_dropped_and_counted(spark, tmp_path):
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "checkpoint"))
    emitted = events.window_readings(stream(spark, feed_folder(spark, feed)), "1 hour", delay="10 minutes")
    write(spark, feed, [("a", 200, 80), ("a", 55, 80)])
    write(spark, feed, [("b", 201, 80)])  # lateness is judged by the watermark of the micro-batch before
    write(spark, feed, [("a", 195, 80), ("a", 50, 80)])  # the first is within the delay, the second 2 hours behind
    close(spark, feed, 10_000)
    assert events.run(emitted, out, checkpoint, 2) >= 1
    n = {r["start_ms"] // MINUTE: r["n"] for r in events.read(emitted, out).where("citizen_id = 'a'").collect()}
    assert n == {0: 1, 180: 2}


def feed_folder(spark, feed):
    write(spark, feed, [("b", 1, 80)])
    return feed


def plain_alerts(rows, silence, streak, low, high):
    out = []
    for c in {r[0] for r in rows}:
        mine, run = sorted((t, rate) for d, t, rate in rows if d == c), 0
        for i, (t, rate) in enumerate(mine):
            run = 0 if low <= rate <= high else run + 1
            if run == streak:
                out.append((c, events.STREAK, t * MINUTE, i + 1))
            if i + 1 == len(mine) or mine[i + 1][0] - t > silence:
                out.append((c, events.SILENT, t * MINUTE, i + 1))
    return sorted(out)


def test_monitor_keeps_its_state_over_restarts(spark, tmp_path):
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "checkpoint"))
    parts = deliveries(2)
    started = lambda: events.alerts(stream(spark, feed), 30 * MINUTE, 2)
    for part in parts:  # a restart after every delivery
        write(spark, feed, part)
        events.run(started(), out, checkpoint, 2)
    close(spark, feed, 10_000)
    emitted = started()
    events.run(emitted, out, checkpoint, 2)
    want = plain_alerts(sum(parts, []), 30, 2, 60, 100)
    assert rows_of(events.read(emitted, out)) == want and {k for _, k, _, _ in want} == {events.SILENT, events.STREAK}


def test_citizens_are_followed_by_groups(spark, tmp_path, monkeypatch):
    """One call of Python serves many citizens, and tells them apart: also where some are silent while others of their group go on."""
    monkeypatch.setattr(events, "GROUPS", 2)
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "checkpoint"))
    rng = random.Random(5)
    rows = [(f"c{rng.randrange(40)}", t, rng.choice([50, 70, 90, 130])) for t in sorted(rng.sample(range(2000), 600))]
    rows += [(c, t, rate) for c, t, rate in rows if t % 9 == 0]  # equal records
    started = lambda: events.alerts(stream(spark, feed), 100 * MINUTE, 2)
    for k in range(4):
        write(spark, feed, [r for r in rows if k * 500 <= r[1] < (k + 1) * 500])
        events.run(started(), out, checkpoint, 2)
    states = spark.read.format("statestore").load(checkpoint)
    assert states.count() == 2
    close(spark, feed, 10_000)
    emitted = started()
    events.run(emitted, out, checkpoint, 2)
    assert rows_of(events.read(emitted, out)) == plain_alerts(rows, 100, 2, 60, 100)


def test_silence_is_told_without_a_further_record_of_the_citizen(spark, tmp_path):
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "checkpoint"))
    write(spark, feed, [("a", 10, 80), ("b", 10, 80)])
    write(spark, feed, [("b", 20, 80), ("b", 60, 80)])
    emitted = events.alerts(stream(spark, feed), 30 * MINUTE, delay="1 minute")
    events.run(emitted, out, checkpoint, 2)
    assert rows_of(events.read(emitted, out)) == [("a", "silent", 10 * MINUTE, 1), ("b", "silent", 20 * MINUTE, 2)]


def test_settings_stay(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    write(spark, str(tmp_path / "feed"), [("a", 10, 80)])
    emitted = events.session_readings(stream(spark, str(tmp_path / "feed")), "5 minutes")
    events.run(emitted, str(tmp_path / "out"), str(tmp_path / "checkpoint"), 3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert events.read(emitted, str(tmp_path / "out")).isEmpty()  # the session is open
    assert fixed.CITIZEN in emitted.columns
