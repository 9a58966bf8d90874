"""Event time: windows and sessions per citizen, and a monitor that keeps state per citizen.

All take kept records (see ``payload.route``), batch and streaming frames alike where the function returns a
frame. A watermark trails the newest record by ``delay``: windows are emitted once it has passed their end, records that
come after their window was emitted are dropped and counted (``late_rows``; each micro-batch is judged by the watermark
of the one before). Results are written per micro-batch,
a repeated one replaces itself; state and progress are in the checkpoint, so a query that is started again goes on.

A bounded replay ends with the ``closing`` record, which lies so far ahead that it closes everything before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulseframe import fixed
from pulseframe.session import read_partitioned, ship_package

#: the citizen of the closing record, which no result contains
CLOSING = "_closing"
EVENT_TIME = "event_time"


def timed(rows: DataFrame, delay: str) -> DataFrame:
    """Records with their event time and its watermark."""
    stamped = rows.where(F.col(fixed.TIMESTAMP).isNotNull()).withColumn(EVENT_TIME, F.timestamp_millis(fixed.TIMESTAMP))
    return stamped.withWatermark(EVENT_TIME, delay)


def closing(spark: SparkSession, after_ms: int) -> DataFrame:
    """The record that closes all windows that end before ``after_ms``."""
    values = {fixed.CITIZEN: CLOSING, fixed.TIMESTAMP: after_ms, fixed.HEART_RATE: fixed.HEART_RATE_RANGE[0]}
    return spark.range(1).select(*[F.lit(values.get(c, 0)).alias(c) for c in fixed.RAW_COLUMNS])


def _readings() -> list:
    return [
        F.count(F.lit(1)).alias("n"),
        F.min(fixed.HEART_RATE).alias("least_rate"),
        F.max(fixed.HEART_RATE).alias("most_rate"),
        F.count_if(F.col(fixed.O2) < 0.95).alias("low_o2"),
        F.sum(fixed.CALORIES).alias("calories"),
    ]


def _bounded(grouped: DataFrame) -> DataFrame:
    bounds = [F.unix_millis("window.start").alias("start_ms"), F.unix_millis("window.end").alias("end_ms")]
    return grouped.select(fixed.CITIZEN, *bounds, *[c for c in grouped.columns if c not in (fixed.CITIZEN, "window")])


def window_readings(rows: DataFrame, length: str, slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Readings per citizen and tumbling (or sliding) window."""
    window = F.window(EVENT_TIME, length, slide).alias("window")
    return _bounded(timed(rows, delay).groupBy(window, fixed.CITIZEN).agg(*_readings()))


def session_readings(rows: DataFrame, gap: str, delay: str = "10 minutes") -> DataFrame:
    """Readings per citizen and session; a session ends ``gap`` after its last reading."""
    window = F.session_window(EVENT_TIME, gap).alias("window")
    return _bounded(timed(rows, delay).groupBy(window, fixed.CITIZEN).agg(*_readings()))


# ------------------------------------------------------------------------------- monitor

SILENT, STREAK = "silent", "streak"
ALERTS = T.StructType(
    [
        T.StructField(fixed.CITIZEN, T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("at_ms", T.LongType()),
        T.StructField("seen", T.LongType()),
    ]
)
#: citizens are dealt over so many groups: a call of Python per group, not per citizen
GROUPS = 1024
#: per citizen of a group: last record's time, records so far, unusual ones in a row, whether the silence after the last was told
_STATE = "citizens array<string>, last array<long>, seen array<long>, streak array<long>, told array<boolean>"


def _monitor(silence: int, streak: int, usual: tuple[float, float]):
    def follow(citizen: str | None, known: tuple, times: list, odd: list, alerts: list) -> tuple:
        last, seen, run, told = known
        for t, strange in zip(times, odd):
            if last is not None and t < last:
                continue  # its place in the order has passed
            if last is not None and t - last > silence and not told:
                alerts.append((citizen, SILENT, last, seen))
            last, seen, run, told = t, seen + 1, run + 1 if strange else 0, False
            if run == streak:
                alerts.append((citizen, STREAK, t, seen))
        return last, seen, run, told

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = {c: values for c, *values in zip(*state.get)} if state.exists else {}
        alerts: list[tuple] = []
        if not state.hasTimedOut:
            # the group's records of one micro-batch, as three columns
            parts = [(c[fixed.CITIZEN].to_numpy(object), c[fixed.TIMESTAMP].to_numpy(np.int64), c[fixed.HEART_RATE].to_numpy(np.float64)) for c in chunks]
            citizen, time, rate = (np.concatenate(x) for x in zip(*parts))
            code, names = pd.factorize(citizen, use_na_sentinel=False)
            order = np.lexsort((rate, time, code))
            odd = ~((rate >= usual[0]) & (rate <= usual[1]))
            ends = np.cumsum(np.bincount(code, minlength=len(names))).tolist()
            times, strange = time[order].tolist(), odd[order].tolist()
            for name, begin, end in zip(names, [0, *ends], ends):
                name = None if pd.isna(name) else name
                known[name] = follow(name, known.get(name, (None, 0, 0, False)), times[begin:end], strange[begin:end], alerts)
        passed = state.getCurrentWatermarkMs()
        for name, (last, seen, run, told) in known.items():
            if not told and last + silence < passed:
                alerts.append((name, SILENT, last, seen))
                known[name] = last, seen, run, True
        state.update(([*known], *([*column] for column in zip(*known.values()))))
        waiting = [last for last, _, _, told in known.values() if not told]
        if waiting:
            state.setTimeoutTimestamp(min(waiting) + silence + 1)
        if alerts:
            yield pd.DataFrame(alerts, columns=ALERTS.fieldNames())

    return step


def alerts(
    rows: DataFrame, silence_ms: int, streak: int = 3, usual: tuple[float, float] = (60.0, 100.0), delay: str = "10 minutes"
) -> DataFrame:
    """A stream of alerts per citizen: ``silent`` (at the last record before ``silence_ms`` without one) and ``streak`` (at the
    record with which ``streak`` in a row have an unusual heart rate). ``seen`` counts the citizen's records up to then.

    State is four numbers per citizen, kept by groups of citizens: a micro-batch writes those of all citizens of the groups it
    touches. Silence is told by a timer where no record follows, so it does not wait
    for the next one. Records must arrive in order within ``delay`` between micro-batches; inside one they are sorted.
    """
    ship_package(rows.sparkSession)
    group = F.pmod(F.xxhash64(fixed.CITIZEN), F.lit(GROUPS)).alias("group")
    inputs = timed(rows, delay).select(group, fixed.CITIZEN, fixed.TIMESTAMP, fixed.HEART_RATE, EVENT_TIME)
    return inputs.groupBy("group").applyInPandasWithState(
        _monitor(silence_ms, streak, usual), ALERTS, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


# ------------------------------------------------------------------------------- running


def start(
    results: DataFrame, path: str, checkpoint: str, interval: str | None = None, state_partitions: int | None = None
) -> StreamingQuery:
    """Write what each micro-batch emits to its own folder below ``path``. Without an ``interval`` the query handles
    what is available and ends. The number of state partitions (by default the session's shuffle partitions) is fixed
    when the checkpoint is first used."""
    spark = results.sparkSession

    def keep(batch: DataFrame, number: int) -> None:
        batch.where(F.col(fixed.CITIZEN) != CLOSING).write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = results.writeStream.outputMode("append").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(**trigger)
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if state_partitions:
        spark.conf.set(name, str(state_partitions))  # the query takes its settings when it starts
    try:
        return writer.start()
    finally:
        spark.conf.set(name, before)


def run(results: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None) -> int:
    """Handle what is available. Returns the number of late records that were dropped."""
    query = start(results, path, checkpoint, state_partitions=state_partitions)
    query.awaitTermination()
    return late_rows(query)


def late_rows(query: StreamingQuery) -> int:
    """Records that came after the watermark had passed their window, in the progress that is kept."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


def read(results: DataFrame, path: str) -> DataFrame:
    """What a query of the shape of ``results`` has written."""
    schema = T.StructType([*results.schema.fields, T.StructField("batch_id", T.LongType())])
    return read_partitioned(results.sparkSession, path, schema).drop("batch_id")
