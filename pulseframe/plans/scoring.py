"""Scoring runs over the raw record log, and the analytics table they fill.

Rows are kept by run: ``<analytics>/run=<name>``, replaced when a run of the name is repeated. A run over
the table is named by its time to the microsecond, streamed scoring by the log batch it read, so that a
replayed batch replaces its rows. Each row carries the version of the record it was made from (stream,
batch, seq): a corrected record is scored again, and readers take one row per citizen, inference time
and record time, the one of the newest version.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from pulseframe import fixed
from pulseframe.operators.keyed import latest_by_key, pending
from pulseframe.operators.model import SCORED, score_all
from pulseframe.operators.profile import summary
from pulseframe.operators.report import json_records, report_rows
from pulseframe.operators.scaling import Stats
from pulseframe.session import read_partitioned
from pulseframe.sinks.files import export_csv
from pulseframe.sources.payload import KEPT
from pulseframe.sources.record_log import LOG_SCHEMA, ORDER, Marks, batch_path, beyond, current

#: version of a record, from the log; in the analytics table with a prefix
VERSION = {c: f"source_{c}" for c in ORDER}

#: log files that one trigger of the scheduled scoring takes
FILES_PER_TRIGGER = 1000

_TYPES = {
    "source_batch_id": T.LongType(),
    "source_seq": T.LongType(),
    fixed.TIMESTAMP: T.LongType(),
    fixed.HEART_RATE: T.DoubleType(),
    fixed.O2: T.DoubleType(),
    fixed.SLEEP: T.DoubleType(),
    fixed.CALORIES: T.IntegerType(),
}
ANALYTICS_SCHEMA = T.StructType(
    [T.StructField(c, _TYPES.get(c, T.StringType())) for c in [*fixed.ANALYTICS_COLUMNS, *VERSION.values(), "outcome", "reason", "run"]]
)


def run_name(as_of: datetime) -> str:
    return f"{as_of.astimezone(timezone.utc):%Y%m%dT%H%M%S%f}"


def read_runs(spark: SparkSession, path: str, may_be_missing: bool = False) -> DataFrame:
    """All rows of all runs, with outcome, reason, run and version."""
    return read_partitioned(spark, path, ANALYTICS_SCHEMA, may_be_missing)


def read_analytics(spark: SparkSession, path: str, outcome: str = SCORED, may_be_missing: bool = False) -> DataFrame:
    """The analytics table, with ``run`` and version: one row per citizen, inference time and record time."""
    rows = read_runs(spark, path, may_be_missing).where(F.col("outcome") == outcome).drop("outcome")
    keys = [*fixed.ANALYTICS_KEY, fixed.TIMESTAMP]
    return latest_by_key(rows, keys, [*VERSION.values(), "run"])


def _scored(raw: DataFrame, model: PipelineModel, stats: Stats, as_of: datetime) -> DataFrame:
    """Analytics rows of log records, each with the record's version."""
    named = raw.withColumnsRenamed(VERSION)
    return score_all(named, model, stats, as_of, carry=list(VERSION.values()))


def run_scoring(
    spark: SparkSession,
    raw_log: str,
    model: PipelineModel,
    stats: Stats,
    analytics: str,
    as_of: datetime,
    only_new: bool = False,
    results: str | None = None,
    after: Marks | None = None,
) -> str:
    """Score the raw table (or only record versions that no other run has handled), store the rows and
    optionally export them as CSV. Returns the run's name.

    ``after`` names the last batches known to be scored, which keeps the older part of the log and of the
    analytics table from being read at all.
    """
    run = run_name(as_of)
    raw = current(spark, raw_log, after=after).select(*ORDER, *fixed.RAW_COLUMNS)
    if only_new:
        others = read_runs(spark, analytics, may_be_missing=True).where(F.col("run") != run)
        others = others.withColumnsRenamed({name: c for c, name in VERSION.items()})
        if after is not None:
            others = others.where(beyond(after))
        raw = pending(raw, others, [*fixed.RAW_KEY, *ORDER])
    rows = _scored(raw, model, stats, as_of)
    rows.write.mode("overwrite").parquet(f"{analytics}/run={run}")
    if results:
        export_csv(analytics_of(spark, analytics, run).select(*fixed.ANALYTICS_COLUMNS), results, as_of, run)
    return run


def analytics_of(spark: SparkSession, analytics: str, run: str) -> DataFrame:
    """The scored rows of one run."""
    return read_analytics(spark, analytics).where(F.col("run") == run).drop("run")


def start_scoring(
    spark: SparkSession,
    raw_log: str,
    model: PipelineModel,
    stats: Stats,
    analytics: str,
    checkpoint: str,
    interval: str | None = "15 minutes",
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Score new records on a schedule: each trigger reads only log files added since the
    last one. Without an interval it handles what is there and ends.

    The files tell which log batches are new; those are read whole and their rows replaced. So neither a
    replayed batch nor a second checkpoint doubles rows, and a batch seen in parts loses none. A trigger takes
    ``files_per_trigger`` files at most, so a first run over an old log works through it step by step, and the
    driver never lists more folders than that.
    """
    source = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
    added = source.option("basePath", raw_log).parquet(raw_log)
    added = added.where(F.col("route") == KEPT)

    def score_batch(batch: DataFrame, number: int) -> None:
        new = batch.select("stream", "batch_id").distinct().collect()
        if not new:
            return
        folders = [batch_path(raw_log, r["batch_id"], r["stream"]) for r in new]
        whole = spark.read.schema(LOG_SCHEMA).option("basePath", raw_log).parquet(*folders).where(F.col("route") == KEPT)
        newest = latest_by_key(whole, [*fixed.RAW_KEY, "stream", "batch_id"], ORDER).select(*ORDER, *fixed.RAW_COLUMNS)
        rows = _scored(newest, model, stats, clock())
        rows = rows.withColumn("run", F.concat_ws(".", "source_stream", "source_batch_id"))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("run").parquet(analytics)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        added.writeStream.foreachBatch(score_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def newest_classes(rows: DataFrame) -> DataFrame:
    """One row per record (citizen and record time): that of its newest version, last scored."""
    return latest_by_key(rows, fixed.RAW_KEY, [*VERSION.values(), fixed.INFERENCE_TS, "run"])


def dashboard(spark: SparkSession, analytics: str) -> dict[str, DataFrame]:
    """What the dashboard shows: counters, display rows, latest row per citizen, JSON."""
    rows = read_analytics(spark, analytics).select(*fixed.ANALYTICS_COLUMNS)
    latest = latest_by_key(rows, [fixed.CITIZEN], [fixed.INFERENCE_TS, fixed.TIMESTAMP])
    return {
        "summary": summary(rows),
        "rows": report_rows(rows),
        "latest": report_rows(latest),
        "json": json_records(rows),
    }
