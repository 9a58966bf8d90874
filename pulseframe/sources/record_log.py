"""The keyed record table on plain Parquet.

Records are appended as ``<path>/stream=S/group=G/batch_id=N/route=...``; a batch written again replaces
its own folder, so replays change nothing, and streams never touch each other's folders. The table's
content is the last record per key by (stream, batch_id, seq): a stream's name begins with the time it
was first started, so what a stream that began anew has read again counts as newer.

``write_snapshot`` stores the content and the last batch of each stream it holds, and then a pointer to
it in the log. Readers start from there and list only the groups of GROUP batches that may hold newer ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pulseframe import fixed
from pulseframe.operators.keyed import latest_by_key
from pulseframe.session import child_folders, folder_exists, read_partitioned
from pulseframe.sinks.files import read_document, write_document
from pulseframe.sources.payload import KEPT

ORDER = ["stream", "batch_id", "seq"]
#: the stream of batches that were appended by hand
BY_HAND = "0"
#: batches in one folder of folders
GROUP = 1000
POINTER = "_snapshot"

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField(fixed.CITIZEN, T.StringType()),
        T.StructField(fixed.TIMESTAMP, T.LongType()),
        T.StructField(fixed.HEART_RATE, T.DoubleType()),
        T.StructField(fixed.O2, T.DoubleType()),
        T.StructField(fixed.SLEEP, T.DoubleType()),
        T.StructField(fixed.CALORIES, T.IntegerType()),
        T.StructField("reason", T.StringType()),
        T.StructField("data", T.StringType()),
    ]
)
LOG_SCHEMA = T.StructType(
    RECORD_SCHEMA.fields
    + [
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("route", T.StringType()),
    ]
)

#: last batch per stream; one number stands for the batches appended by hand
Marks = dict[str, int] | int


def batch_path(path: str, batch_id: int, stream: str = BY_HAND) -> str:
    return f"{path}/stream={stream}/group={batch_id // GROUP}/batch_id={batch_id}"


def append_batch(routed: DataFrame, path: str, batch_id: int, stream: str = BY_HAND) -> None:
    """Write one routed batch in a single pass; the payload text is kept only for
    records that were not accepted."""
    rows = routed.withColumn("data", F.when(F.col("route") != KEPT, F.col("data")))
    rows = rows.select(*RECORD_SCHEMA.fieldNames(), "route")
    rows.write.mode("overwrite").partitionBy("route").parquet(batch_path(path, batch_id, stream))


def _marks(marks: Marks | None) -> dict[str, int]:
    return {BY_HAND: marks} if isinstance(marks, int) else dict(marks or {})


def beyond(marks: Marks) -> Column:
    """Batches after the marks; a stream without a mark is new."""
    known = [(F.col("stream") == s) & (F.col("batch_id") <= n) for s, n in _marks(marks).items()]
    return ~reduce(lambda a, b: a | b, known) if known else F.lit(True)


def newer_folders(spark: SparkSession, path: str, marks: dict[str, int]) -> list[str]:
    """The group folders that may hold batches after the marks."""
    found = []
    for stream in child_folders(spark, path):
        first = marks.get(stream.partition("=")[2], -1) // GROUP
        groups = child_folders(spark, f"{path}/{stream}")
        found += [f"{path}/{stream}/{g}" for g in groups if int(g.partition("=")[2]) >= first]
    return found


def read_log(spark: SparkSession, path: str, route: str | None = KEPT, after: Marks | None = None) -> DataFrame:
    """The appended records, all or those of batches after the marks; stream, batch and route are
    partition columns, so they prune files."""
    marks = _marks(after)
    if marks:
        folders = newer_folders(spark, path, marks)
        log = spark.createDataFrame([], LOG_SCHEMA)
        if folders:
            log = spark.read.schema(LOG_SCHEMA).option("basePath", path).parquet(*folders).where(beyond(marks))
    else:
        log = read_partitioned(spark, path, LOG_SCHEMA)
    if route is None:
        return log
    return log.where(F.col("route") == route).select(*ORDER, *fixed.RAW_COLUMNS)


def ingest_counts(spark: SparkSession, path: str) -> DataFrame:
    """Records per stream, batch and route, counted from file metadata and partition values."""
    return read_log(spark, path, None).groupBy("stream", "batch_id", "route").count()


def published_snapshot(spark: SparkSession, path: str) -> tuple[str, dict[str, int]] | None:
    """Folder and marks of the snapshot that the log points to."""
    if not folder_exists(spark, f"{path}/{POINTER}"):
        return None
    found = read_document(spark, f"{path}/{POINTER}")
    return found["folder"], found["marks"]


def current(
    spark: SparkSession, path: str, keys: list[str] = fixed.RAW_KEY, after: Marks | None = None, snapshot: bool = True
) -> DataFrame:
    """The table's content, read from the published snapshot, if there is one, and the batches after it.
    ``after`` gives only what the batches after these marks wrote."""
    stored = published_snapshot(spark, path) if snapshot and after is None else None
    if stored is None:
        return latest_by_key(read_log(spark, path, after=after), keys, ORDER)
    rows = read_log(spark, path, after=stored[1])
    rows = spark.read.schema(rows.schema).parquet(stored[0]).unionByName(rows)
    return latest_by_key(rows, keys, ORDER)


def write_snapshot(spark: SparkSession, path: str, out: str, upto: Marks | None = None) -> dict[str, int]:
    """Store the content, as of the marks if given, in the new folder ``out`` and publish it. Starts from the
    snapshot before. Returns the marks of what it holds."""
    stored = published_snapshot(spark, path)
    before = stored[1] if stored else {}
    rows = read_log(spark, path, after=before or None)
    if upto is not None:
        rows = rows.where(~beyond(upto))
    # the marks come first: a batch that arrives meanwhile is read again, not lost
    newest = {r["stream"]: r["last"] for r in rows.groupBy("stream").agg(F.max("batch_id").alias("last")).collect()}
    marks = {**before, **newest}
    rows = rows.where(~beyond(marks)) if marks else rows
    if stored:
        rows = spark.read.schema(rows.schema).parquet(stored[0]).unionByName(rows)
    latest_by_key(rows, fixed.RAW_KEY, ORDER).write.mode("errorifexists").parquet(out)
    write_document(spark, {"folder": out, "marks": marks}, f"{path}/{POINTER}")
    return marks
