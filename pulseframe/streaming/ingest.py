"""Continuous ingest: payload stream -> routed record log."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pulseframe.session import folder_exists
from pulseframe.sinks.files import read_document, write_document
from pulseframe.sources.payload import route
from pulseframe.sources.record_log import append_batch

FEED_SCHEMA = "seq BIGINT, data STRING"


def read_feed(
    spark: SparkSession, path: str, file_format: str = "json", schema: str = FEED_SCHEMA, **options
) -> DataFrame:
    """A folder of feed files as a stream. Any streaming source with the columns ``seq``
    (position within the feed) and ``data`` (base64 text) serves as well."""
    return spark.readStream.format(file_format).schema(schema).options(**options).load(path)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The name under which the stream of a checkpoint writes. It is chosen when the stream first starts and
    kept in the checkpoint; a lost checkpoint means a new name, so no older batch is overwritten."""
    kept = f"{checkpoint.rstrip('/')}/_stream_name"
    if not folder_exists(spark, kept):
        name = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        write_document(spark, {"stream": name}, kept)
    return read_document(spark, kept)["stream"]


def start_ingest(
    feed: DataFrame, log_path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Route every micro-batch into the log: one scan, one write, no shuffle.

    The sink is told each micro-batch's number and replaces that batch's folder of this stream, so a
    batch repeated after a failure leaves the same content, and several streams may fill one log.
    Without an ``interval`` the query handles what is available and ends.
    """
    stream = stream_name(feed.sparkSession, checkpoint)
    routed = route(feed)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        routed.writeStream.foreachBatch(lambda batch, number: append_batch(batch, log_path, number, stream))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_ingest(feed: DataFrame, log_path: str, checkpoint: str) -> None:
    start_ingest(feed, log_path, checkpoint).awaitTermination()
