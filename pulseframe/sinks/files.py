"""Outputs. Every table is written by its tasks in parallel as a folder of part files;
no rows pass through the driver."""

from __future__ import annotations

import json
import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseframe import fixed
from pulseframe.operators.report import json_records
from pulseframe.operators.scaling import Stats

log = logging.getLogger(__name__)


def write_processed(df: DataFrame, path: str) -> None:
    """All processed columns as unpartitioned Parquet."""
    df.write.mode("overwrite").parquet(path)


def write_training_csv(
    df: DataFrame, path: str, features: list[str] = fixed.SCALED_FEATURES, label: str = fixed.LABEL
) -> None:
    """Label first, no header."""
    df.select(label, *features).write.mode("overwrite").csv(path, header=False)


def stats_document(
    stats: Stats, train_count: int, val_count: int, total: int, as_of: datetime, digits: int | None = 6
) -> dict:
    def cut(value):
        return value if digits is None else round(value, digits)

    values = [
        list(stats),
        {c: {part: cut(v) for part, v in s.items()} for c, s in stats.items()},
        train_count,
        val_count,
        total,
        as_of.astimezone(timezone.utc).isoformat(),
    ]
    return dict(zip(fixed.STATISTICS_KEYS, values, strict=True))


def write_document(spark: SparkSession, document: dict, path: str) -> None:
    """One JSON object, such as the statistics."""
    text = spark.range(1).coalesce(1).select(F.lit(json.dumps(document)).alias("value"))
    text.write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def table_properties(
    total: int, train_count: int, val_count: int, n_features: int, as_of: datetime, source: str
) -> dict[str, str]:
    values = [total, train_count, val_count, n_features, as_of.astimezone(timezone.utc).isoformat(), source]
    return dict(zip(fixed.TABLE_PROPERTIES, map(str, values), strict=True))


def register_table(spark: SparkSession, name: str, path: str, properties: dict[str, str]) -> bool:
    """Put the Parquet folder in the catalog with its run properties; a table of the name is pointed to the
    folder. The data is already written, so a catalog failure is only reported."""
    quote = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    pairs = ", ".join(f"{quote(k)} = {quote(v)}" for k, v in properties.items())
    try:
        if spark.catalog.tableExists(name):
            spark.sql(f"ALTER TABLE {name} SET LOCATION {quote(path)}")
        else:
            spark.catalog.createTable(name, path=path, source="parquet")
        spark.catalog.refreshTable(name)
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
        return True
    except Exception as problem:
        log.warning("catalog update skipped: %s", problem)
        return False


def export_csv(df: DataFrame, directory: str, as_of: datetime, run: str | None = None) -> str | None:
    """Scored rows as CSV with a header under ``results_<time>``, followed by the run's name if there is one, so that two
    runs of one second stay apart; a repeated run replaces its own rows. Nothing for no rows.
    Pass a written or cached frame: the emptiness test reads it once more."""
    if df.isEmpty():
        return None
    path = f"{directory.rstrip('/')}/{fixed.RESULTS_PREFIX}{as_of.astimezone(timezone.utc):%Y%m%d%H%M%S}" + (f"_{run}" if run else "")
    df.write.mode("overwrite").csv(path, header=True)
    return path


def export_json(df: DataFrame, path: str) -> None:
    """One JSON object per line."""
    json_records(df).write.mode("overwrite").text(path)
