"""Raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``. All stages but the last
return the columns of ``docs``; ``n_chars``, where there is one, follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseframe.llm import lines, near, pack, pii, quality
from pulseframe.session import materialize, scratch_path

VOCABULARY = "word_bpe_49k.json"


def _rewritten(docs: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The texts as ``operator`` returns them, with n_chars as their length. The other columns pass under
    names that no operator uses."""
    aside = {c: c if c in ("doc_id", "text") else f"column {i}" for i, c in enumerate(docs.columns)}
    out = operator(docs.select(*[F.col(f"`{c}`").alias(name) for c, name in aside.items()]))
    columns = {c: F.col(f"`{name}`") for c, name in aside.items()}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[column.alias(c) for c, column in columns.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy accepts."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a document with a smaller id holds."""
    return _rewritten(docs, lines.dedup_lines)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words a shingle, similarity 0.8.

    Documents without id or without words are in no group and stay.
    """
    groups = near.near_duplicates(docs.select("doc_id", "text"))
    away = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_away")).distinct()
    return docs.join(away, F.col("doc_id") == F.col("_away"), "left_anti")


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _rewritten(docs, pii.redact)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 4,096 tokens mixed by source."""
    return pack.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("pii_redaction", pii_redaction),
    ("packing", packing),
]

#: cutting documents into sequences of tokens has no SQL; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), scratch_path(spark, name))
    return STAGES[-1][1](spark, docs, sf_dir)
