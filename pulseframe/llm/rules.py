"""A quality classifier made of sparse rules.

A forest of shallow trees is grown on statistics of labelled texts. Every path from a root to a node is a
conjunction of comparisons: a rule. A logistic regression with a lasso penalty over the rules (1 where a text
meets a rule) leaves most of them without weight; the others, with their weights, are compiled into one
Spark column over the statistics, which scores any number of texts without a model at hand.

The forest and the weights are fitted on about SAMPLE labelled documents, at most half of them of either
class if both have that many, and chosen by a hash of their ids; weights restore the shares of the classes, so
scores stay probabilities. A document is one example, however many rows or labels it has (of several, label 1
counts). Everything else covers all texts, whole.

Defined cases: a null text is the empty text; it has the statistics 0 and gets a score like any other; null ids
and null labels teach nothing; without any labelled text every score is 0.5; with labels of one class only every
score is that class; repeated rows are scored alike; an empty table gives an empty result; extra columns pass
through, and the result column ``score`` replaces one of that name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulseframe.llm import wordhash
from pulseframe.llm.batches import bound_batches
from pulseframe.session import materialize, scratch_path

#: labelled documents that teach the model: the bound on the sample (its expected size)
SAMPLE = 20_000
TREES = 24
DEPTH = 3
#: strength of the lasso
PENALTY = 0.002
SEED = 11

# ---------------------------------------------------------------------------- statistics

#: per text: its words, code points a word, shares of words that are distinct, of three-word windows that are
#: distinct, and of words that equal the word before; per word: symbols, punctuation marks and lines; per code
#: point: capitals A-Z, digits and bytes beyond ASCII; code points of the longest word (in bytes)
STATISTICS = (
    "n_words", "word_length", "distinct_words", "distinct_triples", "repeated_next", "symbols", "punctuation",
    "lines", "capitals", "digits", "beyond_ascii", "longest_word",
)

_BYTES = np.arange(256)
_SYMBOL = np.isin(_BYTES, list(b"#$%&*|<>@^~=+\\{}[]_"))
_MARK = np.isin(_BYTES, list(b".,;:!?'\"()-/"))
_CAPITAL = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)


def _statistics(body: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row per text, one column per name in STATISTICS."""
    words = wordhash.Words(body, ends, False, 1)
    n = len(ends) - 1
    n_words = np.diff(words.offset)
    text = np.repeat(np.arange(n), n_words)
    hashes = words.lanes[0]
    inside = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])]) if len(hashes) else np.zeros(0, bool)
    triples = wordhash.run_hashes(hashes, 3)
    whole = np.flatnonzero(text[: len(triples)] == text[len(text) - len(triples) :])
    n_triples = np.bincount(text[whole], minlength=n)
    begins = (body & 0xC0) != 0x80
    points = wordhash.per_text(begins, ends)
    letters = np.concatenate([[0], np.cumsum(begins)])
    word_points = letters[words.stop] - letters[words.start]
    longest = np.zeros(n)
    np.maximum.at(longest, text, word_points)
    per = lambda marks, base: wordhash.per_text(marks, ends) / np.maximum(base, 1)
    return np.column_stack([
        n_words,
        np.bincount(text, word_points, n) / np.maximum(n_words, 1),
        wordhash.distinct_per_text(hashes, text, n) / np.maximum(n_words, 1),
        wordhash.distinct_per_text(triples[whole], text[whole], n) / np.maximum(n_triples, 1),
        np.bincount(text, inside, n) / np.maximum(n_words, 1),
        per(_SYMBOL[body], n_words), per(_MARK[body], n_words), per(body == 10, n_words),
        per(_CAPITAL[body], points), per(_DIGIT[body], points), per((body >= 0xC0), points),
        longest,
    ]).astype(np.float64)


def _measuring(text: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = wordhash.text_bytes(wordhash.strings(batch.column(text)))
            parts = [_statistics(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a]) for a, b in wordhash.slices(ends)]
            table = np.concatenate(parts) if parts else np.empty((0, len(STATISTICS)))
            columns = [c for i, c in enumerate(batch.columns) if i != text]
            names = [x for i, x in enumerate(batch.schema.names) if i != text]
            found = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in table.T], list(STATISTICS))
            yield pa.RecordBatch.from_arrays([*columns, found], [*names, "_statistics"])

    return of_batches


def measure(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with the struct ``_statistics`` of the text in place of the text."""
    bound_batches(rows.sparkSession)
    rest = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != text]
    schema = ", ".join([*rest, "_statistics struct<" + ",".join(f"{s}:double" for s in STATISTICS) + ">"])
    return rows.mapInArrow(_measuring(rows.columns.index(text)), schema)


# --------------------------------------------------------------------------------- rules


@dataclass(frozen=True)
class Rule:
    """Bounds on statistics: (name, above, up to); None where there is none."""

    bounds: tuple[tuple[str, float | None, float | None], ...]
    weight: float = 0.0

    def column(self) -> Column:
        met = F.lit(True)
        for name, above, up_to in self.bounds:
            value = F.col(f"_statistics.{name}")
            if above is not None:
                met = met & (value > above)
            if up_to is not None:
                met = met & (value <= up_to)
        return met

    def __str__(self) -> str:
        tests = [f"{s} > {a:.6g}" for s, a, _ in self.bounds if a is not None] + [f"{s} <= {b:.6g}" for s, _, b in self.bounds if b is not None]
        return " AND ".join(tests)


@dataclass(frozen=True)
class Model:
    rules: tuple[Rule, ...]  # those with weight
    intercept: float

    def column(self) -> Column:
        """The score as an expression over ``_statistics``."""
        odds = F.lit(self.intercept)
        for rule in self.rules:
            odds = odds + F.when(rule.column(), rule.weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-odds))

    def table(self, spark: SparkSession) -> DataFrame:
        """(rule, weight), heaviest first."""
        rows = sorted(((str(r), r.weight) for r in self.rules), key=lambda r: -abs(r[1]))
        return spark.createDataFrame(rows, "rule string, weight double")


def tree_paths(model: RandomForestClassificationModel) -> list[Rule]:
    """The distinct paths from the roots to all other nodes, bounds on one statistic merged."""
    found: dict[tuple, None] = {}

    def walk(node, bounds: dict[str, tuple]) -> None:
        if bounds:
            found[tuple((s, *bounds[s]) for s in STATISTICS if s in bounds)] = None
        if node.getClass().getSimpleName() != "InternalNode":
            return
        name, at = STATISTICS[node.split().featureIndex()], node.split().threshold()
        above, up_to = bounds.get(name, (None, None))
        walk(node.leftChild(), {**bounds, name: (above, at if up_to is None else min(at, up_to))})
        walk(node.rightChild(), {**bounds, name: (at if above is None else max(at, above), up_to)})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return [Rule(bounds) for bounds in found]


def examples(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(doc_id, y, weight, _statistics) of about ``sample`` labelled documents, one row per document."""
    spark = docs.sparkSession
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    per_id = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.when(F.col(label) == 1, 1.0).otherwise(0.0)).alias("y"))
    n = {r["y"]: r["n"] for r in per_id.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows at most
    half = sample / 2
    quota = {y: max(half, sample - sum(n.get(z, 0) for z in (0.0, 1.0) if z != y)) for y in n}
    chosen, weight = F.lit(False), F.lit(1.0)
    place = F.pmod(F.xxhash64(F.lit(SEED), F.col("doc_id")), F.lit(1 << 30)) / (1 << 30)
    for y, count in n.items():
        share = min(1.0, quota[y] / count)
        chosen = F.when(F.col("y") == y, place < share).otherwise(chosen)
        weight = F.when(F.col("y") == y, 1.0 / share).otherwise(weight)
    some = per_id.where(chosen).withColumn("weight", weight)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    measured = measure(texts.join(F.broadcast(some), "doc_id"))  # the sample is bounded
    return materialize(
        measured.groupBy("doc_id", "y", "weight").agg(F.min("_statistics").alias("_statistics")), scratch_path(spark, "examples")
    )


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, penalty: float = PENALTY) -> Model:
    """A model of ``label`` (0 or 1) from the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, label) names."""
    rows = examples(docs, labels, label, sample)
    shares = rows.agg(F.avg("y").alias("y"), F.sum("weight").alias("weight")).first()
    if shares["y"] is None:
        return Model((), 0.0)
    if shares["y"] in (0.0, 1.0):
        return Model((), float("inf") if shares["y"] else float("-inf"))
    # the same rows in the same places, whatever the partitioning, as the forest draws by place
    rows = rows.repartition(2, "doc_id").sortWithinPartitions("doc_id")
    vector = array_to_vector(F.array(*[F.col(f"_statistics.{s}") for s in STATISTICS]))
    taught = rows.select("doc_id", "y", "weight", "_statistics", vector.alias("features")).persist()
    try:
        forest = RandomForestClassifier(
            featuresCol="features", labelCol="y", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, maxBins=64,
            featureSubsetStrategy="0.5", subsamplingRate=0.7, seed=SEED,
        ).fit(taught)
        rules = tree_paths(forest)
        met = array_to_vector(F.array(*[r.column().cast("double") for r in rules])) if rules else None
        if met is None:
            share = taught.agg((F.sum(F.col("y") * F.col("weight")) / F.sum("weight")).alias("p")).first()["p"]
            return Model((), float(np.log(share / (1 - share))))
        lasso = LogisticRegression(
            featuresCol="met", labelCol="y", weightCol="weight", elasticNetParam=1.0, regParam=penalty, maxIter=50
        ).fit(taught.select("y", "weight", met.alias("met")))
    finally:
        taught.unpersist()
    weighed = [Rule(r.bounds, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w]
    return Model(tuple(weighed), float(lasso.intercept))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``score``: the probability of label 1."""
    return measure(docs.drop("score", "_statistics"), text).withColumn("score", model.column()).drop("_statistics")
