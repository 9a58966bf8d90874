"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulseframe.session import materialize, scratch_path


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the undirected ``edges`` (a, b, long): the smallest node reachable.

    Each round every node takes its smallest neighbour's id, chains are followed once, and the edges
    are relabelled; stars, the usual shape of copies, take one round and paths shrink by at least half.
    Every round is written, so no lineage grows and a lost executor costs one round.
    """
    spark = edges.sparkSession

    def keep(df: DataFrame, name: str) -> DataFrame:
        return materialize(df, scratch_path(spark, name))

    edges = keep(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = keep(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")).select(F.col("a").alias("node"), "to"), "step")
        step = keep(_follow(step, step), "step")
        labels = step.withColumnRenamed("to", "label") if labels is None else _relabel(labels, step)
        labels = keep(labels, "labels")
        edges = _ends(_ends(edges, step, "a"), step, "b").where("a <> b")
        edges = keep(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def _follow(steps: DataFrame, onwards: DataFrame) -> DataFrame:
    """Each step continued by the step of where it leads."""
    nxt = onwards.select(F.col("node").alias("to"), F.col("to").alias("_next"))
    return steps.join(nxt, "to", "left").select("node", F.coalesce("_next", "to").alias("to"))


def _relabel(labels: DataFrame, step: DataFrame) -> DataFrame:
    nxt = step.select(F.col("node").alias("label"), F.col("to").alias("_next"))
    return labels.join(nxt, "label", "left").select("node", F.coalesce("_next", "label").alias("label"))


def _ends(edges: DataFrame, step: DataFrame, end: str) -> DataFrame:
    nxt = step.select(F.col("node").alias(end), F.col("to").alias("_next"))
    other = "b" if end == "a" else "a"
    return edges.join(nxt, end, "left").select(F.coalesce("_next", end).alias(end), other)
