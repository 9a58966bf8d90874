"""Boosted-tree classification, as MLlib models."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulseframe import fixed
from pulseframe.functions import clip, log_loss
from pulseframe.operators import boosting
from pulseframe.operators.features import engineer
from pulseframe.operators.levelwise import LevelwiseClassifier
from pulseframe.operators.report import add_classification, stamp, with_defaults
from pulseframe.operators.scaling import Stats, scale
from pulseframe.session import shared_dir
from pulseframe.sinks.files import read_document, write_document

PROBABILITY = "probability_unhealthy"
SCORED, FAILED = "scored", "failed"


def feature_vector(df: DataFrame, cols: list[str] = fixed.VITALS, out: str = "features") -> DataFrame:
    """The columns as an ARRAY<DOUBLE> in fixed order, missing values as 0."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]
    return df.withColumn(out, F.array(*values))


def prepare(df: DataFrame, stats: Stats | DataFrame) -> DataFrame:
    """Model inputs of raw records: clipping, engineering and scaling, exactly as for training. A missing
    value counts as 0 (``score_all`` decides whether such a record is scored). The record's own columns
    stay untouched beside the inputs."""
    own = F.struct(*df.columns).alias("_record")
    inputs = with_defaults(df.select(own, *fixed.VITALS), {c: 0 for c in fixed.VITALS})
    inputs = inputs.withColumns({c: clip(F.col(c), *bounds) for c, bounds in fixed.CLIP_RANGES.items()})
    return scale(engineer(inputs), stats).select("_record", *fixed.SCALED_FEATURES)


def best_round(losses: list[float], patience: int) -> int:
    """Number of rounds to keep: the best one before ``patience`` rounds without gain."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def assembler(features: list[str]) -> VectorAssembler:
    """The model's input vector; missing values are NaN."""
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")


def train(
    train_df: DataFrame,
    validation_df: DataFrame | None = None,
    features: list[str] = fixed.SCALED_FEATURES,
    label: str = fixed.LABEL,
    growth: str = "leaf",
    state: str | None = None,
    **overrides,
) -> PipelineModel:
    """Fit a boosted-tree classifier; with a validation frame, the trees of the best rounds are kept.

    ``growth="leaf"`` splits the leaf of the largest gain next and ends the fit when the validation loss stops
    improving; ``state`` is a folder from which an interrupted fit goes on (see ``boosting``).
    ``growth="level"`` is MLlib's fit over blocks of rows (see ``levelwise``), always of all rounds: the leaf limit
    becomes the depth whose full tree has as many leaves, features are drawn per node, and rows in every round.

    On a cluster the rounds' lineage is cut in the folder named by ``spark.checkpoint.dir``.
    """
    p = {**fixed.BOOSTING, **overrides}
    unknown = set(p) - set(fixed.BOOSTING)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    if growth not in ("leaf", "level"):
        raise ValueError(f"unknown growth: {growth}")
    inputs = assembler(features)
    if growth == "leaf":
        return PipelineModel([inputs, boosting.to_mllib(boosting.fit(train_df, validation_df, features, label, p, state))])
    learner = LevelwiseClassifier(
        featuresCol="features",
        labelCol=label,
        lossType="logistic",
        maxIter=p["rounds"],
        maxDepth=max(1, (p["leaves"] - 1).bit_length()),
        stepSize=p["learning_rate"],
        featureSubsetStrategy=str(p["feature_fraction"]),
        subsamplingRate=p["bagging_fraction"],
        minInstancesPerNode=p["min_data_in_leaf"],
        seed=p["seed"],
    )
    cluster_checkpoints(train_df.sparkSession)
    data = inputs.transform(train_df).select("features", F.col(label).cast("double")).persist()
    try:
        model = learner.fit(data)
        if validation_df is not None and p["early_stopping_rounds"]:
            held_out = inputs.transform(validation_df).select("features", F.col(label).cast("double"))
            if not held_out.isEmpty():
                rounds = best_round(model.evaluateEachIteration(held_out), p["early_stopping_rounds"])
                model = first_trees(model, rounds)
    finally:
        data.unpersist()
    return PipelineModel([inputs, model])


def cluster_checkpoints(spark: SparkSession) -> None:
    """Long iterative fits on a cluster need a checkpoint folder that survives executors."""
    sc = spark.sparkContext
    if not sc.master.startswith("local") or spark.conf.get("spark.checkpoint.dir", None):
        sc.setCheckpointDir(shared_dir(spark))


def first_trees(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` trees of a fitted one."""
    if rounds >= model.getNumTrees:
        return model
    fitted, gateway = model._java_obj, SparkSession.active().sparkContext._gateway
    kind = gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees, weights = gateway.new_array(kind, rounds), gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = fitted.trees()[i], fitted.treeWeights()[i]
    shorter = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        fitted.uid(), trees, weights, fitted.numFeatures()
    )
    fitted.copyValues(shorter, fitted.extractParamMap())
    return GBTClassificationModel(shorter)


def predict(df: DataFrame, model: PipelineModel, out: str = PROBABILITY) -> DataFrame:
    """Add the probability of class 1."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(out))


def evaluate(df: DataFrame, probability: str = PROBABILITY, label: str = fixed.LABEL) -> DataFrame:
    """Binary log loss over the scored rows, and how many rows are scored and not."""
    p = F.col(probability)
    return df.agg(
        log_loss(F.col(label), p).alias("log_loss"),
        F.count(p).alias("n"),
        F.count_if(p.isNull()).alias("unscored"),
    )


def confusion(df: DataFrame, probability: str = PROBABILITY, label: str = fixed.LABEL) -> DataFrame:
    """Rows per (label, predicted class)."""
    return add_classification(df, probability).groupBy(label, fixed.CLASSIFICATION).count()


NO_CITIZEN, NO_READING, NO_PROBABILITY = "no citizen", "missing reading", "no probability"


def score_all(
    df: DataFrame,
    model: PipelineModel,
    stats: Stats | DataFrame,
    as_of: datetime | Column,
    carry: list[str] | None = None,
    missing_as_zero: bool = False,
) -> DataFrame:
    """Classify raw records and say per row whether that worked (``outcome``), and why not (``reason``).

    A record fails when it has no citizen, lacks a reading, or gets no usable probability; failures are
    rows too, without a class, so nothing is lost silently. ``missing_as_zero`` scores records that lack
    a reading with 0 in its place. ``carry`` names further columns to keep.
    """
    scored = predict(prepare(df, stats), model).select("_record.*", PROBABILITY)
    rows = stamp(add_classification(scored, PROBABILITY), as_of)
    lacking = F.lit(False) if missing_as_zero else F.greatest(*[F.col(c).isNull() for c in fixed.VITALS])
    reason = (
        F.when(F.col(fixed.CITIZEN).isNull(), NO_CITIZEN)
        .when(lacking, NO_READING)
        .when(F.col(fixed.CLASSIFICATION).isNull(), NO_PROBABILITY)
    )
    rows = rows.withColumn("reason", reason)
    outcome = F.when(F.col("reason").isNull(), SCORED).otherwise(FAILED)
    rows = rows.withColumns(
        {"outcome": outcome, fixed.CLASSIFICATION: F.when(F.col("reason").isNull(), F.col(fixed.CLASSIFICATION))}
    )
    return rows.select(*fixed.ANALYTICS_COLUMNS, *(carry or []), "outcome", "reason")


def score(
    df: DataFrame, model: PipelineModel, stats: Stats | DataFrame, as_of: datetime | Column, **options
) -> DataFrame:
    """The enriched rows of all records that could be scored."""
    rows = score_all(df, model, stats, as_of, **options)
    return rows.where(F.col("outcome") == SCORED).drop("outcome", "reason")


def model_path(directory: str, version: int) -> str:
    return f"{directory.rstrip('/')}/version={version}"


def save_model(model: PipelineModel, directory: str, version: int, stats: Stats | None = None) -> str:
    """Write a model version, with the scaling statistics it was trained on."""
    path = model_path(directory, version)
    model.write().overwrite().save(f"{path}/model")
    if stats is not None:
        write_document(SparkSession.active(), stats, f"{path}/stats")
    return path


def load_model(spark: SparkSession, directory: str, version: int) -> tuple[PipelineModel, Stats | None]:
    path = model_path(directory, version)
    model = PipelineModel.load(f"{path}/model")
    try:
        stats = read_document(spark, f"{path}/stats")
    except AnalysisException as missing:  # saved without statistics
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        stats = None
    return model, stats


def boosted_rounds(model: PipelineModel) -> int:
    trees = model.stages[-1]
    assert isinstance(trees, GBTClassificationModel)
    return trees.getNumTrees
