"""Train on the ETL's CSV channels and keep the model with its statistics."""

from __future__ import annotations

from pyspark.sql import SparkSession

from pulseframe.operators.model import boosted_rounds, confusion, evaluate, predict, save_model, train
from pulseframe.sinks.files import read_document
from pulseframe.sources.labelled_csv import read_split_csv


def run_training(spark: SparkSession, data: str, models: str, version: int, **options) -> dict:
    """``data`` is the destination of ``run_etl``; the options are those of ``train``. Returns rounds, log loss and confusion."""
    data = data.rstrip("/")
    training = read_split_csv(spark, f"{data}/train/train.csv")
    validation = read_split_csv(spark, f"{data}/validation/validation.csv")
    model = train(training, validation, **options)
    stats = read_document(spark, f"{data}/config/normalization_stats_exact.json")["stats"]
    path = save_model(model, models, version, stats)
    predicted = predict(validation, model)
    loss = evaluate(predicted).first()
    return {
        "path": path,
        "rounds": boosted_rounds(model),
        "log_loss": loss["log_loss"],
        "validation": loss["n"],
        "confusion": {(r["label"], r["classification"]): r["count"] for r in confusion(predicted).collect()},
    }
