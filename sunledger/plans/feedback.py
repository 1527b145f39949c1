"""Pseudo-label feedback: predicted labels of serving rows join the training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions.numeric import clamp_zero
from sunledger.operators.features import LABEL, PREDICTION
from sunledger.operators.joins import attach_by_time

KEYS = ("LocationCode", "DateTime")


def merge_predictions(serving: DataFrame, predictions: DataFrame) -> DataFrame:
    """Serving rows whose missing label is the prediction, not below 0."""
    clamped = predictions.withColumn(PREDICTION, clamp_zero(F.col(PREDICTION)))
    merged = attach_by_time(serving, clamped, [PREDICTION], on=KEYS)
    return merged.withColumn(LABEL, F.coalesce(F.col(LABEL), F.col(PREDICTION))).drop(PREDICTION)


def pseudo_label(training: DataFrame, serving: DataFrame, predictions: DataFrame) -> DataFrame:
    """Measured and pseudo-labelled rows, told apart by ``label_source``."""
    pseudo = merge_predictions(serving, predictions).withColumn("label_source", F.lit("pseudo"))
    measured = training.withColumn("label_source", F.lit("measured"))
    return measured.unionByName(pseudo, allowMissingColumns=True)
