"""Slot questions: expansion to minutes, and answers from minute predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions.temporal import serial_fields
from sunledger.operators.features import LABEL, PREDICTION
from sunledger.operators.grid import expand_slots
from sunledger.operators.joins import answer_text, slot_answer, slot_means


def parse_serials(questions: DataFrame, serial: str = "serial") -> DataFrame:
    return questions.withColumns(serial_fields(F.col(serial)))


def split_serials(questions: DataFrame, serial: str = "serial") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) with the reason a serial was rejected."""
    parsed = parse_serials(questions, serial)
    blank = F.coalesce(F.trim(F.col(serial)) == "", F.lit(True))
    reason = (
        F.when(blank, "blank")
        .when(F.col("LocationCode").isNull(), "site")
        .when(F.col("slot_start").isNull(), "datetime")
    )
    judged = parsed.withColumn("reason", reason)
    valid = judged.where(F.col("reason").isNull()).drop("reason")
    return valid, judged.where(F.col("reason").isNotNull()).drop("slot_start", "LocationCode")


def expand_questions(questions: DataFrame, serial: str = "serial") -> DataFrame:
    """Ten minute rows per valid question with the power still unknown."""
    valid, _ = split_serials(questions, serial)
    rows = expand_slots(valid).withColumn(LABEL, F.lit(None).cast("double"))
    return rows.drop("slot_start")


def answer_questions(
    questions: DataFrame, predictions: DataFrame, serial: str = "serial", value: str = PREDICTION
) -> DataFrame:
    """Each question with its answer and the text that is handed in (``N/A`` if none)."""
    answered = slot_means(parse_serials(questions, serial), predictions, value)
    return (
        answered.withColumn("answer", slot_answer(F.col("slot_mean")))
        .withColumn("answer_text", answer_text(F.col("answer")))
        .drop("slot_start", "LocationCode", "slot_mean")
    )
