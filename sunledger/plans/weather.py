"""Weather repair and enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions.numeric import clean_measure, fixed_text, interaction, rint_round, to_number
from sunledger.operators.grid import hold_last
from sunledger.operators.joins import asof_join
from sunledger.operators.ordering import forward_fill, interpolate_rows
from sunledger.operators.quality import missing_report

MEASURES = ("H_UVI", "TEMP")
TOLERANCE_SECONDS = 600


def repair_weather(
    raw: DataFrame, order: Sequence[str] = ("time",), measures: Sequence[str] = MEASURES
) -> DataFrame:
    """Sentinels and bad text to null, null runs interpolated, two decimals.

    ``order`` gives the row order and must be unique.
    """
    cleaned = raw.withColumns({c: clean_measure(F.col(c)) for c in measures})
    filled = interpolate_rows(cleaned, measures, order)
    # Stored with two decimals; later steps read that text back.
    return filled.withColumns({c: to_number(fixed_text(F.col(c))) for c in measures})


def match_weather(df: DataFrame, weather: DataFrame, sequence: str | None = None) -> DataFrame:
    """Latest weather at most ten minutes old; the UV index with one decimal."""
    matched = asof_join(
        df, weather, "DateTime", "time", MEASURES, TOLERANCE_SECONDS, sequence=sequence
    )
    return matched.withColumn("H_UVI", rint_round(F.col("H_UVI"), 1))


def unmatched_weather(matched: DataFrame, by: Sequence[str] = ("LocationCode",)) -> DataFrame:
    return missing_report(matched, MEASURES, by)


def add_weather(
    df: DataFrame,
    weather: DataFrame,
    order: Sequence[str] = ("DateTime",),
    series: Sequence[str] = ("LocationCode",),
    sequence: str | None = None,
    one_per_minute: bool = False,
) -> DataFrame:
    """Weather columns and their interaction.

    A missing temperature takes the last earlier one of the series, a missing UV
    index stays missing. Training fills per site file (``series``); serving
    fills over the one question file (``series=()``). ``one_per_minute`` says
    that each series has one row per minute, which needs no row numbering.
    """
    matched = match_weather(df, weather, sequence)
    if one_per_minute:
        filled = hold_last(matched, ["TEMP"], by=series)
    else:
        filled = forward_fill(matched, ["TEMP"], order, by=series)
    return filled.withColumn("H_UVI_TEMP_interaction", interaction(F.col("H_UVI"), F.col("TEMP")))
