"""Insolation: hourly station export to a 10-minute series, joined per minute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions.numeric import fixed_text, rint_round, to_number
from sunledger.functions.temporal import slash_text
from sunledger.operators.grid import MINUTE, TEN_MINUTES, complete_days, resample_linear, upsample_hold
from sunledger.operators.joins import attach_by_time
from sunledger.operators.quality import dedup_first, split_rejects
from sunledger.session import materialise

VALUE = "Solarinsolation"
REQUIRED = ("Azimuth", "Elevation", VALUE)

# The season of the published series.
START, END = "2024-01-01 00:00:00", "2024-10-30 23:59:59"


def judge_station_hours(
    hourly: DataFrame, start: str = START, end: str = END, keep_hours: tuple[int, int] = (6, 17)
) -> DataFrame:
    """Rows with the ``reason`` for which each is left out, null if it is kept.

    Reasons of the reader ("malformed", "untimed") stay; a row outside the given dates is
    "outside", one outside the daytime hours "hours".
    """
    ts = F.col("DateTime")
    within = ts.between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    read = F.col("reason") if "reason" in hourly.columns else F.lit(None).cast("string")
    reason = (
        F.when(read.isNotNull(), read)
        .when(ts.isNull(), F.lit("untimed"))
        .when(~within, F.lit("outside"))
        .when(~F.hour(ts).between(*keep_hours), F.lit("hours"))
    )
    return hourly.withColumn("reason", reason)


def filter_station_hours(
    hourly: DataFrame,
    order: Sequence[str] = (VALUE,),
    start: str = START,
    end: str = END,
    keep_hours: tuple[int, int] = (6, 17),
    grid_hours: tuple[int, int] = (6, 19),
) -> DataFrame:
    """Hourly rows of the daytime, complete per present day, gaps as 0."""
    judged = judge_station_hours(hourly, start, end, keep_hours)
    kept = judged.where("reason IS NULL").drop("reason").withColumn(VALUE, F.coalesce(F.col(VALUE), F.lit(0.0)))
    firsts = dedup_first(kept, ["DateTime"], list(order))
    return complete_days(firsts, VALUE, first=grid_hours[0], last=grid_hours[1])


def line_accounting(judged: DataFrame) -> DataFrame:
    """(outcome, lines): what became of every line; of lines at one time one is accepted."""
    per_time = judged.where("reason IS NULL").groupBy("DateTime").agg(F.count("*").alias("n"))
    kept = per_time.agg(F.count("*").alias("accepted"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeat"))
    outcomes = F.array(*[F.struct(F.lit(c).alias("outcome"), F.col(c).alias("lines")) for c in ("accepted", "repeat")])
    left_out = judged.where("reason IS NOT NULL").groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("lines"))
    return kept.select(F.inline(outcomes)).unionByName(left_out)


def station_hours_text(complete: DataFrame) -> DataFrame:
    """The stored form: ``yyyy/MM/dd HH:mm`` and two decimals."""
    return complete.select(
        slash_text(F.col("DateTime")).alias("DateTime"), fixed_text(F.col(VALUE)).alias(VALUE)
    )


def insolation_ten_minutes(complete: DataFrame) -> DataFrame:
    """10-minute series between the hourly values, which count with two decimals."""
    stored = complete.select("DateTime", to_number(fixed_text(F.col(VALUE))).alias(VALUE))
    grid = resample_linear(stored, [VALUE], step=TEN_MINUTES)
    return grid.withColumn(VALUE, rint_round(F.col(VALUE), 2))


def insolation_minutes(ten_minutes: DataFrame) -> DataFrame:
    return upsample_hold(ten_minutes, [VALUE], step=MINUTE)


def add_insolation(
    df: DataFrame, minutes: DataFrame, stored: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rows lacking the sun angle or the insolation are rejected.

    ``stored`` writes the joined rows once, for callers that use both results.
    """
    joined = attach_by_time(df, minutes, [VALUE])
    return split_rejects(materialise(joined, "judged") if stored else joined, REQUIRED)
