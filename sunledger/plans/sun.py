"""Sun-angle table of the daytime minutes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.functions.solar import sun_angles
from sunledger.operators.grid import date_list, day_minutes
from sunledger.operators.joins import attach_by_time

ANGLES = ("Azimuth", "Elevation")


def sun_table(days: DataFrame, day: str = "day", **place) -> DataFrame:
    """Angles with two decimals for 05:00-19:00 of the given days, sun above the horizon.

    ``days`` must be distinct. The elevation is rounded before it is compared.
    """
    return sun_angles(day_minutes(days, day=day), **place).where(F.col("Elevation") >= 0)


def sun_table_between(
    spark: SparkSession, start: str = "2024-01-01", end: str = "2024-10-31", **place
) -> DataFrame:
    return sun_table(date_list(spark, start, end, "day"), **place)


def add_sun_angles(df: DataFrame, table: DataFrame) -> DataFrame:
    """Rows at a time without an angle are dropped."""
    return attach_by_time(df, table, ANGLES).dropna(subset=list(ANGLES))
