"""Flattening of the nested weather and irradiance payloads (batch and streaming)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger import schemas
from sunledger.functions.numeric import fixed_text_or_raw
from sunledger.functions.temporal import as_datetime, iso_wall_clock


def flatten_weather(payloads: DataFrame) -> DataFrame:
    """``records.Station[]`` to (StationId, time, H_UVI, TEMP).

    A missing element is "0.0"; text that is no number is kept as it is. The
    wall clock of the observation is kept, its offset dropped.
    """
    return station_columns(payloads.select(F.explode("records.Station").alias("s")))


def station_columns(stations: DataFrame, *keep: str) -> DataFrame:
    """The flat columns of one station struct ``s`` per row, after the ones to keep."""
    return stations.select(
        *keep,
        F.col("s.StationId").alias("StationId"),
        iso_wall_clock(F.col("s.ObsTime.DateTime")).alias("time"),
        _element("s.WeatherElement.UVIndex").alias("H_UVI"),
        _element("s.WeatherElement.AirTemperature").alias("TEMP"),
    )


def _element(path: str) -> Column:
    return fixed_text_or_raw(F.coalesce(F.col(path), F.lit("0.0")))


def unreadable_irradiance(payloads: DataFrame) -> DataFrame:
    """Payload files that are no JSON, and those without intervals: (file, text)."""
    empty = F.coalesce(F.size("irradiance.intervals"), F.lit(0)) <= 0
    return payloads.where(empty).select(
        F.col("_metadata.file_name").alias("file"), F.col(schemas.CORRUPT).alias("text")
    )


def flatten_irradiance(
    payloads: DataFrame, first: str = "05:00", until: str = "19:00"
) -> tuple[DataFrame, DataFrame]:
    """``irradiance.intervals[]`` to (DateTime, GHI, DNI, DHI) for starts in [first, until).

    Returns (complete, incomplete) rows; an interval lacking a value, or its start, does
    not cost the day's other intervals.
    """
    intervals = payloads.select("date", F.explode("irradiance.intervals").alias("i")).where(
        F.col("i.start").isNull() | ((F.col("i.start") >= first) & (F.col("i.start") < until))
    )
    rows = intervals.select(
        as_datetime(F.concat("date", F.lit(" "), "i.start")).alias("DateTime"),
        F.col("i.clear_sky.ghi").alias("GHI"),
        F.col("i.clear_sky.dni").alias("DNI"),
        F.col("i.clear_sky.dhi").alias("DHI"),
    )
    gap = F.col("DateTime").isNull() | F.col("GHI").isNull() | F.col("DNI").isNull() | F.col("DHI").isNull()
    return rows.where(~gap), rows.where(gap)
