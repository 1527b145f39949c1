"""Clear-sky irradiance: 15-minute payload values to a 1-minute series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions.numeric import rint_round
from sunledger.functions.temporal import clock_between
from sunledger.operators.grid import MINUTE, TEN_MINUTES, resample_linear
from sunledger.operators.joins import attach_by_time

VALUES = ("GHI", "DNI", "DHI")


def irradiance_ten_minutes(quarters: DataFrame, first: str = "05:00", last: str = "19:00") -> DataFrame:
    """10-minute grid from the first timestamp on; quarter-hours off the grid are not used."""
    grid = resample_linear(quarters, VALUES, step=TEN_MINUTES, origin="min")
    rounded = grid.withColumns({c: rint_round(F.col(c), 2) for c in VALUES})
    return rounded.where(clock_between(F.col("DateTime"), first, last))


def irradiance_minutes(ten_minutes: DataFrame) -> DataFrame:
    """1-minute series over the whole span, nights included."""
    grid = resample_linear(ten_minutes, VALUES, step=MINUTE)
    return grid.withColumns({c: rint_round(F.col(c), 2) for c in VALUES})


def add_irradiance(df: DataFrame, minutes: DataFrame) -> DataFrame:
    return attach_by_time(df, minutes, ["DNI", "DHI", "GHI"])
