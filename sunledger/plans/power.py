"""Site power: combine sources, keep the first row per site and minute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger import schemas
from sunledger.functions.temporal import floor_minute
from sunledger.operators.features import LABEL
from sunledger.operators.quality import (
    available_columns,
    dedup_first,
    drop_if_present,
    duplicate_rows,
    union_sources,
)

KEY = ("LocationCode", "DateTime")


def combine_power(main: DataFrame, extra: DataFrame | None, tie: Sequence[str] = ()) -> DataFrame:
    """Main and extra rows with one row per site and exact timestamp; main rows come first.

    ``tie`` orders copies within one source; without it they must be equal.
    """
    sources = [main] if extra is None else [main, extra]
    combined = union_sources(*sources).where(F.col("DateTime").isNotNull())
    wanted = [*KEY, LABEL, "source_rank", *tie]
    order = ["source_rank", *(tie or [LABEL])]
    firsts = dedup_first(available_columns(combined, wanted), KEY, order)
    return firsts.drop("source_rank")


def minute_duplicates(power: DataFrame) -> DataFrame:
    """All rows whose site and minute occur more than once, with the minute as their time."""
    return duplicate_rows(power.withColumn("DateTime", floor_minute(F.col("DateTime"))), KEY)


def dedup_minutes(power: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """The earliest row of each site and minute, stamped with the minute; sensors are dropped."""
    exact = drop_if_present(power, schemas.STATION_SENSORS).withColumn("_exact", F.col("DateTime"))
    stamped = exact.withColumn("DateTime", floor_minute(F.col("DateTime")))
    return dedup_first(stamped, KEY, ["_exact", *tie]).drop("_exact")


def clean_power(main: DataFrame, extra: DataFrame | None, tie: Sequence[str] = ()) -> DataFrame:
    """``combine_power`` and ``dedup_minutes`` in a single shuffle.

    The earliest timestamp of a minute, taken from the first source that has it,
    is the row the two steps would leave.
    """
    sources = [main] if extra is None else [main, extra]
    combined = union_sources(*sources).where(F.col("DateTime").isNotNull())
    wanted = available_columns(combined, [*KEY, LABEL, "source_rank", *tie])
    stamped = wanted.withColumn("_exact", F.col("DateTime")).withColumn(
        "DateTime", floor_minute(F.col("DateTime"))
    )
    order = ["_exact", "source_rank", *(tie or [LABEL])]
    return dedup_first(stamped, KEY, order).drop("_exact", "source_rank")
