"""Regular time grids: generators, completion, resampling, upsampling, slot expansion.

A series has one row per timestamp, so a calendar day of one series has a
largest number of rows whatever the size of the table. Windows run inside
(series, day); what crosses midnight is carried on a table of one row per
(series, day). Rows without a timestamp or a series key are in no series.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunledger.functions.numeric import line_value
from sunledger.functions.temporal import (
    DAY_SECONDS,
    epoch_seconds,
    floor_seconds,
    from_epoch_seconds,
    seconds_interval,
)

MINUTE = 60
TEN_MINUTES = 600
DAYS_A_YEAR = 366


def time_grid(spark: SparkSession, start: str, end: str, step: int, ts: str = "DateTime") -> DataFrame:
    """Every ``step`` seconds from ``start`` to ``end``, both included."""
    lo, hi = (
        int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())
        for text in (start, end)
    )
    ticks = spark.range(lo, hi + 1, step)
    return ticks.select(from_epoch_seconds(F.col("id")).alias(ts))


def date_list(spark: SparkSession, start: str, end: str, name: str = "date") -> DataFrame:
    """Every calendar date from ``start`` to ``end``, both included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias(name))


def dates_spanned(df: DataFrame, ts: str = "DateTime", name: str = "date") -> DataFrame:
    """Every calendar date from the first to the last timestamp: what a backfill has to fetch."""
    span = df.agg(F.to_date(F.min(ts)).alias("lo"), F.to_date(F.max(ts)).alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi")).alias(name))


def distinct_days(df: DataFrame, ts: str = "DateTime", name: str = "day") -> DataFrame:
    return df.select(F.to_date(ts).alias(name)).where(F.col(name).isNotNull()).distinct()


def day_minutes(
    days: DataFrame, first: int = 5, last: int = 19, day: str = "day", ts: str = "DateTime"
) -> DataFrame:
    """The minutes from ``first`` to ``last`` o'clock, both included, of every given day."""
    midnight = F.col(day).cast("timestamp_ntz")
    ticks = F.sequence(
        midnight + seconds_interval(first * 3600),
        midnight + seconds_interval(last * 3600),
        F.expr("INTERVAL '1' MINUTE"),
    )
    return days.select(F.explode(ticks).alias(ts))


def complete_days(
    df: DataFrame,
    value: str,
    ts: str = "DateTime",
    first: int = 6,
    last: int = 19,
    fill: float = 0.0,
) -> DataFrame:
    """Hourly rows ``first`` .. ``last`` for each day that has any row; missing ones are ``fill``.

    Rows off the full hour count for the day's presence but are not in the
    result. ``ts`` must be unique.
    """
    hours = F.sequence(F.lit(first), F.lit(last))
    wanted = (
        distinct_days(df, ts)
        .select("day", F.explode(hours).alias("_hour"))
        .select((F.col("day").cast("timestamp_ntz") + seconds_interval(F.col("_hour") * 3600)).alias(ts))
    )
    return wanted.join(df.select(ts, value), ts, "left").withColumn(
        value, F.coalesce(F.col(value), F.lit(fill))
    )


def resample_linear(
    df: DataFrame,
    values: Sequence[str],
    step: int = TEN_MINUTES,
    ts: str = "DateTime",
    by: Sequence[str] = (),
    origin: str = "day",
) -> DataFrame:
    """Linear interpolation onto a regular grid from the first to the last timestamp.

    ``origin="day"`` counts grid ticks from midnight, ``origin="min"`` from the
    first timestamp of the series. Samples off the grid are dropped, leading
    ticks without a sample stay null and trailing ticks hold the last sample.
    ``ts`` must be unique per series.
    """
    rows = df.where(F.col(ts).isNotNull()).select(*by, ts, *values)
    if origin == "day":
        if DAY_SECONDS % step:
            raise ValueError("a grid counted from midnight needs a step that divides the day")
        on_grid = floor_seconds(F.col(ts), step) == F.col(ts)
        lo, hi = floor_seconds(F.col("_min"), step), floor_seconds(F.col("_max"), step)
    elif origin == "min":
        rows = _with_start(rows, ts, by)
        offset = epoch_seconds(F.col(ts)) - epoch_seconds(F.col("_start"))
        on_grid = (offset % step == 0) & (F.col(ts) - F.col("_start") == seconds_interval(offset))
        lo = F.col("_min")
        reach = epoch_seconds(F.col("_max")) - epoch_seconds(lo) - (
            F.when(_fraction(F.col("_max")) < _fraction(lo), 1).otherwise(0)
        )
        hi = lo + seconds_interval(F.floor(reach / F.lit(step)).cast("bigint") * step)
    else:
        raise ValueError(f"unknown origin {origin!r}")
    spans = _spans(rows, values, ts, by, used=on_grid).withColumns({"_lo": lo, "_hi": hi})

    first_tick = F.when(F.col("_is_first"), F.col("_lo")).otherwise(F.col(ts))
    last_tick = F.coalesce(F.col("_next_ts") - seconds_interval(step), F.col("_hi"))
    ticks = _with_ticks(spans, first_tick, last_tick, step, by)

    def at_tick(c: str) -> Column:
        before, after = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        here = epoch_seconds(F.col("_tick"))
        x0, x1 = epoch_seconds(before["ts"]), epoch_seconds(after["ts"])
        line = line_value(
            before["value"],
            after["value"],
            ((x1 - x0) / step).cast("double"),
            ((here - x0) / step).cast("double"),
        )
        return (
            F.when(F.col("_tick") < F.col(ts), None)
            .when(after.isNull() | (before["ts"] == F.col("_tick")), before["value"])
            .otherwise(line)
        )

    return ticks.select(*by, F.col("_tick").alias(ts), *[at_tick(c).alias(c) for c in values])


def upsample_hold(
    df: DataFrame,
    values: Sequence[str],
    step: int = MINUTE,
    ts: str = "DateTime",
    by: Sequence[str] = (),
) -> DataFrame:
    """Repeat each row on the grid ticks until the next row.

    The whole row is carried, nulls included. ``ts`` must be unique per series.
    """
    rows = df.where(F.col(ts).isNotNull())
    spans = _spans(rows, [], ts, by, carry=values).withColumns(
        {"_lo": floor_seconds(F.col("_min"), step), "_hi": floor_seconds(F.col("_max"), step)}
    )
    below = floor_seconds(F.col(ts), step)
    own_tick = F.when(below == F.col(ts), below).otherwise(below + seconds_interval(step))
    next_below = floor_seconds(F.col("_next_ts"), step)
    last_tick = F.coalesce(
        F.when(next_below == F.col("_next_ts"), next_below - seconds_interval(step)).otherwise(next_below),
        F.col("_hi"),
    )
    first_tick = F.when(F.col("_is_first"), F.col("_lo")).otherwise(own_tick)
    ticks = _with_ticks(spans, first_tick, last_tick, step, by)
    held = [F.when(F.col("_tick") >= F.col(ts), F.col(c)).alias(c) for c in values]
    return ticks.select(*by, F.col("_tick").alias(ts), *held)


def hold_last(df: DataFrame, columns: Sequence[str], by: Sequence[str], ts: str = "DateTime") -> DataFrame:
    """Replace nulls with the series' last earlier non-null value.

    For rows stamped to the minute with ``ts`` unique per series: a day of a
    series then has at most 1,440 rows. Other rows need ``ordering.forward_fill``.
    """
    rows = df.withColumn("_day", F.to_date(ts))
    key = [*by, "_day"]
    until_now = Window.partitionBy(*key).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumns({c: F.last(c, ignorenulls=True).over(until_now) for c in columns})
    days = rows.groupBy(*key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(f"_last_{c}") for c in columns]
    )
    before = Window.partitionBy(*by).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select(
        *[F.col(k).alias(f"_key_{k}") for k in key],
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}") for c in columns],
    )
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in key]
    filled = {c: F.coalesce(F.col(c), F.col(f"_carry_{c}")) for c in columns}
    return inside.join(carried, same, "left").withColumns(filled).select(*df.columns)


def expand_slots(
    df: DataFrame, start: str = "slot_start", minutes: int = 10, ts: str = "DateTime"
) -> DataFrame:
    """One row per minute of each slot."""
    ticks = F.sequence(
        F.col(start), F.col(start) + seconds_interval((minutes - 1) * MINUTE), _step(MINUTE)
    )
    return df.withColumn(ts, F.explode(ticks))


def _step(seconds: int) -> Column:
    return seconds_interval(seconds)


def _with_ticks(spans: DataFrame, first: Column, last: Column, step: int, by: Sequence[str]) -> DataFrame:
    """A row per tick of each span, as ``_tick``; a span that ends before it starts has none.

    A span is cut into years, these into days, and the days are dealt out over all tasks
    before their ticks are made: a gap of decades is neither one array nor one task's work.
    """
    per_day = max(1, DAY_SECONDS // step)
    sizes = (per_day * DAYS_A_YEAR, per_day)
    pieces = spans.withColumns({"_tick": first, "_last_tick": last}).where(F.col("_tick") <= F.col("_last_tick"))
    for size in sizes:
        reach = F.floor((epoch_seconds(F.col("_last_tick")) - epoch_seconds(F.col("_tick"))) / F.lit(step * size))
        numbered = pieces.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), reach.cast("bigint"))))
        start = F.col("_tick") + seconds_interval(F.col("_piece") * (step * size))
        pieces = numbered.withColumns(
            {"_tick": start, "_last_tick": F.least("_last_tick", start + seconds_interval(step * (size - 1)))}
        ).where(F.col("_tick") <= F.col("_last_tick"))
    # A stated number: rows are few and small here, so AQE would join them in one task.
    tasks = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.repartition(tasks, *by, "_tick")
    ticks = F.explode(F.sequence("_tick", "_last_tick", _step(step)))
    return dealt.withColumn("_tick", ticks).drop("_last_tick", "_piece")


def _with_start(rows: DataFrame, ts: str, by: Sequence[str]) -> DataFrame:
    """Add the first timestamp of each row's series, found over one row per day."""
    daily = rows.withColumn("_day", F.to_date(ts))
    firsts = daily.groupBy(*by, "_day").agg(F.min(ts).alias("_day_lo"))
    starts = firsts.select(*by, "_day", F.min("_day_lo").over(Window.partitionBy(*by)).alias("_start"))
    return daily.join(starts, [*by, "_day"]).drop("_day")


def _fraction(ts: Column) -> Column:
    return F.extract(F.lit("SECOND"), ts) - F.second(ts)


def _spans(
    df: DataFrame,
    values: Sequence[str],
    ts: str,
    by: Sequence[str],
    carry: Sequence[str] = (),
    used: Column | None = None,
) -> DataFrame:
    """Add to each used row the next one's timestamp, whether it is its series' first,
    the series' first and last timestamp over all rows (``_min``, ``_max``), and for
    each value the nearest non-null sample at or before and after the row."""
    keep = [*by, ts, *values, *carry]
    used = F.lit(True) if used is None else used
    rows = df.select(*keep, F.to_date(ts).alias("_day"), used.alias("_used"))
    key = [*by, "_day"]
    day = Window.partitionBy(*key)
    rising = day.orderBy(ts)
    falling = day.orderBy(F.col(ts).desc())

    def sample(c: str) -> Column:
        present = F.col("_used") & F.col(c).isNotNull()
        return F.when(present, F.struct(F.col(ts).alias("ts"), F.col(c).alias("value")))

    inside = rows.where("_used").select(
        "*",
        F.lead(ts).over(rising).alias("_in_next_ts"),
        (F.row_number().over(rising) == 1).alias("_in_first"),
        *[
            F.last(sample(c), ignorenulls=True)
            .over(rising.rowsBetween(Window.unboundedPreceding, 0))
            .alias(f"_in_prev_{c}")
            for c in values
        ],
        *[
            F.last(sample(c), ignorenulls=True)
            .over(falling.rowsBetween(Window.unboundedPreceding, -1))
            .alias(f"_in_next_{c}")
            for c in values
        ],
    )

    used_ts = F.when(F.col("_used"), F.col(ts))
    days = rows.groupBy(*key).agg(
        F.min(ts).alias("_day_lo"),
        F.max(ts).alias("_day_hi"),
        F.min(used_ts).alias("_first_ts"),
        *[F.min(sample(c)).alias(f"_first_{c}") for c in values],
        *[F.max(sample(c)).alias(f"_last_{c}") for c in values],
    )
    series = Window.partitionBy(*by)
    before = series.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    after = series.orderBy(F.col("_day").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select(
        *key,
        F.min("_day_lo").over(series).alias("_min"),
        F.max("_day_hi").over(series).alias("_max"),
        F.min("_first_ts").over(after).alias("_out_next_ts"),
        F.min("_first_ts").over(before).isNull().alias("_first_day"),
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_out_prev_{c}") for c in values],
        *[F.last(f"_first_{c}", ignorenulls=True).over(after).alias(f"_out_next_{c}") for c in values],
    )
    joined = inside.join(carried, key, "left")
    return joined.select(
        *keep,
        "_min",
        "_max",
        F.coalesce("_in_next_ts", "_out_next_ts").alias("_next_ts"),
        (F.col("_in_first") & F.col("_first_day")).alias("_is_first"),
        *[F.coalesce(f"_in_prev_{c}", f"_out_prev_{c}").alias(f"_prev_{c}") for c in values],
        *[F.coalesce(f"_in_next_{c}", f"_out_next_{c}").alias(f"_next_{c}") for c in values],
    )
