"""As-of join, slot (range) join and lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions.numeric import clamp_zero, exact_part, fixed_text, rest_part, rint_round, to_number
from sunledger.functions.temporal import (
    epoch_seconds,
    floor_minute,
    on_the_minute,
    seconds_interval,
)
from sunledger.operators.ordering import number_rows, running_sums
from sunledger.session import materialise


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    columns: Sequence[str],
    tolerance: int = 600,
    by: Sequence[str] = (),
    sequence: str | None = None,
) -> DataFrame:
    """Left rows with the columns of the latest right row at or before them.

    The match may be at most ``tolerance`` seconds old, both ends included. Of
    right rows at one timestamp the one with the highest ``sequence`` wins.

    Both sides are first reduced to one row per timestamp on the map side, so a
    moment that holds most of the rows is one row here. The search then runs in
    windows of one second (at most a million microseconds) and, over one row
    per second, of one tolerance period; no pairs are formed.
    """
    payload = F.struct(*[F.col(c) for c in columns])
    samples = (
        right.where(_all_present([right_on, *by]))
        .select(
            *by,
            F.col(right_on).alias("_ts"),
            payload.alias("_payload"),
            (F.col(sequence) if sequence else F.lit(0)).alias("_seq"),
        )
        .groupBy(*by, "_ts")
        # Inside a struct, so that a missing sequence ranks lowest and is not skipped.
        .agg(F.max_by("_payload", F.struct("_seq")).alias("_payload"))
        .select(*by, "_ts", F.struct("_ts", "_payload").alias("_hit"), F.lit(False).alias("_asks"))
    )
    probes = (
        left.where(_all_present([left_on, *by]))
        .select(*by, F.col(left_on).alias("_ts"))
        .distinct()
        .withColumn("_asks", F.lit(True))
    )
    # The second is never null, and known to be: without a null filter of its own
    # each use of the points is the same plan, and Spark computes it once.
    points = samples.unionByName(probes, allowMissingColumns=True).withColumn(
        "_sec", F.coalesce(epoch_seconds(F.col("_ts")), F.lit(0))
    )

    # A sample comes before a probe of the same moment.
    in_second = Window.partitionBy(*by, "_sec").orderBy("_ts", "_asks")
    near = points.withColumn(
        "_near",
        F.last("_hit", ignorenulls=True).over(in_second.rowsBetween(Window.unboundedPreceding, 0)),
    ).where("_asks")

    latest = F.max_by("_hit", F.when(F.col("_hit").isNotNull(), F.col("_sec")))
    seconds = (
        points.groupBy(*by, "_sec")
        .agg(F.max_by("_hit", F.col("_hit._ts")).alias("_hit"))
        .withColumn("_cell", F.coalesce(F.floor(F.col("_sec") / F.lit(tolerance)).cast("bigint"), F.lit(0)))
    )
    in_cell = Window.partitionBy(*by, "_cell").orderBy("_sec")
    earlier = seconds.withColumn(
        "_mid",
        F.last("_hit", ignorenulls=True).over(in_cell.rowsBetween(Window.unboundedPreceding, -1)),
    )
    cells = (
        seconds.groupBy(*by, "_cell")
        .agg(latest.alias("_far"))
        .withColumn("_cell", F.col("_cell") + 1)
    )
    # A cell is as long as the tolerance, so a match is in the probe's own cell
    # or in the one before.
    far_cells = cells.where(F.col("_far").isNotNull())
    carried = earlier.join(far_cells, [*by, "_cell"], "left").select(
        *by, "_sec", F.coalesce("_mid", "_far").alias("_carry")
    )
    found = (
        near.join(carried, [*by, "_sec"], "left")
        .withColumn("_best", F.coalesce("_near", "_carry"))
        .where(F.col("_ts") - F.col("_best._ts") <= seconds_interval(tolerance))
        .select(
            *[F.col(k).alias(f"_by_{k}") for k in by],
            F.col("_ts").alias("_probe"),
            F.col("_best._payload").alias("_match"),
        )
    )
    same = [left[left_on] == found["_probe"], *[left[k] == found[f"_by_{k}"] for k in by]]
    return left.join(found, same, "left").select(
        *[left[c] for c in left.columns], *[F.col(f"_match.{c}").alias(c) for c in columns]
    )


def _all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def attach_by_time(
    df: DataFrame, series: DataFrame, columns: Sequence[str], on: Sequence[str] = ("DateTime",)
) -> DataFrame:
    """Left equi-join of a series that is unique on its key; other columns are pruned."""
    return df.join(series.select(*on, *columns), list(on), "left")


def lookup_default(
    df: DataFrame, dim: DataFrame, columns: Sequence[str], key: str = "LocationCode", default: int = 0
) -> DataFrame:
    """Dimension attributes by key; keys that are not in the dimension get the default."""
    found = attach_by_time(df, dim, columns, on=(key,))
    return found.withColumns({c: F.coalesce(F.col(c), F.lit(default)) for c in columns})


def unmapped_keys(df: DataFrame, dim: DataFrame, key: str = "LocationCode") -> DataFrame:
    """Distinct keys without a row in the dimension."""
    return df.select(key).distinct().join(dim, key, "left_anti")


def slot_means(
    questions: DataFrame,
    predictions: DataFrame,
    value: str,
    site: str = "LocationCode",
    start: str = "slot_start",
    ts: str = "DateTime",
    minutes: int = 9,
) -> DataFrame:
    """Mean of the predictions with ``start <= ts <= start + minutes`` per question.

    Slots start on a full minute, so predictions are first added up per site and
    minute, split into those on the minute and those after it: at most two rows
    per site and minute enter the join, however many predictions there are.
    """
    number = to_number(F.col(value))
    bins = (
        predictions.where(F.col(ts).isNotNull())
        .groupBy(
            F.col(site).alias("_site"),
            floor_minute(F.col(ts)).alias("_minute"),
            on_the_minute(F.col(ts)).alias("_on"),
        )
        .agg(*_sums(number), F.count(number).alias("_n"))
    )
    slots = questions.select(F.col(site).alias("_site"), F.col(start).alias("_start")).dropna().distinct()
    last = F.col("_start") + seconds_interval(minutes * 60)
    covered = slots.withColumn("_minute", F.explode(F.sequence("_start", last, seconds_interval(60))))
    means = (
        covered.join(bins, ["_site", "_minute"])
        .where(F.col("_on") | (F.col("_minute") < last))
        .groupBy("_site", "_start")
        .agg(F.sum("_sum").alias("_sum"), F.sum("_rest").alias("_rest"), F.sum("_n").alias("_n"))
        .select("_site", "_start", _mean().alias("slot_mean"))
    )
    same = [questions[site] == means["_site"], questions[start] == means["_start"]]
    return questions.join(means, same, "left").drop("_site", "_start")


def interval_means(
    intervals: DataFrame,
    samples: DataFrame,
    value: str,
    by: Sequence[str] = ("LocationCode",),
    start: str = "start",
    end: str = "end",
    ts: str = "DateTime",
    closed: str = "both",
) -> DataFrame:
    """Intervals with ``interval_rows`` and ``interval_mean`` of the samples inside them.

    Start and end may be any moments, and an interval of any length; ``closed`` says which of
    them belong to it ("both", "left", "right", "neither"). Samples and interval ends are put
    in one order by key and time, running sums are taken over it once, and an interval's sum
    is the difference of the sums at its two ends: no minutes are enumerated and no pairs
    formed, however long or many the intervals and whatever share of the rows a key has.
    Nine decimals are added exactly. An interval that ends before it starts, or lacks a bound
    or key, has no rows.
    """
    if closed not in ("both", "left", "right", "neither"):
        raise ValueError(f"unknown closed {closed!r}")
    # Places at one moment: a bound that lies before the samples, the samples, one after them.
    start_side = 0 if closed in ("both", "left") else 2
    end_side = 2 if closed in ("both", "right") else 0
    number = to_number(F.col(value))
    per_moment = (
        samples.where(_all_present([ts, *by]))
        .groupBy(*by, F.col(ts).alias("_ts"))
        .agg(*_sums(number), F.count(number).alias("_n"))
        .withColumn("_side", F.lit(1))
    )

    def bounds(name: str, side: int) -> DataFrame:
        there = intervals.where(_all_present([start, end, *by]))
        return there.select(*by, F.col(name).alias("_ts"), F.lit(side).alias("_side"))

    asked = bounds(start, start_side).unionByName(bounds(end, end_side)).distinct()
    points = per_moment.unionByName(asked, allowMissingColumns=True)
    numbered = number_rows(points, [*by, "_ts", "_side"])
    run = materialise(running_sums(numbered, ["_sum", "_rest", "_n"]).where("_side <> 1").drop("_row"), "bounds")

    def at(name: str, side: int) -> DataFrame:
        names = [F.col(k).alias(f"_{name}_{k}") for k in by]
        sums = [F.col(c).alias(f"_{name}{c}") for c in ("_sum", "_rest", "_n")]
        return run.where(F.col("_side") == side).select(*names, F.col("_ts").alias(f"_{name}_ts"), *sums)

    out = intervals
    for name, column, side in (("lo", start, start_side), ("hi", end, end_side)):
        found = at(name, side)
        same = [intervals[k] == found[f"_{name}_{k}"] for k in by]
        out = out.join(found, [intervals[column] == found[f"_{name}_ts"], *same], "left")
    inside = intervals[start] <= intervals[end]
    rows = F.when(inside, F.greatest(F.col("_hi_n") - F.col("_lo_n"), F.lit(0)))
    whole = (F.col("_hi_sum") - F.col("_lo_sum")).cast("double") + (F.col("_hi_rest") - F.col("_lo_rest"))
    return out.select(
        *[intervals[c] for c in intervals.columns],
        F.coalesce(rows, F.lit(0)).alias("interval_rows"),
        F.when(rows > 0, whole / rows).alias("interval_mean"),
    )


def slot_means_aligned(
    predictions: DataFrame,
    value: str,
    site: str = "LocationCode",
    ts: str = "DateTime",
    minutes: int = 10,
) -> DataFrame:
    """Mean per site and half-open tumbling slot, for slots that start on its multiples."""
    number = to_number(F.col(value))
    return (
        predictions.groupBy(site, F.window(ts, f"{minutes} minutes").alias("_slot"))
        .agg(*_sums(number), F.count(number).alias("_n"))
        .select(site, F.col("_slot.start").alias("slot_start"), _mean().alias("slot_mean"))
    )


def _sums(number: Column) -> list[Column]:
    return [F.sum(exact_part(number)).alias("_sum"), F.sum(rest_part(number)).alias("_rest")]


def _mean() -> Column:
    return F.try_divide(F.col("_sum").cast("double") + F.col("_rest"), F.col("_n").cast("double"))


def slot_answer(mean: Column) -> Column:
    """Negative means to 0, then two decimals; an empty slot stays null."""
    return rint_round(clamp_zero(mean), 2)


def answer_text(answer: Column) -> Column:
    return F.coalesce(fixed_text(answer, 2), F.lit("N/A"))
