from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sunledger.operators import grid
from sunledger.plans import insolation, irradiance

SCHEMA = "DateTime timestamp_ntz, v double"


def at(minute, second=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute, seconds=second)


def listed(df, column="v"):
    return [(r["DateTime"], r[column]) for r in df.orderBy("DateTime").collect()]


@pytest.mark.parametrize("origin", ["day", "min"])
def test_samples_off_the_grid_are_dropped(spark, origin):
    df = spark.createDataFrame([(at(0), 0.0), (at(15), 100.0), (at(30), 30.0), (at(45), 45.0)], SCHEMA)
    got = listed(grid.resample_linear(df, ["v"], origin=origin))
    assert got == [(at(10 * i), v) for i, v in enumerate([0.0, 10.0, 20.0, 30.0, 30.0])]


def random_series(seed, days=4):
    draw = random.Random(seed)
    minutes = sorted(draw.sample(range(0, days * 1440, 5), 60))
    return [(at(m), None if draw.random() < 0.3 else round(draw.uniform(0, 900), 2)) for m in minutes]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("origin", ["day", "min"])
def test_resample_equals_pandas(spark, seed, origin):
    rows = random_series(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = grid.resample_linear(df, ["v"], origin=origin).toPandas().sort_values("DateTime")
    series = pd.DataFrame(rows, columns=["DateTime", "v"]).set_index("DateTime").astype("float64")
    if origin == "day":
        want = series.resample("10min").asfreq().interpolate(method="linear")
    else:
        ticks = pd.date_range(series.index.min(), series.index.max(), freq="10min")
        want = series.reindex(ticks).interpolate(method="linear")
    assert list(got["DateTime"]) == list(want.index)
    pd.testing.assert_series_equal(
        got["v"].reset_index(drop=True).astype("float64"), want["v"].reset_index(drop=True), rtol=1e-12
    )


@pytest.mark.parametrize("shift", [0, 17])
def test_hold_equals_pandas(spark, shift):
    rows = [(t + dt.timedelta(seconds=shift), v) for t, v in random_series(9, days=2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = grid.upsample_hold(df, ["v"]).toPandas().sort_values("DateTime")
    series = pd.DataFrame(rows, columns=["DateTime", "v"]).set_index("DateTime").astype("float64")
    want = series.resample("1min").ffill()
    assert list(got["DateTime"]) == list(want.index)
    pd.testing.assert_series_equal(
        got["v"].reset_index(drop=True).astype("float64"), want["v"].reset_index(drop=True)
    )


def test_hold_carries_null_rows(spark):
    df = spark.createDataFrame([(at(0), 1.0), (at(10), None), (at(20), 3.0)], SCHEMA)
    got = [v for _, v in listed(grid.upsample_hold(df, ["v"]))]
    assert len(got) == 21 and got.count(None) == 10


def test_series_keys_are_independent(spark):
    rows = [("a", at(0), 0.0), ("a", at(20), 20.0), ("b", at(10), 5.0), ("b", at(1450), 5.0)]
    df = spark.createDataFrame(rows, "k string, DateTime timestamp_ntz, v double")
    got = grid.resample_linear(df, ["v"], by=["k"])
    assert listed(got.where("k = 'a'")) == [(at(0), 0.0), (at(10), 10.0), (at(20), 20.0)]
    assert got.where("k = 'b'").count() == 145


def test_complete_days(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 6), 1.5)], "DateTime timestamp_ntz, Solarinsolation double")
    got = grid.complete_days(df, "Solarinsolation").orderBy("DateTime").collect()
    assert [r["DateTime"].hour for r in got] == list(range(6, 20))
    assert [r["Solarinsolation"] for r in got] == [1.5] + [0.0] * 13


def test_station_filter_keeps_hours_and_first_row(spark):
    rows = [
        (dt.datetime(2024, 1, 1, 5), 9.0),
        (dt.datetime(2024, 1, 1, 6), None),
        (dt.datetime(2024, 1, 1, 17), 3.0),
        (dt.datetime(2024, 1, 1, 18), 9.0),
        (dt.datetime(2023, 12, 31, 12), 9.0),
        (dt.datetime(2024, 10, 30, 12), 4.0),
        (dt.datetime(2024, 10, 31, 12), 9.0),
    ]
    df = spark.createDataFrame(rows, "DateTime timestamp_ntz, Solarinsolation double")
    got = {r["DateTime"]: r["Solarinsolation"] for r in insolation.filter_station_hours(df).collect()}
    assert len(got) == 28
    assert {t: v for t, v in got.items() if v} == {
        dt.datetime(2024, 1, 1, 17): 3.0,
        dt.datetime(2024, 10, 30, 12): 4.0,
    }


def test_irradiance_crosses_the_night(spark):
    evening, morning = dt.datetime(2024, 1, 1, 18, 30), dt.datetime(2024, 1, 2, 5, 0)
    df = spark.createDataFrame(
        [(evening, 10.0, 1.0, 0.0), (evening + dt.timedelta(minutes=15), 99.0, 9.0, 9.0), (morning, 73.0, 1.0, 0.0)],
        "DateTime timestamp_ntz, GHI double, DNI double, DHI double",
    )
    tens = {r["DateTime"]: r["GHI"] for r in irradiance.irradiance_ten_minutes(df).collect()}
    assert tens == {evening: 10.0, dt.datetime(2024, 1, 1, 18, 40): 11.0, dt.datetime(2024, 1, 1, 18, 50): 12.0,
                    dt.datetime(2024, 1, 1, 19, 0): 13.0, morning: 73.0}
    minutes = irradiance.irradiance_minutes(irradiance.irradiance_ten_minutes(df))
    assert minutes.count() == 10 * 60 + 31
    assert minutes.where(F.col("GHI").isNull()).count() == 0


def test_generators(spark):
    assert grid.time_grid(spark, "2024-01-01 00:00:00", "2024-01-01 01:00:00", 600).count() == 7
    days = grid.date_list(spark, "2024-01-01", "2024-10-31", "day")
    assert days.count() == 305
    assert grid.day_minutes(days).count() == 256_505
    slots = spark.createDataFrame([(at(30),)], "slot_start timestamp_ntz")
    got = [r["DateTime"] for r in grid.expand_slots(slots).orderBy("DateTime").collect()]
    assert got == [at(30 + i) for i in range(10)]


def test_hold_last_equals_the_ordered_fill(spark, small_chunks):
    from sunledger.operators.ordering import forward_fill

    draw = random.Random(8)
    rows = [
        (site, at(m), None if draw.random() < 0.9 else float(m))
        for site in (1, 2, None)
        for m in draw.sample(range(5 * 1440), 200)
    ]
    df = spark.createDataFrame(rows, "LocationCode int, DateTime timestamp_ntz, v double").repartition(4)
    held = grid.hold_last(df, ["v"], ["LocationCode"])
    want = forward_fill(df, ["v"], ["DateTime"], by=["LocationCode"])
    assert sorted(map(str, held.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("operator", [grid.resample_linear, grid.upsample_hold])
def test_a_gap_of_decades_spreads_over_all_tasks(spark, operator):
    """54 years at one minute between two rows: the ticks are made by all tasks, by the day."""
    rows = [(dt.datetime(1970, 1, 1), 0.0), (dt.datetime(2024, 1, 1), 54.0)]
    got = operator(spark.createDataFrame(rows, SCHEMA), ["v"], step=60)
    per_task = got.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count("*").alias("n"), F.countDistinct("DateTime").alias("ticks")
    ).collect()
    total = (dt.datetime(2024, 1, 1) - dt.datetime(1970, 1, 1)).days * 1440 + 1
    assert sum(r["n"] for r in per_task) == sum(r["ticks"] for r in per_task) == total
    assert len(per_task) == 8 and max(r["n"] for r in per_task) < total / 6


@pytest.mark.parametrize("step", [7, 600, 86_400, 100_000])
def test_ticks_of_long_gaps_are_those_of_one_sequence(spark, step):
    first = dt.datetime(2023, 2, 27, 23, 59, 53)
    rows = [(first, 1.0), (first + dt.timedelta(seconds=step * 3), None), (first + dt.timedelta(days=3, seconds=11), 5.0)]
    df = spark.createDataFrame(sorted(rows, key=lambda r: r[0]), SCHEMA)
    got = listed(grid.resample_linear(df, ["v"], step=step, origin="min"))
    reach = int((max(r[0] for r in rows) - first).total_seconds()) // step
    assert [t for t, _ in got] == [first + dt.timedelta(seconds=step * i) for i in range(reach + 1)]
