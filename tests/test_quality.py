from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sunledger.operators import quality
from sunledger.plans import power


def ts(minute, second=0, micro=0):
    return dt.datetime(2024, 1, 1, 0, minute, second, micro)


SCHEMA = "event_id bigint, LocationCode int, DateTime timestamp_ntz, `Power(mW)` double"


def test_dedup_first_takes_whole_rows_by_order(spark):
    rows = [(1, 5, None, "b"), (1, 3, 7.0, "a"), (2, 1, 1.0, "z"), (1, 4, 8.0, "c")]
    df = spark.createDataFrame(rows, "k int, o int, v double, s string")
    got = quality.dedup_first(df, ["k"], ["o"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, 3, 7.0, "a"), (2, 1, 1.0, "z")]
    numbers = quality.dedup_first(df.drop("s"), ["k"], ["o"]).orderBy("k").collect()
    assert [tuple(r) for r in numbers] == [(1, 3, 7.0), (2, 1, 1.0)]


def test_dedup_first_keeps_a_null_value_that_comes_first(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5.0)], "k int, o int, v double")
    assert quality.dedup_first(df, ["k"], ["o"]).first()["v"] is None


def test_duplicate_rows_reports_all_members(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, s string")
    assert sorted(r["s"] for r in quality.duplicate_rows(df, ["k"]).collect()) == ["a", "b", "d", "e"]


def test_rejects_and_accepted_are_a_partition(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, 1.0, 1.0), (3, 2.0, None)], "i int, a double, b double")
    good, bad = quality.split_rejects(df, ["a", "b"])
    assert [r["i"] for r in good.collect()] == [2]
    assert sorted(r["i"] for r in bad.collect()) == [1, 3]


def test_main_source_wins_and_earliest_of_the_minute_stays(spark):
    main = spark.createDataFrame([(1, 1, ts(0, 30), 1.0), (2, 1, ts(1, 5), 2.0)], SCHEMA)
    extra = spark.createDataFrame(
        [(3, 1, ts(0, 30), 9.0), (4, 1, ts(1, 1), 8.0), (5, 2, ts(0), 7.0), (6, 2, None, 6.0)], SCHEMA
    )
    both = power.combine_power(main, extra, tie=["event_id"])
    assert sorted(r["event_id"] for r in both.collect()) == [1, 2, 4, 5]
    steps = power.dedup_minutes(both, tie=["event_id"]).orderBy("event_id")
    once = power.clean_power(main, extra, tie=["event_id"]).orderBy("event_id")
    columns = ["LocationCode", "DateTime", "Power(mW)", "event_id"]
    assert steps.select(columns).collect() == once.select(columns).collect()
    assert [r["event_id"] for r in once.collect()] == [1, 4, 5]


def test_sensor_columns_are_dropped_if_there(spark):
    df = spark.createDataFrame([(1, 1, ts(0), 1.0)], SCHEMA).withColumn("WindSpeed(m/s)", F.lit(1.0))
    assert "WindSpeed(m/s)" not in power.dedup_minutes(df).columns


def test_hot_minute_is_merged_before_the_shuffle(spark):
    rows = spark.range(30_000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 17).cast("int")).alias("LocationCode"),
        F.when(F.col("id") % 3 == 0, F.lit(ts(7)))
        .otherwise(F.expr("TIMESTAMP_NTZ'2024-01-01' + INTERVAL '1' SECOND * id"))
        .alias("DateTime"),
        F.col("id").cast("double").alias("Power(mW)"),
    )
    got = power.dedup_minutes(rows, tie=["event_id"])
    hot = got.where((F.col("LocationCode") == 1) & (F.col("DateTime") == F.lit(ts(7)))).collect()
    assert [r["event_id"] for r in hot] == [0]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_null_counts_and_reports(spark):
    df = spark.createDataFrame([(1, None, 1.0), (1, None, None), (2, 1.0, 1.0)], "s int, a double, b double")
    assert {r["column"]: r["nulls"] for r in quality.null_counts(df, ["s", "a", "b"]).collect()} == {
        "s": 0,
        "a": 2,
        "b": 1,
    }
    assert [tuple(r) for r in quality.missing_report(df, ["a", "b"], ["s"]).collect()] == [(1, 2)]


def test_start_cutoff(spark):
    rows = [(1, ts(0)), (1, ts(9)), (2, ts(0)), (None, ts(0))]
    df = spark.createDataFrame(rows, "LocationCode int, DateTime timestamp_ntz")
    got = quality.start_cutoff(df, {1: "2024-01-01 00:05:00"}).collect()
    assert len(got) == 3
