from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sunledger.operators import ordering


def test_golden_interpolation(spark):
    rows = list(enumerate([None, 1.0, None, None, 4.0, None, None]))
    df = spark.createDataFrame(rows, "i int, v double")
    got = ordering.interpolate_rows(df, ["v"], ["i"]).orderBy("i").collect()
    assert [r["v"] for r in got] == [None, 1.0, 2.0, 3.0, 4.0, 4.0, 4.0]


@pytest.mark.parametrize("seed", [1, 2])
def test_interpolation_equals_pandas_across_chunks(spark, small_chunks, seed):
    draw = random.Random(seed)
    rows = [
        (i, None if draw.random() < 0.8 else draw.uniform(-5, 5), None if draw.random() < 0.3 else float(i * i))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "i int, a double, b double").repartition(5)
    got = ordering.interpolate_rows(df, ["a", "b"], ["i"]).toPandas().sort_values("i").reset_index(drop=True)
    want = pd.DataFrame(rows, columns=["i", "a", "b"]).astype("float64")
    want[["a", "b"]] = want[["a", "b"]].interpolate(method="linear")
    pd.testing.assert_frame_equal(got.astype("float64"), want, rtol=1e-12)


def test_series_do_not_mix(spark, small_chunks):
    draw = random.Random(5)
    rows = [(k, i, None if draw.random() < 0.7 else float(i)) for k in "abcde" for i in range(37)]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    frame = pd.DataFrame(rows, columns=["k", "i", "v"])
    filled = ordering.forward_fill(df, ["v"], ["i"], by=["k"]).toPandas().sort_values(["k", "i"])
    want = frame.groupby("k")["v"].ffill()
    pd.testing.assert_series_equal(
        filled["v"].reset_index(drop=True).astype("float64"), want.astype("float64"), check_names=False
    )
    lines = ordering.interpolate_rows(df, ["v"], ["i"], by=["k"]).toPandas().sort_values(["k", "i"])
    want = frame.groupby("k")["v"].transform(lambda s: s.astype("float64").interpolate(method="linear"))
    pd.testing.assert_series_equal(
        lines["v"].reset_index(drop=True).astype("float64"), want, check_names=False, rtol=1e-12
    )


def test_long_gap_over_whole_partitions(spark, small_chunks):
    rows = [(i, 0.0 if i == 0 else 100.0 if i == 100 else None) for i in range(101)]
    df = spark.createDataFrame(rows, "i int, v double")
    got = ordering.interpolate_rows(df, ["v"], ["i"]).orderBy("i").collect()
    assert [r["v"] for r in got] == pytest.approx([float(i) for i in range(101)])


def test_positions_and_partitioning(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5000).alias("v"))
    for parts in (1, 7, 32):
        got = ordering.add_positions(df.repartition(parts), ["v"])
        assert got.where("position <> v").count() == 0
        assert got.count() == 5000


def test_chunks_are_bounded_under_one_hot_time(spark, small_chunks):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("t"), F.col("id").alias("tie")
    )
    numbered = ordering.number_rows(rows, ["t", "tie"])
    sizes = numbered.groupBy(F.shiftright(ordering.ROW, 2)).count()
    assert sizes.agg(F.max("count")).first()[0] <= 4
