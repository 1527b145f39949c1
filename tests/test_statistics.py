from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sunledger.operators import statistics


def matrix(df, columns):
    rows = statistics.correlation_matrix(df, columns, digits=None).toPandas()
    return rows.pivot(index="x", columns="y", values="r").loc[columns, columns].astype("float64")


def test_golden_correlation(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 1.0), (2.0, 1.0, 1.0), (3.0, None, 1.0), (None, 4.0, 1.0)], "a double, b double, c double"
    )
    got = {(r["x"], r["y"]): r["r"] for r in statistics.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9
    assert got[("a", "b")] == got[("b", "a")] == -1.0
    assert got[("a", "a")] == 1.0
    assert got[("a", "c")] is got[("c", "c")] is None


@pytest.mark.parametrize("parts", [1, 8])
def test_correlation_equals_pandas_with_nulls_and_large_offsets(spark, parts):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(rng.normal(size=(3000, 6)), columns=list("abcdef"))
    frame["b"] = frame["a"] * 2 + frame["b"] * 0.1
    frame["c"] = frame["c"] + 1e7
    frame["f"] = 0.1
    frame = frame.mask(rng.random(frame.shape) < 0.2)
    frame.loc[:, "e"] = np.where(np.arange(3000) < 1500, frame["e"], np.nan)
    df = spark.createDataFrame(frame).replace(float("nan"), None).repartition(parts)
    pd.testing.assert_frame_equal(
        matrix(df, list("abcdef")), frame.corr(), check_names=False, rtol=1e-7, atol=1e-9
    )


def test_pair_without_common_rows_is_null(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, 1.0), (None, 2.0)], "a double, b double")
    got = {(r["x"], r["y"]): r["r"] for r in statistics.correlation_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "b")] is None and got[("a", "a")] == 1.0


def test_metrics_equal_their_definitions(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(100, 20, 500), rng.normal(100, 20, 500)
    frame = pd.DataFrame({"y": y, "p": p, "g": np.arange(500) % 2})
    got = statistics.regression_metrics(spark.createDataFrame(frame), "y", "p", by=["g"]).toPandas().set_index("g")
    for g, part in frame.groupby("g"):
        e = part["y"] - part["p"]
        assert got.loc[g, "rows"] == 250
        assert got.loc[g, "mse"] == pytest.approx((e**2).mean())
        assert got.loc[g, "rmse"] == pytest.approx(np.sqrt((e**2).mean()))
        assert got.loc[g, "mae"] == pytest.approx(e.abs().mean())
        assert got.loc[g, "r2"] == pytest.approx(1 - (e**2).sum() / ((part["y"] - part["y"].mean()) ** 2).sum())


def test_metrics_of_a_constant_label(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "y double, p double")
    assert statistics.regression_metrics(df, "y", "p").first()["r2"] is None


def test_metrics_match_spark_ml(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    df = spark.range(200).select(F.sqrt("id").alias("y"), F.log1p("id").alias("p"))
    ours = statistics.regression_metrics(df, "y", "p").first()
    for name in ("rmse", "mse", "mae", "r2"):
        theirs = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(df)
        assert ours[name] == pytest.approx(theirs)
