from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sunledger.operators import joins
from sunledger.operators.features import PREDICTION, site_dimension
from sunledger.plans import questions, weather

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def asof(spark, left, right, **options):
    ldf = spark.createDataFrame(left, "i int, t timestamp_ntz")
    rdf = spark.createDataFrame(right, "seq int, rt timestamp_ntz, v double")
    got = joins.asof_join(ldf, rdf, "t", "rt", ["v"], sequence="seq", **options)
    return {r["i"]: r["v"] for r in got.collect()}


def test_asof_tolerance_is_inclusive_and_the_last_tie_wins(spark):
    got = asof(spark, [(1, at(0)), (2, at(600)), (3, at(601)), (4, None)], [(1, at(0), 1.0), (2, at(0), 2.0)])
    assert got == {1: 2.0, 2: 2.0, 3: None, 4: None}


def test_asof_keeps_a_matched_null(spark):
    got = asof(spark, [(1, at(20))], [(1, at(0), 5.0), (2, at(10), None)])
    assert got == {1: None}


def test_asof_inside_one_second(spark):
    micro = dt.timedelta(microseconds=1)
    got = asof(spark, [(1, at(5) + micro), (2, at(5) + 3 * micro)], [(1, at(5) + 2 * micro, 7.0), (2, at(4), 3.0)])
    assert got == {1: 3.0, 2: 7.0}


@pytest.mark.parametrize("seed", [1, 2])
def test_asof_equals_pandas_with_and_without_keys(spark, seed):
    draw = random.Random(seed)
    left = pd.DataFrame(
        {"t": [at(draw.randrange(20_000) / 2) for _ in range(300)], "k": [draw.choice("ab") for _ in range(300)]}
    ).sort_values("t", kind="stable").reset_index(drop=True)
    left["i"] = range(300)
    right = pd.DataFrame(
        {"rt": [at(draw.randrange(20_000) / 2) for _ in range(60)], "k": [draw.choice("ab") for _ in range(60)]}
    ).drop_duplicates("rt").sort_values("rt").reset_index(drop=True)
    right["v"] = [float(i) for i in range(len(right))]
    ldf = spark.createDataFrame(left, "t timestamp_ntz, k string, i int").repartition(4)
    rdf = spark.createDataFrame(right, "rt timestamp_ntz, k string, v double").repartition(3)
    for by in ([], ["k"]):
        got = joins.asof_join(ldf, rdf, "t", "rt", ["v"], tolerance=300, by=by).toPandas().sort_values("i")
        want = pd.merge_asof(
            left,
            right if by else right.drop(columns="k"),
            left_on="t",
            right_on="rt",
            by=by or None,
            tolerance=pd.Timedelta("300s"),
        )
        pd.testing.assert_series_equal(
            got["v"].reset_index(drop=True), want["v"], check_names=False, check_dtype=False
        )


def test_asof_hot_moment_forms_no_pairs(spark):
    # A third of both sides at one moment: pairs would be 10,000 x 10,000.
    hot = F.when(F.col("id") % 3 == 0, F.lit(at(0))).otherwise(
        F.expr("TIMESTAMP_NTZ'2024-01-01' + INTERVAL '1' SECOND * id")
    )
    left = spark.range(30_000).select(F.col("id").alias("i"), hot.alias("t"))
    right = spark.range(30_000).select(F.col("id").alias("seq"), hot.alias("rt"), F.col("id").cast("double").alias("v"))
    got = joins.asof_join(left, right, "t", "rt", ["v"], sequence="seq")
    assert got.count() == 30_000
    assert {r["v"] for r in got.where(F.col("t") == F.lit(at(0))).select("v").distinct().collect()} == {29_997.0}
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_temperature_is_filled_per_site_and_uv_is_not(spark, small_chunks):
    rows = spark.createDataFrame(
        [(1, at(60)), (1, at(1200)), (2, at(1200)), (2, at(30))], "LocationCode int, DateTime timestamp_ntz"
    )
    seen = spark.createDataFrame([(at(60), 1.26, 20.0)], "time timestamp_ntz, H_UVI double, TEMP double")
    got = weather.add_weather(rows, seen).orderBy("LocationCode", "DateTime").collect()
    assert [(r["H_UVI"], r["TEMP"], r["H_UVI_TEMP_interaction"]) for r in got] == [
        (1.3, 20.0, 26.2),
        (None, 20.0, None),
        (None, None, None),
        (None, None, None),
    ]


def test_lookup_default_and_unmapped(spark):
    rows = spark.createDataFrame([(8,), (99,), (None,)], "LocationCode int")
    dim = site_dimension(spark)
    got = joins.lookup_default(rows, dim, ["angle", "story"])
    assert {tuple(r) for r in got.collect()} == {(8, 219, 3), (99, 0, 0), (None, 0, 0)}
    assert {r[0] for r in joins.unmapped_keys(rows, dim).collect()} == {99, None}
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_slot_answers_match_brute_force(spark):
    draw = random.Random(4)
    scored = [
        (draw.randrange(1, 4), at(draw.randrange(0, 40_000) / 10), draw.uniform(-50, 60)) for _ in range(800)
    ]
    scored += [(1, at(600 * i), 1.0) for i in range(6)] + [(1, at(540 + 600 * i), -2.0) for i in range(6)]
    asked = [(i, f"20240101{m // 60:02d}{m % 60:02d}{s:02d}") for i, (m, s) in enumerate(
        (draw.randrange(0, 70), draw.randrange(1, 5)) for _ in range(60))]
    asked += [(100, "x"), (101, asked[0][1])]
    preds = spark.createDataFrame(scored, f"LocationCode int, DateTime timestamp_ntz, `{PREDICTION}` double")
    quest = spark.createDataFrame(asked, "i int, serial string")
    got = {r["i"]: (r["answer"], r["answer_text"]) for r in questions.answer_questions(quest, preds).collect()}
    assert len(got) == len(asked)
    for i, serial in asked:
        if serial == "x":
            assert got[i] == (None, "N/A")
            continue
        start = dt.datetime.strptime(serial[:12], "%Y%m%d%H%M")
        inside = [v for s, t, v in scored if s == int(serial[12:]) and start <= t <= start + dt.timedelta(minutes=9)]
        if not inside:
            assert got[i] == (None, "N/A")
        else:
            mean = max(sum(inside) / len(inside), 0.0)
            assert got[i][0] == pytest.approx(mean, abs=0.0051)


def test_negative_slot_mean_is_zero_and_empty_slot_is_null(spark):
    preds = spark.createDataFrame(
        [(1, at(0), -4.0), (1, at(60), 2.0)], f"LocationCode int, DateTime timestamp_ntz, `{PREDICTION}` double"
    )
    quest = spark.createDataFrame([("20240101000001",), ("20240101003001",)], "serial string")
    got = {r["serial"]: (r["answer"], r["answer_text"]) for r in questions.answer_questions(quest, preds).collect()}
    assert got == {"20240101000001": (0.0, "0.00"), "20240101003001": (None, "N/A")}


def test_question_expansion_and_rejects(spark):
    quest = spark.createDataFrame(
        [("20240117093001",), ("",), ("20243017093001",), ("202401170930xx",), (None,)], "serial string"
    )
    rows = questions.expand_questions(quest)
    assert rows.count() == 10
    assert rows.where("LocationCode = 1 AND `Power(mW)` IS NULL").count() == 10
    rejected = questions.split_serials(quest)[1]
    assert sorted(r["reason"] for r in rejected.collect()) == ["blank", "blank", "datetime", "site"]


INTERVALS = "q int, LocationCode int, start timestamp_ntz, end timestamp_ntz"


@pytest.mark.parametrize("closed", ["both", "left", "right", "neither"])
def test_interval_means_equal_a_plain_search(spark, small_chunks, closed):
    """Any bounds, ties with samples, one site with most rows, over many chunk borders."""
    r = random.Random(closed)
    zero = dt.datetime(2024, 1, 1)

    def moment():
        return zero + dt.timedelta(seconds=r.randrange(0, 400), microseconds=r.choice((0, 0, 500_000)))

    rows = [(r.choice((1, 1, 1, 2)), moment(), r.choice((None, 0.1, 1.25, -3.0, 1e6 + 0.3))) for _ in range(300)]
    asked = [(i, r.choice((1, 2, 3)), moment(), moment()) for i in range(80)]
    asked += [(90, 1, zero, None), (91, None, zero, zero), (92, 1, rows[0][1], rows[0][1])]
    samples = spark.createDataFrame(rows, "LocationCode int, DateTime timestamp_ntz, v double").repartition(5)
    got = joins.interval_means(spark.createDataFrame(asked, INTERVALS), samples, "v", closed=closed).collect()
    assert len(got) == len(asked)
    for g in got:
        lo, hi = g["start"], g["end"]
        inside = []
        if None not in (lo, hi, g["LocationCode"]):
            for site, at, v in rows:
                left = at >= lo if closed in ("both", "left") else at > lo
                right = at <= hi if closed in ("both", "right") else at < hi
                if site == g["LocationCode"] and v is not None and left and right and lo <= hi:
                    inside.append(v)
        assert g["interval_rows"] == len(inside)
        assert g["interval_mean"] == (pytest.approx(sum(inside) / len(inside), rel=1e-12) if inside else None)


def test_interval_means_enumerate_no_minutes(spark):
    """An interval of 500 years is two points; repeated intervals keep their rows."""
    asked = [(i, 1, dt.datetime(1700, 1, 1), dt.datetime(2200, 1, 1)) for i in range(3)]
    samples = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 2.0)], "LocationCode int, DateTime timestamp_ntz, v double")
    got = joins.interval_means(spark.createDataFrame(asked, INTERVALS), samples, "v")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert [(r["interval_rows"], r["interval_mean"]) for r in got.collect()] == [(1, 2.0)] * 3


def test_running_sums_over_chunks(spark, small_chunks):
    from sunledger.operators import ordering

    df = spark.range(200).selectExpr("id", "CAST(id * 0.1 AS DECIMAL(28,9)) AS d", "CASE WHEN id % 3 = 0 THEN id END AS n")
    got = ordering.running_sums(ordering.number_rows(df.repartition(6), ["id"]), ["d", "n"]).orderBy("id").collect()
    d = n = 0
    for i, row in enumerate(got):
        d, n = d + i, n + (i if i % 3 == 0 else 0)
        assert float(row["d"]) == pytest.approx(d / 10, abs=1e-9) and row["n"] == n
