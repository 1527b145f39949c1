from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sunledger.operators import boosting, features, folds
from sunledger.operators.boosting import BoostParams, FoldModels
from sunledger.operators.features import LABEL, PREDICTION
from sunledger.plans import feedback, training

KEYS = ["LocationCode", "DateTime"]
PARAMS = BoostParams(learning_rate=0.3, max_depth=3, rounds=3, patience=1, subsample=0.8, max_bins=32)


@pytest.fixture(scope="module")
def table(spark):
    """Feature rows whose power follows the elevation."""
    rows = spark.range(1200).select(
        (F.col("id") % 3 + 1).cast("int").alias("LocationCode"),
        F.expr("TIMESTAMP_NTZ'2024-01-01 05:00:00' + INTERVAL '1' MINUTE * id").alias("DateTime"),
        *[((F.col("id") * k) % 97).cast("double").alias(c) for k, c in enumerate(features.FEATURE_SETS["full"], 2)],
    )
    return rows.withColumn(LABEL, F.col("Elevation") * 10 + F.col("LocationCode")).cache()


def test_one_hot_order_and_unknown(spark):
    known = features.fit_categories(spark.createDataFrame([(k,) for k in (1, 2, 10, 17, 2)], "LocationCode int"))
    assert known == ["1", "10", "17", "2"]
    got = features.one_hot(spark.createDataFrame([(10,), (99,), (None,)], "LocationCode int"), known)
    assert got.columns[1:] == ["LocationCode_1", "LocationCode_10", "LocationCode_17", "LocationCode_2"]
    assert {r["LocationCode"]: tuple(r)[1:] for r in got.collect()} == {
        10: (0.0, 1.0, 0.0, 0.0),
        99: (0.0,) * 4,
        None: (0.0,) * 4,
    }


def test_categories_have_no_cap(spark):
    known = features.fit_categories(spark.range(20_000).withColumnRenamed("id", "LocationCode"))
    assert len(known) == 20_000 and known == sorted(known)


def test_feature_set_sizes():
    sites = [str(i) for i in range(1, 18)]
    sizes = {v: len(features.feature_names(v, sites)) for v in features.FEATURE_SETS}
    assert sizes == {"base": 25, "angle": 26, "full": 29, "pseudo": 29}


def test_alignment_adds_drops_and_fills(spark):
    df = spark.createDataFrame([(1, None, 5.0)], "k int, a double, extra double")
    got = features.align_features(df, ["b", "a"], keep=["k"])
    assert got.columns == ["k", "b", "a"]
    assert tuple(got.first()) == (1, 0.0, 0.0)


def test_null_policy(spark):
    columns = ", ".join(f"{c} double" for c in features.FEATURE_SETS["base"])
    rows = [(1, dt.datetime(2024, 1, 1), 1.0, None, 1.0, 1.0, 1.0, 5.0), (1, dt.datetime(2024, 1, 2), *[1.0] * 5, None)]
    df = spark.createDataFrame(rows, f"LocationCode int, DateTime timestamp_ntz, {columns}, `{LABEL}` double")
    dropped = features.training_matrix(df, "base", ["1"])
    assert [r["DateTime"].day for r in dropped.collect()] == [2]
    assert features.training_matrix(df, "base", ["1"], null_policy="zero").where("GHI = 0").count() == 1


@pytest.mark.parametrize("parts", [1, 7, 32])
def test_folds_do_not_depend_on_partitioning(spark, parts):
    df = spark.range(3000).withColumnRenamed("id", "k")
    hashed = {r["k"]: r["fold"] for r in folds.assign_folds(df.repartition(parts), ["k"]).collect()}
    assert hashed == {r["k"]: r["fold"] for r in folds.assign_folds(df, ["k"]).collect()}
    assert set(hashed.values()) == set(range(10)) and len(hashed) == 3000
    dealt = folds.assign_balanced_folds(df.repartition(parts), ["k"])
    assert {r["count"] for r in dealt.groupBy("fold").count().collect()} == {300}


def test_day_folds_keep_days_together(spark):
    df = spark.range(0, 86_400 * 40, 7200).select(
        F.expr("TIMESTAMP_NTZ'2024-01-01' + INTERVAL '1' SECOND * id").alias("DateTime")
    )
    per_day = folds.assign_day_folds(df).groupBy(F.to_date("DateTime")).agg(F.countDistinct("fold").alias("n"))
    assert per_day.where("n <> 1").count() == 0


def test_best_round_uses_patience():
    assert boosting.best_round([5, 4, 3, 4, 5, 1], patience=2) == 3
    assert boosting.best_round([5, 4, 3, 4, 5, 1], patience=3) == 6
    assert boosting.best_round([3, 3, 3], patience=9) == 1


def test_train_save_replay_and_score(spark, table, tmp_path):
    matrix, names = training.prepare_matrix(table, "full", fold_count=3)
    assert names == [*features.FEATURE_SETS["full"], *features.CALENDAR]
    run = training.train(matrix, names, PARAMS, fold_ids=range(3))
    oof = run.out_of_fold
    assert oof.count() == matrix.count() == oof.select(*KEYS).distinct().count()
    assert run.cv_metrics.first()["r2"] > 0.5

    path = str(tmp_path / "run")
    training.save_run(run, path)
    saved = FoldModels.load(f"{path}/models")
    assert saved.features == names and saved.params == PARAMS and saved.category == "LocationCode"
    tables = ["feature_correlations", "null_counts", "fold_metrics", "cv_metrics", "oof_predictions", "fold_assignment"]
    assert all(spark.read.parquet(f"{path}/{t}").count() for t in tables)

    # Sums are of whole numbers: training again gives the very same trees.
    stored = sorted(map(str, saved.nodes.collect()))
    wanted = sorted(map(tuple, run.fold_metrics.collect()))
    for mode in ("retrain", "rescore"):
        again = training.replay(table.repartition(5), "full", path, mode)
        assert sorted(map(tuple, again.fold_metrics.collect())) == [pytest.approx(row, rel=1e-12) for row in wanted]
        assert sorted(map(str, again.models.nodes.collect())) == stored

    serving = table.drop("GHI").withColumn("LocationCode", F.when(F.col("LocationCode") == 3, 99).otherwise(F.col("LocationCode")))
    scored = training.score_table(serving, saved)
    assert scored.columns == [*KEYS, PREDICTION]
    assert scored.where(F.col(PREDICTION).isNotNull()).count() == serving.count()

    more = training.pseudo_label_round(table, serving.withColumn(LABEL, F.lit(None).cast("double")), saved)
    assert more.groupBy("label_source").count().count() == 2
    assert more.where(F.col(LABEL).isNull()).count() == 0


def test_replays_share_a_matrix(spark, table, tmp_path, monkeypatch):
    matrix, names = training.prepare_matrix(table, "base", fold_count=2)
    run = training.train(matrix, names, BoostParams(rounds=1, max_depth=1, max_bins=8), fold_ids=range(2))
    path = str(tmp_path / "run")
    training.save_run(run, path)
    written, write = [], training.materialise
    monkeypatch.setattr(training, "materialise", lambda df, label: written.append(label) or write(df, label))
    shared = training.replay_matrix(table, "base", path)
    wanted = sorted(map(tuple, run.fold_metrics.collect()))
    for mode in ("retrain", "rescore"):
        again = training.replay(table, "base", path, mode, matrix=shared)
        assert sorted(map(tuple, again.fold_metrics.collect())) == [pytest.approx(row, rel=1e-12) for row in wanted]
    assert written == ["replay", "oof", "oof"]


def test_stored_predictions_give_the_metrics_in_sql(spark, table, tmp_path):
    import duckdb

    matrix, names = training.prepare_matrix(table, "angle", fold_count=3)
    run = training.train(matrix, names, PARAMS, fold_ids=range(3))
    path = str(tmp_path / "run")
    training.save_run(run, path)
    off = f'("{LABEL}" - "{PREDICTION}")'
    sql = f"""SELECT fold, count(*), sqrt(avg({off} * {off})), avg({off} * {off}), avg(abs({off})),
        1 - avg({off} * {off}) / var_pop("{LABEL}") FROM read_parquet('{path}/oof_predictions/*.parquet') GROUP BY fold"""
    stored = spark.read.parquet(f"{path}/fold_metrics").select("fold", "rows", "rmse", "mse", "mae", "r2")
    assert sorted(duckdb.sql(sql).fetchall()) == [pytest.approx(r, rel=1e-9) for r in sorted(map(tuple, stored.collect()))]


def test_category_correlations(table):
    from sunledger.operators.statistics import category_correlations, correlation_matrix

    names = ["GHI", "Elevation", LABEL]
    wide = features.one_hot(table, ["1", "2", "3"])
    hot = [f"LocationCode_{k}" for k in (1, 2, 3)]
    want = {(r.x, r.y): r.r for r in correlation_matrix(wide, [*names, *hot], None).collect()}
    got = category_correlations(table, names, "LocationCode", "LocationCode_", None).collect()
    assert {(r.x, r.y) for r in got} == {(a, b) for a, b in want if (a in hot) != (b in hot)}
    assert all(r.r == pytest.approx(want[r.x, r.y], abs=1e-9) for r in got)


def test_sampled_params_are_in_the_space():
    drawn = boosting.sample_params(50, BoostParams())
    assert drawn == boosting.sample_params(50, BoostParams())
    assert all(0.01 <= p.learning_rate <= 0.3 and 6 <= p.max_depth <= 12 for p in drawn)
    assert all(1e-3 <= p.reg_lambda <= 10 for p in drawn)
    assert all(0.5 <= p.subsample <= 1 and 0.5 <= p.colsample <= 1 for p in drawn)


def test_pseudo_labels_clamp_and_keep_measured(spark):
    day = dt.datetime(2024, 1, 1)
    schema = f"LocationCode int, DateTime timestamp_ntz, `{LABEL}` double"
    serving = spark.createDataFrame([(1, day, None), (2, day, 7.0), (3, day, None), (4, day, None)], schema)
    scored = spark.createDataFrame(
        [(1, day, -5.0), (2, day, 1.0), (3, day, 4.0)],
        f"LocationCode int, DateTime timestamp_ntz, `{PREDICTION}` double",
    )
    got = {r["LocationCode"]: r[LABEL] for r in feedback.merge_predictions(serving, scored).collect()}
    assert got == {1: 0.0, 2: 7.0, 3: 4.0, 4: None}
