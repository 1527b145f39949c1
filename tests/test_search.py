"""Parameter search over stored studies."""

from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from sunledger.operators import search
from sunledger.operators.boosting import BoostParams
from sunledger.operators.features import LABEL
from sunledger.operators.search import SPACE, Dimension, Parzen, Study


def planted(point):
    """Least at one place of the space, and flat in none of the parameters."""
    rate = (math.log(point["learning_rate"]) - math.log(0.08)) / 1.5
    penalty = (math.log(point["reg_lambda"]) - math.log(2.0)) / 4
    return rate**2 + penalty**2 + ((point["max_depth"] - 9) / 3) ** 2 + 4 * (point["subsample"] - 0.8) ** 2 + (point["colsample"] - 0.6) ** 2


def best_of(trials, seed, guided):
    done = []
    for t in range(trials):
        rng = random.Random(f"{seed}|{t}")
        point = search.suggest(done, SPACE, rng) if guided else search.random_point(SPACE, rng)
        done.append((point, planted(point)))
    return min(v for _, v in done)


def test_search_beats_random_draws():
    guided = [best_of(50, seed, True) for seed in range(20)]
    drawn = [best_of(50, seed, False) for seed in range(20)]
    assert statistics.median(guided) < 0.5 * statistics.median(drawn)
    assert sum(a < b for a, b in zip(guided, drawn, strict=True)) >= 15


def test_points_stay_in_the_space():
    rng, done = random.Random(0), []
    for _ in range(60):
        point = search.suggest(done, SPACE, rng)
        for d in SPACE:
            assert d.low <= point[d.name] <= d.high
            assert not d.whole or isinstance(point[d.name], int)
        done.append((point, planted(point)))
    assert {p["max_depth"] for p, _ in done} > {8, 9}


def test_densities_add_up_to_one():
    for observed in ([], [0.5], [0.1, 0.1, 0.9], [0.0, 1.0]):
        density = Parzen(observed, 0.0, 1.0)
        steps = [math.exp(density.log_density((i + 0.5) / 2000)) for i in range(2000)]
        # Without the constant of the normal density.
        assert sum(steps) / 2000 / math.sqrt(2 * math.pi) == pytest.approx(1, abs=0.01)
        rng = random.Random(1)
        assert all(0 <= density.draw(rng) <= 1 for _ in range(200))


def test_whole_numbers_reach_both_ends():
    d = Dimension("n", 6, 12, whole=True)
    rng = random.Random(2)
    assert {d.outer(rng.uniform(*d.span)) for _ in range(500)} == set(range(6, 13))


def objective(log=None):
    def evaluate(candidates):
        if log is not None:
            log.append(len(candidates))
        return [(planted({d.name: getattr(p, d.name) for d in SPACE}), []) for p in candidates]

    return evaluate


def test_a_stopped_study_goes_on(spark, tmp_path):
    whole = Study(spark, str(tmp_path / "whole"))
    best = whole.search(objective(), 14)
    calls = []
    Study(spark, str(tmp_path / "parts")).search(objective(calls), 9)
    again = Study(spark, str(tmp_path / "parts"))
    assert again.search(objective(calls), 14) == best
    assert again.trials() == whole.trials() and len(calls) == 14
    # A study that has all its trials runs none.
    assert again.search(objective(calls), 14) == best and len(calls) == 14


def test_time_budget_and_failed_trials(spark, tmp_path):
    study = Study(spark, str(tmp_path / "s"))
    study.search(objective(), 50, seconds=0.0)
    assert len(study.trials()) == 1
    study.tell(1, BoostParams(), math.nan, 0.0, [])
    assert study.best() == study.trials()[0][1]
    with pytest.raises(ValueError, match="no trial"):
        Study(spark, str(tmp_path / "none")).best()


def test_study_of_boosting(spark, tmp_path):
    rows = spark.range(300).selectExpr(
        "id", "id % 7 AS a", "id % 3 AS s", f"CAST((id % 7) * 10 AS DOUBLE) AS `{LABEL}`", "CAST(id % 2 AS INT) AS fold"
    )
    base = BoostParams(rounds=2, patience=2, max_bins=16)
    study = Study(spark, str(tmp_path / "s"), base)
    best = study.run(rows, ["a"], "s", ["id"], range(2), trials=3, at_once=2)
    table = study.fold_table()
    assert table.groupBy("trial").count().orderBy("trial").collect() == [(0, 2), (1, 2), (2, 2)]
    means = table.groupBy("params").agg(F.avg("rmse").alias("rmse")).orderBy("rmse")
    assert BoostParams.from_json(means.first()["params"]) == best
    assert best.rounds == 2 and 1e-3 <= best.reg_lambda <= 10
