"""Histogram boosting against a plain NumPy version, tree by tree."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunledger.operators import boosting, encoding
from sunledger.operators.boosting import BoostParams, FoldModels
from sunledger.operators.features import LABEL, PREDICTION
from sunledger.operators.folds import key_digest

FEATURES = ["a", "b", "c"]
PARAMS = BoostParams(
    learning_rate=0.4, max_depth=3, subsample=0.8, colsample=0.7, rounds=6, patience=3, reg_lambda=2.5, max_bins=16
)


def brute_fit(x, site, categories, y, fold, draw, params, held, data):
    """One model over dense 0/1 columns: (base, trees, errors)."""
    size, width = x.shape
    train, scale = fold != held, data.scale
    base = int(np.rint(y[train] * scale).sum()) / int(train.sum()) / scale
    margin, trees, errors = np.full(size, base), [], []
    for t in range(params.rounds):
        rng = random.Random(f"{params.seed}|{held}|{t}")
        a, b = rng.randrange(1, boosting.PRIME), rng.randrange(boosting.PRIME)
        limit = boosting.PRIME if params.subsample >= 1 else int(params.subsample * boosting.PRIME)
        total = width + categories
        digest = [(hashlib.md5(f"{params.seed}|{held}|{t}|{c}".encode()).hexdigest(), c) for c in range(total)]
        drawn = sorted(c for _, c in sorted(digest)[: max(1, int(params.colsample * total))])
        used = train & ((draw * a + b) % boosting.PRIME < limit)
        g = np.rint((margin - y) * scale).astype(np.int64)
        at, nodes, frontier = np.ones(size, int), {}, [1]

        def merit(gradient, rows):
            return (gradient / scale) ** 2 / (rows + params.reg_lambda)

        for level in range(params.max_depth + 1):
            below = []
            for node in frontier:
                own = used & (at == node)
                whole, rows = int(g[own].sum()), int(own.sum())
                nodes[node] = (whole, rows)
                if level == params.max_depth:
                    continue
                best = (boosting.LEAST_GAIN, None, None)
                for c in drawn:
                    if c < width:
                        missing = np.isnan(x[:, c])
                        sides = [missing, *(missing | (x[:, c] < cut) for cut in data.cuts[c])]
                    else:
                        sides = [site != c - width]
                    for left in sides:
                        gl, nl = int(g[own & left].sum()), int((own & left).sum())
                        if 0 < nl < rows:
                            gain = merit(gl, nl) + merit(whole - gl, rows - nl) - merit(whole, rows)
                            if gain > best[0]:
                                best = (gain, c, left)
                if best[1] is not None:
                    at = np.where(at == node, np.where(best[2], 2 * node, 2 * node + 1), at)
                    below += [2 * node, 2 * node + 1]
            frontier = below
        leaves = set(np.unique(at))
        value = {
            k: params.learning_rate * (-(whole / scale) / (rows + params.reg_lambda)) if k in leaves and rows else 0.0
            for k, (whole, rows) in nodes.items()
        }
        margin = margin + np.array([value[k] for k in at])
        trees.append({k: (*nodes[k], value[k]) for k in nodes})
        off = (margin - y)[fold == held]
        errors.append(int(np.rint(off * off * data.square_scale).sum()) / data.square_scale / len(off))
        if len(errors) - 1 - errors.index(min(errors)) >= params.patience:
            break
    return base, trees, errors


def planted(size=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=size), rng.integers(0, 7, size).astype(float), rng.random(size) ** 3], 1)
    x[rng.random(size) < 0.05, 0] = np.nan
    site = rng.integers(1, 13, size)
    y = 10 * x[:, 1] + 25 * (site == 3) + rng.normal(size=size)
    return x, site, y


@pytest.fixture(scope="module")
def frame(spark):
    x, site, y = planted()
    rows = [
        (i, int(site[i]), *(None if np.isnan(v) else float(v) for v in x[i]), float(y[i]), i % 3) for i in range(len(y))
    ]
    return spark.createDataFrame(rows, f"id long, s int, a double, b double, c double, `{LABEL}` double, fold int")


@pytest.fixture(scope="module")
def data(frame):
    return boosting.prepare(frame, FEATURES, "s", ["id"], PARAMS.max_bins)


def grown_trees(model):
    return [{n["node"]: (n["g"], n["n"], n["value"]) for n in tree} for tree in model.trees]


@pytest.mark.parametrize("store_every", [10, 2])
@pytest.mark.parametrize("dense", [1 << 20, 0])
def test_trees_equal_brute_force(frame, data, monkeypatch, store_every, dense):
    monkeypatch.setattr(boosting, "STORE_EVERY", store_every)
    monkeypatch.setattr(boosting, "DENSE_CELLS", dense)
    x, site, y = planted()
    text_order = {v: i for i, v in enumerate(sorted(str(s) for s in set(site.tolist())))}
    number = np.array([text_order[str(s)] for s in site])
    draws = frame.orderBy("id").select(F.conv(F.substring(key_digest([F.col("id")]), 9, 7), 16, 10).cast("long"))
    draw = np.array([r[0] for r in draws.collect()])
    for model in boosting.Trainer(data, [(k, PARAMS) for k in range(3)]).fit():
        base, trees, errors = brute_fit(
            x, number, len(text_order), y, np.arange(len(y)) % 3, draw, PARAMS, model.fold, data
        )
        assert model.base == base and model.errors == errors
        kept = boosting.best_round(errors, PARAMS.patience)
        assert grown_trees(model) == trees[:kept]


@pytest.mark.parametrize("parts", [1, 7])
def test_models_do_not_depend_on_partitioning(frame, data, parts):
    other = boosting.prepare(frame.repartition(parts, "b"), FEATURES, "s", ["id"], PARAMS.max_bins)
    assert [c.tolist() for c in other.cuts] == [c.tolist() for c in data.cuts]
    one, two = (boosting.Trainer(d, [(0, PARAMS)]).fit()[0] for d in (data, other))
    assert grown_trees(one) == grown_trees(two)


def test_penalty_shrinks_leaves(data):
    stump = BoostParams(learning_rate=1.0, max_depth=1, rounds=1, reg_lambda=0.0)
    free, held = (
        boosting.Trainer(data, [(None, p)]).fit()[0].trees[0]
        for p in (stump, BoostParams(learning_rate=1.0, max_depth=1, rounds=1, reg_lambda=400.0))
    )
    assert abs(held[1]["value"]) < abs(free[1]["value"]) / 2
    assert free[1]["value"] == -(free[1]["g"] / data.scale) / free[1]["n"]


def test_patience_ends_growing(data):
    """The held-out fold is noise to a model that may not read the telling columns."""
    noise = BoostParams(learning_rate=0.8, max_depth=3, rounds=200, patience=2, colsample=0.05, reg_lambda=0.0)
    trainer = boosting.Trainer(data, [(0, noise)])
    model = trainer.fit()[0]
    assert len(model.errors) == len(model.trees) + noise.patience < 200
    # Every pass is a level of a tree, or the root at which patience ran out.
    assert trainer.passes <= len(model.errors) * noise.max_depth + 1


def test_columns_are_drawn_for_each_tree(data):
    params = BoostParams(learning_rate=0.2, max_depth=4, rounds=12, colsample=0.2)
    model = boosting.Trainer(data, [(None, params)]).fit()[0]
    columns = len(FEATURES) + data.categories
    used = []
    for tree in model.trees:
        width = len(FEATURES)
        used.append({n["feature"] if n["feature"] < width else width + n["cut"] for n in tree if n["feature"] >= 0})
    assert all(len(u) <= max(1, int(0.2 * columns)) for u in used)
    assert len(set().union(*used)) > int(0.2 * columns)


def test_saved_tables_score_like_the_models(spark, frame, data, tmp_path):
    models = boosting.fit_prepared(data, PARAMS, range(3))
    models.save(str(tmp_path / "m"))
    loaded = FoldModels.load(str(tmp_path / "m"))
    assert (loaded.bases, loaded.rounds, loaded.params) == (models.bases, models.rounds, PARAMS)
    unknown = spark.createDataFrame([(1000, 99, None, 3.0, float("nan"), None, None)], frame.schema)
    rows = frame.unionByName(unknown).fillna(0.0, FEATURES)
    plain = boosting.score(rows, loaded, ["id"]).orderBy("id").collect()
    joined = boosting.score_by_joins(rows, loaded, ["id"], ["id"]).orderBy("id").collect()
    assert [r["id"] for r in plain] == [r["id"] for r in joined] == [*range(400), 1000]
    for one, two in zip(plain, joined, strict=True):
        assert one[PREDICTION] == pytest.approx(two[PREDICTION], rel=1e-12)


def test_out_of_fold_errors_are_those_of_training(spark, frame, data):
    grown = boosting.Trainer(data, [(k, PARAMS) for k in range(3)]).fit()
    oof = boosting.out_of_fold(frame, boosting._packed_models(data, grown, PARAMS), ["id"])
    assert oof.count() == 400
    for row in boosting.fold_metrics(oof).collect():
        assert row["mse"] == pytest.approx(min(grown[row["fold"]].errors), rel=1e-6)


def test_many_models_grow_like_single_ones(data):
    sets = [PARAMS, BoostParams(learning_rate=0.1, max_depth=2, rounds=4, reg_lambda=0.5)]
    together = boosting.Trainer(data, [(f, p) for p in sets for f in range(2)]).fit()
    alone = [boosting.Trainer(data, [(f, p)]).fit()[0] for p in sets for f in range(2)]
    assert [grown_trees(m) for m in together] == [grown_trees(m) for m in alone]
    results = boosting.cross_validate(data, sets, range(2))
    assert [[f["rounds"] for f in r] for r in results] == [[len(m.trees) for m in together[i : i + 2]] for i in (0, 2)]
    assert all(f["rmse"] == math.sqrt(f["mse"]) for r in results for f in r)


def test_many_categories_keep_the_plan_small(spark):
    """A 0/1 feature for each of 20,000 sites, in one column and a plan of constant size."""
    few = spark.range(40).selectExpr("id", "cast(id % 20 as int) AS s", f"id % 20 AS `{LABEL}`", "cast(id % 2 as int) AS fold")
    many = spark.range(40_000).selectExpr(
        "id", "cast(id % 20000 as int) AS s", f"CASE WHEN id % 20000 = 777 THEN 1e5 ELSE 1.0 END AS `{LABEL}`", "cast(id DIV 20000 as int) AS fold"
    )
    plans = []
    for rows in (few, many):
        numbered = encoding.with_index(rows, "s", encoding.category_index(rows, "s"), "n")
        plans.append(len(numbered._jdf.queryExecution().optimizedPlan().toString().splitlines()))
    assert plans[0] == plans[1]
    data = boosting.prepare(many.withColumn("x", F.lit(1.0)), ["x"], "s", ["id"])
    assert data.categories == 20_000
    params = BoostParams(learning_rate=1.0, max_depth=1, rounds=1, reg_lambda=0.0)
    model = boosting.fit_prepared(data, params, [0])
    root = model.nodes.where("node = 1").first()
    assert (root["feature"], root["category"]) == ("s", "777")
    scored = boosting.score(many.where("id < 20000"), model, ["id"])
    assert [r["id"] for r in scored.where(f"`{PREDICTION}` > 50000").collect()] == [777]


def test_one_hot_vector(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("z",), (None,), ("10",)], "s string")
    index = encoding.category_index(rows.where("s <> 'z'"), "s")
    got = {r["s"]: r["v"].toArray().tolist() for r in encoding.one_hot_vector(rows, "s", index, "v").collect()}
    assert got == {"10": [1, 0, 0], "a": [0, 1, 0], "b": [0, 0, 1], "z": [0, 0, 0], None: [0, 0, 0]}


def test_defined_cases(spark, frame):
    """Rows without a label or fold are left out; no rows, no features and constants give a bare mean."""
    dirty = frame.unionByName(spark.createDataFrame([(900, 1, 1.0, 1.0, 1.0, None, 0), (901, 1, 1.0, 1.0, 1.0, 5.0, None)], frame.schema))
    assert boosting.prepare(dirty, FEATURES, "s", ["id"]).sums == boosting.prepare(frame, FEATURES, "s", ["id"]).sums
    constant = frame.withColumn("b", F.lit(3.0)).withColumn("a", F.lit(None).cast("double"))
    model = boosting.fit_folds(constant, ["a", "b"], BoostParams(rounds=2), range(3), ["id"])
    assert model.nodes.where("feature IS NOT NULL").count() == 0
    empty = boosting.fit_folds(frame.limit(0), FEATURES, BoostParams(rounds=2), range(3), ["id"], "s")
    assert {r[PREDICTION] for r in boosting.score(frame, empty, ["id"]).collect()} == {0.0}


def test_bins():
    cuts = np.array([1.0, 2.0])
    assert boosting.to_bins(np.array([0.0, 1.0, 1.5, 2.0, np.nan, np.inf]), cuts).tolist() == [1, 2, 2, 3, 0, 3]


def test_cuts_have_about_equal_rows(spark):
    rows = spark.range(100_000).selectExpr("pow(rand(3), 4) AS x", "id % 5 AS d", "CAST('NaN' AS DOUBLE) AS n")
    cuts = boosting.choose_cuts(rows, ["x", "d", "n"], 32)
    assert cuts[1].tolist() == [1, 2, 3, 4] and not len(cuts[2])
    values = np.array([r["x"] for r in rows.select("x").collect()])
    assert len(cuts[0]) <= 31 and set(cuts[0]) <= set(values)
    counts = np.bincount(boosting.to_bins(values, cuts[0]))[1:]
    assert counts.max() < 12_000
