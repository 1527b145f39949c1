"""The documented run order on a small folder of input files."""

from __future__ import annotations

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from sunledger import session
from sunledger.operators.boosting import BoostParams
from sunledger.operators.features import LABEL, PREDICTION
from sunledger.plans.jobs import Workspace

PARAMS = BoostParams(learning_rate=0.3, max_depth=4, rounds=4, patience=2, max_bins=32)


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    """Two days of two sites whose power follows the time of day."""
    root = tmp_path_factory.mktemp("inputs")
    draw = random.Random(1)

    def power(site, day, minute):
        return round(max(0.0, 300 * math.sin(math.pi * (minute - 360) / 720)) + site + draw.random(), 2)

    for site in (1, 8):
        sensors = ",WindSpeed(m/s),Pressure(hpa),Temperature(°C),Humidity(%),Sunlight(Lux)" if site == 1 else ""
        lines = [f"LocationCode,DateTime{sensors},Power(mW)"]
        for day in (1, 2):
            for minute in range(420, 1020):
                stamp = f"2024-01-0{day} {minute // 60:02d}:{minute % 60:02d}:{draw.randrange(0, 59):02d}"
                middle = ",0,0,0,0,0" if site == 1 else ""
                lines.append(f"{site},{stamp}{middle},{power(site, day, minute)}")
        lines.append(lines[-1])
        (root / f"L{site}_Train.csv").write_text("\n".join(lines), encoding="utf-8")
    (root / "L8_Train_2.csv").write_text("LocationCode,DateTime,Power(mW)\n8,2024-01-03 12:00:00,301\n")
    weather = ["time,H_UVI,TEMP"]
    for day in (1, 2):
        for ten in range(36, 108):
            temp = -99.0 if ten % 7 == 0 else 15 + ten / 20
            weather.append(f"2024-01-0{day} {ten // 6:02d}:{ten % 6}0:00,{max(0, ten - 40) / 10},{temp}")
    (root / "weather.csv").write_text("\n".join(weather))
    for day in (1, 2):
        steps = [{"start": f"{q // 4:02d}:{q % 4 * 15:02d}", "clear_sky": {"ghi": q * 2.0, "dni": q * 1.0, "dhi": 5.0}}
                 for q in range(16, 80)]
        folder = root / "irradiance"
        folder.mkdir(exist_ok=True)
        (folder / f"{day}.json").write_text(json.dumps({"date": f"2024-01-0{day}", "irradiance": {"intervals": steps}}))
    station = ["DateTime,Solarinsolation"] + [f"2024-01-0{d} {h:02d}:00:00,{h / 10}" for d in (1, 2) for h in range(24)]
    (root / "station.csv").write_text("\n".join(station) + "\n2024-01-01 05:00:00,1,2,3\n")
    asked = ["20240102100001", "20240102101008", "20240102030001", "20240102100001", "bad"]
    (root / "questions.csv").write_text("序號,答案\n" + "\n".join(f"{s}," for s in asked), encoding="utf-8")
    return root


def shared_rows(spark, folder):
    """Rows left in the tables of the shared folder."""
    files = [str(f) for f in folder.rglob("*.parquet")]
    return sum(spark.read.parquet(f).count() for f in files)


def test_scopes_delete_what_they_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    before = session.materialise(spark.range(3), "kept")
    with session.table_scope(spark):
        outer = session.materialise(spark.range(5), "outer")
        with session.table_scope(spark):
            inner = session.materialise(spark.range(7), "inner")
            assert inner.count() == 7 and shared_rows(spark, tmp_path) == 15
        assert shared_rows(spark, tmp_path) == 8 and outer.count() == 5
        with pytest.raises(ValueError), session.table_scope(spark):
            session.materialise(spark.range(9), "failed")
            raise ValueError
    assert shared_rows(spark, tmp_path) == 3 and before.count() == 3


def test_whole_run(spark, inputs, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    shared.mkdir()
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(shared))
    whole_run(spark, inputs, tmp_path)
    assert shared_rows(spark, shared) == 0


def whole_run(spark, inputs, tmp_path):
    ws = Workspace(spark, str(tmp_path / "work"))
    power = ws.prepare_power(str(inputs / "L*_Train.csv"), str(inputs / "L*_Train_2.csv"))
    assert power.count() == 2 * 2 * 600 + 1
    ws.prepare_weather(str(inputs / "weather.csv"))
    assert ws.table("weather").where("TEMP IS NULL").count() == 0
    ws.prepare_irradiance(str(inputs / "irradiance"))
    ws.prepare_insolation(str(inputs / "station.csv"))
    assert ws.table("insolation_hourly").count() == 28
    ws.prepare_sun("2024-01-01", "2024-01-03")
    ws.prepare_questions(str(inputs / "questions.csv"))
    assert ws.table("question_rejects").count() == 1

    features = ws.build_training()
    assert features.groupBy("LocationCode").agg(F.min("DateTime").alias("t")).where(
        "LocationCode = 1 AND t < TIMESTAMP_NTZ'2024-01-01 08:00:00'"
    ).count() == 0
    # The third day has no insolation; its row is rejected.
    assert spark.read.json(ws.path("training_rejects")).count() == 1
    serving = ws.build_serving()
    assert serving.count() == 20

    run = ws.train("full", PARAMS, folds=3)
    assert run.cv_metrics.first()["r2"] > 0.8
    again = ws.replay("full")
    assert again.cv_metrics.first()["rmse"] == pytest.approx(run.cv_metrics.first()["rmse"], rel=1e-12)
    assert ws.table("insolation_lines").agg(F.sum("lines")).first()[0] == 49
    assert ws.table("insolation_rejects").where("reason = 'malformed'").count() == 1

    scored = ws.score("full")
    assert scored.count() == 20
    answers = {r["序號"]: r["答案"] for r in ws.answer(str(inputs / "questions.csv")).collect()}
    assert len(answers) == 4
    assert answers["20240102030001"] == answers["bad"] == "N/A"
    assert 100 < float(answers["20240102100001"]) < 400
    ws.score("full", replayed=True)
    replayed = {r["序號"]: r["答案"] for r in ws.answer(str(inputs / "questions.csv"), replayed=True).collect()}
    assert replayed["20240102100001"] == answers["20240102100001"]
    assert replayed["bad"] == "N/A"

    pseudo = ws.add_pseudo_labels("full")
    assert pseudo.where("label_source = 'pseudo'").count() == 20
    assert pseudo.where(F.col(LABEL).isNull()).count() == 0
    second = ws.train("pseudo", PARAMS, folds=3, source="pseudo_features")
    assert second.out_of_fold.where(F.col(PREDICTION).isNull()).count() == 0
