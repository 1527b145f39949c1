"""Copies in files: the first in file order stays; values that are no finite number are missing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from sunledger.functions.numeric import exact_mean, to_number
from sunledger.operators.joins import slot_means
from sunledger.plans.jobs import Workspace
from sunledger.plans.weather import match_weather
from sunledger.sources import files, sinks


def test_first_power_row_of_a_stamp_stays(spark, tmp_path):
    lines = ["LocationCode,DateTime,Power(mW)"]
    for minute in range(50):
        lines += [f"3,2024-02-01 10:{minute:02d}:00,{500 + minute}", f"3,2024-02-01 10:{minute:02d}:00,7"]
    (tmp_path / "L3_Train.csv").write_text("\n".join(lines))
    power = Workspace(spark, str(tmp_path / "ws")).prepare_power(str(tmp_path / "L3_Train.csv"))
    assert sorted(r["Power(mW)"] for r in power.collect()) == [500.0 + m for m in range(50)]
    assert files.FILE_ORDER not in power.columns


def test_first_station_row_of_an_hour_stays_in_any_season(spark, tmp_path):
    (tmp_path / "station.csv").write_text(
        "DateTime,Solarinsolation\n2025-03-01 08:00:00,5.0\n2025-03-01 08:00:00,1.0\n2025-03-01 09:00:00,NaN\n"
    )
    ws = Workspace(spark, str(tmp_path / "ws"))
    ws.prepare_insolation(str(tmp_path / "station.csv"), start="2025-01-01 00:00:00", end="2025-12-31 00:00:00")
    hours = {r.DateTime.hour: r.Solarinsolation for r in ws.table("insolation_hourly").collect()}
    assert hours[8] == 5.0 and hours[9] == 0.0


def test_text_that_is_no_finite_number_is_missing(spark):
    rows = spark.createDataFrame([("NaN",), ("nan",), ("Infinity",), ("-inf",), ("x",), ("-2.5",)], "t string")
    assert [r[0] for r in rows.select(to_number(F.col("t"))).collect()] == [None] * 5 + [-2.5]


def test_slot_mean_counts_what_it_sums(spark):
    at = datetime(2024, 1, 1, 10, 0)
    asked = spark.createDataFrame([(1, at)], "LocationCode int, slot_start timestamp_ntz")
    rows = [(1, at.replace(minute=m), v) for m, v in enumerate([10.0, float("nan"), 30.0])]
    values = spark.createDataFrame(rows, "LocationCode int, DateTime timestamp_ntz, v double")
    assert slot_means(asked, values, "v").collect()[0]["slot_mean"] == 20.0


def test_means_keep_very_small_and_very_large_values(spark):
    asked = spark.createDataFrame([(1, datetime(2024, 1, 1, 10))], "LocationCode int, slot_start timestamp_ntz")
    for values, mean in (([4e-10, 4e-10], 4e-10), ([1e20, 3e20], 2e20), ([0.1, 0.3], 0.2)):
        rows = [(1, datetime(2024, 1, 1, 10, m), v) for m, v in enumerate(values)]
        df = spark.createDataFrame(rows, "LocationCode int, DateTime timestamp_ntz, v double")
        assert slot_means(asked, df, "v").collect()[0]["slot_mean"] == mean
        assert df.agg(exact_mean(F.col("v"))).first()[0] == mean


def test_last_weather_row_of_a_time_is_the_one_that_matches(spark, tmp_path):
    lines = ["time,H_UVI,TEMP", *[f"2024-02-01 10:00:00,1,{t}" for t in (35, 39, 37)]]
    (tmp_path / "weather.csv").write_text("\n".join(lines))
    ws = Workspace(spark, str(tmp_path / "ws"))
    ws.prepare_weather(str(tmp_path / "weather.csv"))
    rows = spark.createDataFrame([(1, datetime(2024, 2, 1, 10, 1))], "LocationCode int, DateTime timestamp_ntz")
    for parts in (1, 3, 8):
        stored = ws.table("weather").repartition(parts)
        assert match_weather(rows, stored, files.FILE_ORDER).first()["TEMP"] == 37.0


def test_csv_keeps_fractions_of_a_second(spark, tmp_path):
    stamps = [datetime(2024, 1, 1, 1, 1, 1, 500000), datetime(2024, 1, 1, 1, 1, 2)]
    df = spark.createDataFrame([(s,) for s in stamps], "t timestamp_ntz")
    sinks.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), "t timestamp_ntz").collect()
    assert sorted(r.t for r in back) == stamps


def test_every_irradiance_interval_and_file_is_accounted_for(spark, tmp_path):
    folder = tmp_path / "irradiance"
    folder.mkdir()
    sky = '"clear_sky": {"ghi": 1.0, "dni": 2.0, "dhi": 3.0}'
    (folder / "a.json").write_text(
        '{"date": "2024-01-01", "irradiance": {"intervals": [{"start": "06:00", %s}, {%s}, {"start": "06:15"}]}}' % (sky, sky)
    )
    (folder / "b.json").write_text("{broken")
    (folder / "c.json").write_text('{"date": "2024-01-01", "irradiance": {"intervals": []}}')
    ws = Workspace(spark, str(tmp_path / "ws"))
    ws.prepare_irradiance(str(folder))
    assert ws.table("irradiance_15min").count() == 1
    assert ws.table("irradiance_rejects").count() == 2
    assert sorted(r.file for r in ws.table("irradiance_unreadable").collect()) == ["b.json", "c.json"]
