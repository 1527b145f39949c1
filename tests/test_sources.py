from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sunledger import schemas
from sunledger.operators.features import LABEL
from sunledger.sources import files, payloads, sinks
from sunledger.streaming import weather_feed

DAY = dt.datetime(2024, 1, 1)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_site_files_with_different_columns(spark, tmp_path):
    put(tmp_path / "L1_Train.csv", "﻿LocationCode,DateTime,WindSpeed(m/s),Power(mW)\n1,2024-01-01 00:00:30,0.5,1.25\n")
    put(tmp_path / "L17_Train.csv", "LocationCode,DateTime,Power(mW)\n17,bad,2\n")
    got = files.read_site_files(spark, str(tmp_path / "L*_Train.csv")).orderBy("site_file").collect()
    assert [(r["LocationCode"], r["DateTime"], r["WindSpeed(m/s)"], r[LABEL], r["site_file"]) for r in got] == [
        (1, dt.datetime(2024, 1, 1, 0, 0, 30), 0.5, 1.25, 1),
        (17, None, None, 2.0, 17),
    ]


def test_no_site_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path"):
        files.read_site_files(spark, str(tmp_path / "L*_Train.csv"))


def test_site_files_are_read_in_a_constant_plan(spark, tmp_path):
    """A thousand files with five kinds of header: two scans, and every row by its own header."""
    kinds = [
        ["LocationCode", "DateTime", LABEL],
        [LABEL, "LocationCode", "DateTime"],
        ["LocationCode", "WindSpeed(m/s)", "DateTime", LABEL],
        ["DateTime", "Note", LABEL, "LocationCode"],
        ["LocationCode", "DateTime", "Humidity(%)", "Note", LABEL],
    ]
    for i in range(1000):
        value = {"LocationCode": i, "DateTime": "2024-01-01 00:00:00", LABEL: i / 4, "WindSpeed(m/s)": i, "Humidity(%)": i, "Note": f'"a,{i}"'}
        head = kinds[i % 5]
        lines = [",".join(head), ",".join(str(value[c]) for c in head), "", ",".join(str(value[c]) for c in head)]
        put(tmp_path / f"L{i}_Train.csv", "\r\n".join(lines))
    got = files.read_site_files(spark, str(tmp_path / "L*_Train.csv"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2
    few = files.read_site_files(spark, str(tmp_path / "L1[0-4]_Train.csv"))
    assert len(few._jdf.queryExecution().optimizedPlan().toString().splitlines()) == len(
        got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    )
    rows = got.collect()
    assert len(rows) == 2000
    for r in rows:
        i, head = r["site_file"], kinds[r["site_file"] % 5]
        assert (r["LocationCode"], r[LABEL], r["DateTime"]) == (i, i / 4, DAY)
        assert r["WindSpeed(m/s)"] == (i if "WindSpeed(m/s)" in head else None)
        assert r["Note"] == (f"a,{i}" if "Note" in head else None)


def test_station_lines_are_all_accounted_for(spark, tmp_path):
    from sunledger.plans import insolation

    path = put(
        tmp_path / "station.csv",
        "DateTime,Solarinsolation,Other\n2024-01-01 06:00:00,1.5,a\n2024-01-01 06:00:00,2.5,a\n"
        "2024-01-01 08:00:00,2,c,too,many\nfew\nsoon,3,d\n2023-01-01 09:00:00,,e\n2024-01-01 03:00:00,1,f\n",
    )
    judged = insolation.judge_station_hours(files.read_station_lines(spark, path))
    counted = {r["outcome"]: r["lines"] for r in insolation.line_accounting(judged).collect()}
    assert counted == {"accepted": 1, "repeat": 1, "malformed": 2, "untimed": 1, "outside": 1, "hours": 1}
    assert {r["text"] for r in judged.where("reason = 'malformed'").collect()} == {"2024-01-01 08:00:00,2,c,too,many", "few"}
    none = insolation.line_accounting(judged.limit(0))
    assert sorted(map(tuple, none.collect())) == [("accepted", 0), ("repeat", 0)]


def test_station_export_is_read_tolerantly(spark, tmp_path):
    path = put(
        tmp_path / "station.csv",
        "DateTime,Solarinsolation,Other\n2024-01-01 06:00:00,1.5,a\n2024-01-01 07:00:00, ,b\n"
        "2024-01-01 08:00:00,2,c,too,many\nnonsense,3,d\n2024-01-01 09:00:00,,e\n",
    )
    got = files.read_station_hourly(spark, path).collect()
    assert [(r["DateTime"] and r["DateTime"].hour, r["Solarinsolation"]) for r in got] == [
        (6, 1.5), (7, None), (None, 3.0), (9, None)
    ]


def test_slash_series_weather_and_questions(spark, tmp_path):
    path = put(tmp_path / "s.csv", "DateTime,Solarinsolation\n2024/01/01 06:10,1.50\n2024-01-01 06:20,2\n")
    got = files.read_slash_series(spark, path).collect()
    assert [tuple(r) for r in got] == [(DAY.replace(hour=6, minute=10), 1.5), (None, 2.0)]
    path = put(tmp_path / "w.csv", "time,H_UVI,TEMP\n2024-01-01 00:00:00,-99.00,abc\n")
    assert tuple(files.read_weather(spark, path).first()) == (DAY, "-99.00", "abc")
    path = put(tmp_path / "q.csv", "序號,答案\n20240117093001,\n")
    assert files.read_questions(spark, path).first()["serial"] == "20240117093001"


def test_required_columns(spark):
    with pytest.raises(ValueError, match="DateTime"):
        files.require_columns(spark.range(1), ["id", "DateTime"])


def weather(time, uvi="1.005", temp="20"):
    element = {k: v for k, v in (("UVIndex", uvi), ("AirTemperature", temp)) if v is not None}
    return {"records": {"Station": [{"StationId": "466990", "ObsTime": {"DateTime": time}, "WeatherElement": element}]}}


def test_weather_payload_files(spark, tmp_path):
    put(tmp_path / "a.json", json.dumps(weather("2024-01-01T00:00:00+08:00"), indent=1))
    put(tmp_path / "b.json", json.dumps(weather("2024-01-01T00:10:00+08:00", "n/a", None)))
    put(tmp_path / "c.json", "{broken")
    raw = files.read_payloads(spark, str(tmp_path), schemas.WEATHER_PAYLOAD).cache()
    assert raw.where(F.col(schemas.CORRUPT).isNotNull()).count() == 1
    got = sorted(tuple(r)[1:] for r in payloads.flatten_weather(raw).collect())
    assert got == [(DAY, "1.00", "20.00"), (DAY.replace(minute=10), "n/a", "0.00")]


def test_irradiance_payload_keeps_the_rest_of_the_day(spark, tmp_path):
    def interval(start, **sky):
        return {"start": start, "clear_sky": sky}

    full = {"ghi": 1.0, "dni": 2.0, "dhi": 3.0}
    day = {"date": "2024-01-01", "irradiance": {"intervals": [
        interval("04:45", **full), interval("05:00", **full), interval("05:15", ghi=1.0, dni=2.0),
        interval("18:45", **full), interval("19:00", **full)]}}
    put(tmp_path / "d.json", json.dumps(day))
    good, bad = payloads.flatten_irradiance(files.read_payloads(spark, str(tmp_path), schemas.IRRADIANCE_PAYLOAD))
    assert sorted(r["DateTime"].strftime("%H:%M") for r in good.collect()) == ["05:00", "18:45"]
    assert [r["DateTime"].strftime("%H:%M") for r in bad.collect()] == ["05:15"]


def test_sinks(spark, tmp_path):
    rows = [(s, DAY + dt.timedelta(minutes=i), 1.005 * i) for s in (1, 2) for i in range(20)]
    df = spark.createDataFrame(rows, f"LocationCode int, DateTime timestamp_ntz, `{LABEL}` double")
    sinks.write_csv(df, str(tmp_path / "csv"), decimals={LABEL: 2})
    back = files.read_text_columns(spark, str(tmp_path / "csv"))
    assert back.where("LocationCode = '1' AND DateTime = '2024-01-01 00:01:00'").first()[LABEL] == "1.00"
    sinks.write_by_site(df, str(tmp_path / "sites"))
    assert sorted(p.name for p in (tmp_path / "sites").iterdir() if p.is_dir()) == ["LocationCode=1", "LocationCode=2"]
    one = spark.read.parquet(str(tmp_path / "sites")).where("LocationCode = 2")
    assert one.count() == 20
    assert "PartitionFilters: [isnotnull(LocationCode" in one._jdf.queryExecution().executedPlan().toString()
    sinks.write_rejects(df.where("LocationCode = 2").limit(1), str(tmp_path / "rejects"))
    assert json.loads(next(iter((tmp_path / "rejects").glob("part-*"))).read_text()) == {
        "LocationCode": 2, "DateTime": "2024-01-01 00:00:00"
    }


def test_feed_drops_repeats_and_survives_a_restart(spark, tmp_path):
    inbox, sink, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def poll():
        weather_feed.run_weather_feed(spark, str(inbox), sink, state, available_now=True).awaitTermination()
        return sorted(r["time"].strftime("%H:%M") for r in spark.read.parquet(sink).collect())

    put(inbox / "1.json", json.dumps(weather("2024-01-01T00:00:00+08:00")))
    put(inbox / "2.json", json.dumps(weather("2024-01-01T00:10:00+08:00")))
    put(inbox / "3.json", json.dumps(weather("2024-01-01T00:10:00+08:00", "9")))
    put(inbox / "4.json", "{broken")
    assert poll() == ["00:00", "00:10"]
    put(inbox / "5.json", json.dumps(weather("2024-01-01T00:10:00+08:00")))
    put(inbox / "6.json", json.dumps(weather("2024-01-01T00:05:00+08:00")))
    assert poll() == ["00:00", "00:05", "00:10"]
    put(inbox / "7.json", json.dumps(weather("2024-01-01T02:00:00+08:00")))
    assert poll() == ["00:00", "00:05", "00:10", "02:00"]
    # Later than the watermark allows: dropped, so that state stays bounded.
    put(inbox / "8.json", json.dumps(weather("2024-01-01T00:07:00+08:00")))
    assert poll() == ["00:00", "00:05", "00:10", "02:00"]


def test_feed_rejects_what_it_does_not_accept(spark, tmp_path):
    """Accepted, rejected and repeated rows add up to the input, also when a batch is repeated."""
    inbox, sink, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    at = "2024-01-01T{}:00+08:00"

    def poll(*times):
        for time in times:
            put(inbox / f"{len(list(inbox.glob('*'))) if inbox.exists() else 0}.json", json.dumps(weather(time)))
        weather_feed.run_weather_feed(spark, str(inbox), sink, state, available_now=True).awaitTermination()
        accepted = sorted(r["time"].strftime("%H:%M") for r in spark.read.parquet(sink).collect())
        rejected = spark.read.parquet(f"{sink}_rejects").collect()
        return accepted, sorted((r["reason"], r["time"] and r["time"].strftime("%H:%M")) for r in rejected)

    assert poll(at.format("00:00"), at.format("00:00"), "soon") == (["00:00"], [("untimed", None)])
    poll(at.format("02:00"))
    late = [("late", "00:07"), ("late", "00:08"), ("untimed", None)]
    # The second 00:00 and 02:00 are repeats; the backfill of 00:07 and 00:08 is late.
    want = (["00:00", "02:00"], late)
    assert poll(*[at.format(t) for t in ("00:00", "00:07", "00:08", "02:00")]) == want
    # The last batch again, as after a failure before its commit.
    last = max((p for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert poll() == want


def test_unreadable_payloads_are_kept(spark, tmp_path):
    inbox = tmp_path / "in"
    put(inbox / "1.json", json.dumps(weather("2024-01-01T00:00:00+08:00")))
    put(inbox / "2.json", "{broken")
    put(inbox / "3.json", json.dumps(weather("soon")))
    sink, state = str(tmp_path / "bad"), str(tmp_path / "state")
    weather_feed.run_reject_feed(spark, str(inbox), sink, state, available_now=True).awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(sink).collect()] == [("2.json", "{broken")]
    raw = files.read_payloads(spark, str(inbox), schemas.WEATHER_PAYLOAD)
    assert weather_feed.untimed(raw).count() == 1
