"""The polled source, and a feed that reads of its sink only the dates it needs."""

from __future__ import annotations

import datetime as dt
import json
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sunledger.streaming import polling, weather_feed

# Executors cannot import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "StationId string, time timestamp, H_UVI string"


def payload(*times):
    stations = [
        {"StationId": "A", "ObsTime": {"DateTime": t}, "WeatherElement": {"UVIndex": "1", "AirTemperature": "20"}}
        for t in times
    ]
    return json.dumps({"records": {"Station": stations}})


def drive(start, until, seconds=60):
    """Run a feed until its tables satisfy a condition."""
    query = start()
    try:
        end = time.monotonic() + seconds
        while time.monotonic() < end:
            if query.exception() is not None:
                raise query.exception()
            if until():
                return
            time.sleep(0.3)
        raise AssertionError("the feed did not get there in time")
    finally:
        query.stop()
        query.awaitTermination(30)


def count(spark, path):
    """Rows of a table, which may not be there yet or be without files."""
    exists = weather_feed._exists(spark, path)
    return spark.read.schema("StationId string, time timestamp").parquet(path).count() if exists else 0


def test_two_failed_polls_then_success(spark, tmp_path):
    """The service fails twice; both polls are rejects, and the third tick is accepted."""
    asked = tmp_path / "asked"
    asked.mkdir()

    def fetch(tick):
        (asked / str(tick)).touch()
        count = len(list(asked.iterdir()))
        if count <= 2:
            raise ConnectionError(f"attempt {count}")
        return payload(f"2024-01-01T00:{count:02d}:00+08:00")

    sink, state = str(tmp_path / "out"), str(tmp_path / "state")

    drive(
        lambda: polling.run_polled_feed(spark, fetch, sink, state, every=1.0, name="flaky"),
        lambda: count(spark, sink) >= 2 and count(spark, f"{sink}_rejects") >= 2,
    )
    rejected = spark.read.parquet(f"{sink}_rejects").collect()
    assert sorted(r["reason"] for r in rejected) == ["ConnectionError: attempt 1", "ConnectionError: attempt 2"]
    assert all(r["polled_at"] is not None and r["time"] is None for r in rejected)
    accepted = sorted(r["time"] for r in spark.read.parquet(sink).collect())
    assert accepted[0] == dt.datetime(2024, 1, 1, 0, 3) and len(accepted) == len(set(accepted))
    # One poll per tick, and a restart goes on from the checkpoint's tick.
    before, polls = len(accepted), len(list(asked.iterdir()))
    drive(
        lambda: polling.run_polled_feed(spark, fetch, sink, state, every=1.0, name="flaky"),
        lambda: count(spark, sink) > before,
    )
    assert len(list(asked.iterdir())) > polls
    assert count(spark, f"{sink}_rejects") == 2


def test_offsets_and_ticks():
    now = [100.0]
    reader = polling.polled_source("p", lambda tick: f"poll {tick}", 10.0, lambda: now[0])({}).streamReader(None)
    start = reader.initialOffset()
    assert start == {"tick": 9} and reader.latestOffset() == {"tick": 10}
    assert reader.partitions({"tick": 10}, reader.latestOffset()) == []
    now[0] = 155.0
    # Ticks 11 to 14 are past; what the service says now belongs to tick 15.
    parts = reader.partitions({"tick": 10}, reader.latestOffset())
    assert [list(reader.read(p)) for p in parts] == [
        [(15, dt.datetime(1970, 1, 1, 0, 2, 30, tzinfo=dt.timezone.utc), "poll 15", None)]
    ]


@pytest.mark.parametrize("answer", [None, 5, "", "{broken", "{}", '{"records": {"Station": []}}'])
def test_useless_answers_become_rejects(spark, answer):
    reader = polling.polled_source("p", lambda tick: answer)({}).streamReader(None)
    polls = spark.createDataFrame(list(reader.read(polling._Tick(1))), polling.POLL_SCHEMA)
    rows = polling.polled_observations(polls)
    accepted, rejected = weather_feed.split_batch(rows, None, None, ("StationId", "time"))
    assert accepted.count() == 0
    reason = rejected.first()["reason"]
    assert rejected.count() == 1 and (reason == "unreadable" or reason.startswith("TypeError"))


def test_accepted_repeated_and_rejected_add_up(spark):
    day = dt.datetime(2024, 1, 2)
    hour = dt.timedelta(hours=1)
    rows = [
        ("A", day, "2"), ("A", day, "1"), ("A", day, "1"), (None, day, "9"), (None, day, "9"),
        ("B", day - hour, "3"), ("B", day - 2 * hour, "4"), ("B", day - 2 * hour, "5"), ("C", None, "6"),
    ]
    batch = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame([("B", day - hour)], "StationId string, time timestamp")
    accepted, rejected = weather_feed.split_batch(batch, known, day - hour, ("StationId", "time"))
    assert sorted(map(tuple, accepted.collect()), key=str) == [("A", day, "1"), (None, day, "9")]
    assert sorted((r["reason"], r["H_UVI"]) for r in rejected.collect()) == [
        ("late", "4"), ("late", "5"), ("untimed", "6")
    ]
    # Any partitioning accepts the same rows.
    again, _ = weather_feed.split_batch(batch.repartition(5), known, day - hour, ("StationId", "time"))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, accepted.collect()), key=str)


def test_only_the_dates_of_a_batch_are_read(spark, tmp_path):
    """A row of a year ago reads that day of the sink, not the year."""
    sink = str(tmp_path / "sink")
    days = spark.range(400).selectExpr("'A' AS StationId", "TIMESTAMP'2023-01-01' + make_dt_interval(id) AS time", "'1' AS H_UVI")
    days.withColumn("date", F.to_date("time")).repartition("date").write.partitionBy("date").parquet(sink)
    inbox = tmp_path / "in"
    inbox.mkdir()
    late = spark.createDataFrame([("A", dt.datetime(2023, 1, 5), "1"), ("A", dt.datetime(2023, 1, 5, 1), "1")], SCHEMA)
    late.coalesce(1).write.mode("append").parquet(str(inbox / "batch"))
    rows = spark.readStream.schema(SCHEMA).parquet(str(inbox / "batch"))
    read = []
    original = weather_feed.split_batch

    def spy(batch, stored_keys, bound, keys):
        read.append(stored_keys._jdf.queryExecution().executedPlan().toString())
        return original(batch, stored_keys, bound, keys)

    weather_feed.split_batch = spy
    try:
        weather_feed.start_feed(rows, sink, str(tmp_path / "r"), str(tmp_path / "s"), available_now=True).awaitTermination()
    finally:
        weather_feed.split_batch = original
    filters = [line for line in read[0].splitlines() if "PartitionFilters" in line]
    assert len(filters) == 1 and "PartitionFilters: []" not in filters[0] and "= 2023-01-05" in filters[0]
    times = sorted(r["time"] for r in spark.read.parquet(sink).where("date = '2023-01-05'").collect())
    assert times == [dt.datetime(2023, 1, 5), dt.datetime(2023, 1, 5, 1)]
