from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from sunledger.functions import numeric, solar, temporal


def values(spark, rows, schema, column):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.select(column).collect()]


def test_rounding_is_half_even_on_the_scaled_double(spark):
    got = values(
        spark,
        [2.675, 0.125, 0.285, 1.005, -0.004, None],
        "x double",
        numeric.rint_round(F.col("x"), 2),
    )
    assert got == [2.68, 0.12, 0.28, 1.0, -0.0, None]


def test_fixed_text(spark):
    got = values(
        spark,
        [1.005, 2.675, 0.125, 0.375, -0.004, 1234.5, None],
        "x double",
        numeric.fixed_text(F.col("x")),
    )
    assert got == ["1.00", "2.67", "0.12", "0.38", "-0.00", "1234.50", None]


def test_fixed_text_keeps_bad_text(spark):
    got = values(spark, ["1.005", "n/a", None], "x string", numeric.fixed_text_or_raw(F.col("x")))
    assert got == ["1.00", "n/a", None]


def test_text_sentinel_is_missing(spark):
    got = values(spark, ["-99.00", "abc", "1", None], "x string", numeric.clean_measure(F.col("x")))
    assert got == [None, None, 1.0, None]


def test_clamp_keeps_null(spark):
    got = values(spark, [-3.2, None, 5.0], "x double", numeric.clamp_zero(F.col("x")))
    assert got == [0.0, None, 5.0]


def test_interaction(spark):
    df = spark.createDataFrame([(1.26, 20.0), (None, 20.0)], "u double, t double")
    got = [r[0] for r in df.select(numeric.interaction(F.col("u"), F.col("t"))).collect()]
    assert got == [26.2, None]


def test_exact_mean_ignores_order(spark):
    rows = [(0.1 * i,) for i in range(1, 500)]
    once = spark.createDataFrame(rows, "x double").repartition(1).agg(numeric.exact_mean(F.col("x"))).first()[0]
    again = (
        spark.createDataFrame(rows[::-1], "x double").repartition(7).agg(numeric.exact_mean(F.col("x"))).first()[0]
    )
    assert once == again == pytest.approx(25.0)


def test_iso_wall_clock_drops_the_offset(spark):
    got = values(
        spark,
        ["2024-01-17T09:30:00+08:00", "2024-01-17T09:30:00Z", "2024-01-17 09:30:00", "", "x", None],
        "s string",
        temporal.iso_wall_clock(F.col("s")),
    )
    assert got == [dt.datetime(2024, 1, 17, 9, 30)] * 3 + [None] * 3


def test_serial_fields(spark):
    serials = ["20240117093001", "20240117093017.0", "", "20243017093001", "202401170930xx", None, "2024011709"]
    df = spark.createDataFrame([(s,) for s in serials], "s string")
    got = df.select(*[c.alias(k) for k, c in temporal.serial_fields(F.col("s")).items()]).collect()
    start = dt.datetime(2024, 1, 17, 9, 30)
    assert [tuple(r) for r in got] == [
        (start, 1),
        (start, 17),
        (None, None),
        (None, 1),
        (start, None),
        (None, None),
        (None, 9),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Taipei"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist on this date in New York.
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:34:56.789012' AS t, '2024/03/10 02:34' AS s")
        got = df.select(
            temporal.epoch_seconds(F.col("t")),
            temporal.floor_minute(F.col("t")),
            temporal.floor_seconds(F.col("t"), 600),
            temporal.slash_datetime(F.col("s")),
            temporal.from_epoch_seconds(temporal.epoch_seconds(F.col("t"))),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[0] == int(dt.datetime(2024, 3, 10, 2, 34, 56, tzinfo=dt.timezone.utc).timestamp())
    assert got[1] == got[3] == dt.datetime(2024, 3, 10, 2, 34)
    assert got[2] == dt.datetime(2024, 3, 10, 2, 30)
    assert got[4] == dt.datetime(2024, 3, 10, 2, 34, 56)


def test_clock_between_includes_both_ends(spark):
    stamps = [dt.datetime(2024, 1, 1, *t) for t in [(4, 59, 59), (5, 0, 0), (19, 0, 0), (19, 0, 0, 1)]]
    got = values(spark, stamps, "t timestamp_ntz", temporal.clock_between(F.col("t"), "05:00", "19:00"))
    assert got == [False, True, True, False]


def test_sun_position_matches_a_published_example(spark):
    # Published worked example of a full ephemeris: azimuth 194.34024, zenith 50.11162.
    df = spark.createDataFrame([(dt.datetime(2003, 10, 17, 12, 30, 30),)], "DateTime timestamp_ntz")
    got = solar.sun_angles(
        df,
        latitude=39.742476,
        longitude=-105.1786,
        utc_offset_hours=-7,
        pressure=820,
        temperature=11,
        altitude=1830.14,
        digits=None,
    ).first()
    assert got["Azimuth"] == pytest.approx(194.34024, abs=0.001)
    assert got["Elevation"] == pytest.approx(90 - 50.11162, abs=0.001)


def test_sun_steps_match_the_published_example():
    """The example's intermediate values, by another engine."""
    place = {
        "utc_offset_h": -7.0,
        "latitude": 39.742476,
        "longitude": -105.1786,
        "pressure": 820.0,
        "temperature": 11.0,
        "altitude": 1830.14,
        "sun_epoch_s": dt.datetime(2003, 10, 17, 12, 30, 30, tzinfo=dt.timezone.utc).timestamp(),
    }
    sql = "SELECT " + ", ".join(f"{v!r}::DOUBLE AS {k}" for k, v in place.items())
    for name, text in solar.STEPS:
        sql = f"SELECT *, {text} AS {name} FROM ({sql})"
    published = {
        "helio_lon": 24.0182616917,
        "helio_lat": -0.0001011219,
        "obliq": 23.440465,
        "ecl_lon": 204.0085519281,
        "right_asc": 202.22741,
        "declin": -9.31434,
        "hour_angle": 11.105902,
        "declin_seen": -9.316179,
        "hour_seen": 11.10629,
    }
    names = [*published, "sun_distance", "nutation_lon"]
    row = dict(zip(names, duckdb.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall()[0], strict=True))
    assert row["sun_distance"] == pytest.approx(0.9965422974, abs=5e-6)
    assert row["nutation_lon"] == pytest.approx(-0.0039984, abs=2e-5)
    for name, want in published.items():
        off = (math.degrees(row[name]) - want + 180) % 360 - 180
        assert abs(off) < 1e-4, name
