"""Domain views over the given tables: events seen as site power, weather and irradiance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.functions.numeric import exact_mean
from sunledger.functions.temporal import datetime_text, floor_seconds
from sunledger.operators.features import LABEL, PREDICTION
from sunledger.session import materialise

HOUR = 3600
QUARTER = 900


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def site() -> F.Column:
    return (F.col("user_id") % 17 + 1).cast("int").alias("LocationCode")


def reading() -> F.Column:
    """The number in ``props``, as text."""
    return F.get_json_object("props", "$.k")


def power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", site(), F.col("ts").alias("DateTime"), F.col("value").alias(LABEL)
    )


def power_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All events as the main source; purchases again, and errors half a minute later, as the extra."""
    main = power(spark, sf_dir)
    later = F.when(F.col("event_type") == "error", F.expr("INTERVAL '30' SECOND")).otherwise(
        F.expr("INTERVAL '0' SECOND")
    )
    extra = (
        events(spark, sf_dir)
        .where(F.col("event_type").isin("purchase", "error"))
        .select(
            "event_id",
            site(),
            (F.col("ts") + later).alias("DateTime"),
            (F.col("value") + 1000.0).alias(LABEL),
        )
    )
    return main, extra


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction per event, partly negative."""
    return events(spark, sf_dir).select(
        "event_id", site(), F.col("ts").alias("DateTime"), (F.col("value") - 60.0).alias(PREDICTION)
    )


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views as weather observations; measures are text with sentinels and bad values."""
    k = reading().try_cast("int")
    uvi = F.when(k % 7 == 0, "-99.00").when(k % 11 == 0, "abc").otherwise(F.col("value").cast("string"))
    temp = F.when(k % 10 == 0, "-99.0").otherwise(k.cast("string"))
    return (
        events(spark, sf_dir)
        .where(F.col("event_type") == "view")
        .select("event_id", F.col("ts").alias("time"), uvi.alias("H_UVI"), temp.alias("TEMP"))
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean purchase value per hour as the station's hourly insolation.

    This and the next two series are stored, as a station's export would be:
    they have at most a row per hour, and the grid operators read them repeatedly.
    """
    series = (
        events(spark, sf_dir)
        .where(F.col("event_type") == "purchase")
        .groupBy(floor_seconds(F.col("ts"), HOUR).alias("DateTime"))
        .agg(exact_mean(F.col("value")).alias("Solarinsolation"))
    )
    return materialise(series, "hourly")


def quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click values per quarter of an hour as clear-sky irradiance."""
    series = (
        events(spark, sf_dir)
        .where(F.col("event_type") == "click")
        .groupBy(floor_seconds(F.col("ts"), QUARTER).alias("DateTime"))
        .agg(
            exact_mean(F.col("value")).alias("GHI"),
            F.max("value").alias("DNI"),
            F.min("value").alias("DHI"),
        )
    )
    return materialise(series, "quarters")


def ten_minute_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click values per present ten minutes; single clicks leave the mean unknown."""
    value = F.col("value")
    series = (
        events(spark, sf_dir)
        .where(F.col("event_type") == "click")
        .groupBy(floor_seconds(F.col("ts"), 600).alias("DateTime"))
        .agg(
            F.when(F.count("*") > 1, exact_mean(value)).alias("mean_value"),
            F.max(value).alias("max_value"),
        )
    )
    return materialise(series, "tens")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slot question per sign-up."""
    serial = F.concat(F.date_format("ts", "yyyyMMddHHmm"), F.lpad(site().cast("string"), 2, "0"))
    return (
        events(spark, sf_dir).where(F.col("event_type") == "signup").select("event_id", serial.alias("serial"))
    )


def mixed_serials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A serial per event, four of five spoilt in different ways."""
    stamp = F.date_format("ts", "yyyyMMddHHmm")
    code = F.lpad(site().cast("string"), 2, "0")
    kind = F.col("event_id") % 5
    serial = (
        F.when(kind == 1, F.concat(stamp, code, F.lit(".0")))
        .when(kind == 2, F.concat(F.date_format("ts", "yyyy"), F.lit("30"), F.date_format("ts", "ddHHmm"), code))
        .when(kind == 3, F.concat(stamp, F.lit("xx")))
        .when(kind == 4, F.lit(" "))
        .otherwise(F.concat(stamp, code))
    )
    return events(spark, sf_dir).select("event_id", serial.alias("serial"))


def weather_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON weather payload per event with a full station and one that lacks its temperature."""
    return weather_payload_text(events(spark, sf_dir))


def weather_payload_text(source: DataFrame) -> DataFrame:
    k = reading().try_cast("int")
    observed = F.struct(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00")).alias("DateTime")
    )
    uvi = F.when(k % 13 == 0, "n/a").otherwise(F.col("value").cast("string"))

    def station(name: str, temperature: F.Column) -> F.Column:
        return F.struct(
            F.concat(F.lit(name), site().cast("string")).alias("StationId"),
            observed.alias("ObsTime"),
            F.struct(uvi.alias("UVIndex"), temperature.alias("AirTemperature")).alias("WeatherElement"),
        )

    both = F.array(station("A", k.cast("string")), station("B", F.lit(None).cast("string")))
    return source.select(F.to_json(F.struct(F.struct(both.alias("Station")).alias("records"))).alias("payload"))


def irradiance_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON irradiance payload per event: its own interval, and one that starts too late.

    Some own intervals lack a value, and some their start.
    """
    k = reading().try_cast("int")

    def interval(start: F.Column, dhi: F.Column) -> F.Column:
        sky = F.struct(F.col("value").alias("ghi"), (F.col("value") * 0.5).alias("dni"), dhi.alias("dhi"))
        return F.struct(start.alias("start"), sky.alias("clear_sky"))

    own = interval(F.when(k % 13 != 5, F.date_format("ts", "HH:mm")), F.when(k % 11 != 0, F.col("value") * 0.25))
    late = interval(F.lit("19:00"), F.col("value"))
    payload = F.struct(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.struct(F.array(own, late).alias("intervals")).alias("irradiance"),
    )
    return events(spark, sf_dir).select(F.to_json(payload).alias("payload"))


def event_time_text(column: str = "DateTime") -> F.Column:
    return datetime_text(F.col(column))
