"""Registered queries: each runs operators over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunledger import schemas
from sunledger.catalog import views
from sunledger.catalog.boosting_sql import SQL_BOOST
from sunledger.functions.numeric import (
    clean_measure,
    exact_part,
    fixed_text,
    fixed_text_or_raw,
    rint_round,
)
from sunledger.functions.temporal import (
    as_datetime,
    floor_minute,
    floor_seconds,
    iso_wall_clock,
    seconds_interval,
    slash_text,
)
from sunledger.operators import boosting, folds, joins, quality, search, statistics
from sunledger.operators.features import (
    LABEL,
    PREDICTION,
    SITE_ATTRIBUTES,
    add_calendar,
    align_features,
    fit_categories,
    one_hot,
    site_dimension,
)
from sunledger.operators.grid import dates_spanned, distinct_days, resample_linear, upsample_hold
from sunledger.operators.joins import answer_text, attach_by_time, slot_answer
from sunledger.operators.ordering import add_positions, forward_fill, interpolate_rows
from sunledger.operators.statistics import mean_metrics, regression_metrics
from sunledger.plans import (
    feature_table,
    feedback,
    insolation,
    irradiance,
    questions,
    sun,
    training,
    weather,
)
from sunledger.plans import power as power_plan
from sunledger.session import materialise, new_shared_path
from sunledger.sources import files, payloads, sinks
from sunledger.streaming import weather_feed

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


# --- slots -----------------------------------------------------------------


@register
def slot_mean_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = joins.slot_means_aligned(views.predictions(spark, sf_dir), PREDICTION)
    return means.select("LocationCode", "slot_start", slot_answer(F.col("slot_mean")).alias("answer"))


@register
def slot_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.answer_questions(views.questions(spark, sf_dir), views.predictions(spark, sf_dir))


@register
def interval_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean prediction from each sign-up's own second on, for up to 28 hours."""
    start = F.date_trunc("second", "ts").cast("timestamp_ntz")
    asked = views.events(spark, sf_dir).where(F.col("event_type") == "signup").select(
        "event_id",
        views.site(),
        start.alias("start"),
        (start + seconds_interval(F.col("event_id") * 7919 % 100_000)).alias("end"),
    )
    found = joins.interval_means(asked, views.predictions(spark, sf_dir), PREDICTION)
    return found.withColumn("interval_mean", rint_round(F.col("interval_mean"), 6))


@register
def slot_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.expand_questions(views.mixed_serials(spark, sf_dir))


@register
def serial_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.split_serials(views.mixed_serials(spark, sf_dir))[1]


# --- cleaning --------------------------------------------------------------


@register
def sentinel_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.weather_raw(spark, sf_dir)
    return raw.select(
        "event_id", clean_measure(F.col("H_UVI")).alias("H_UVI"), clean_measure(F.col("TEMP")).alias("TEMP")
    )


@register
def text_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.weather_raw(spark, sf_dir)
    iso = F.concat(F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00"))
    return raw.select(
        "event_id",
        fixed_text_or_raw(F.col("H_UVI")).alias("uvi_text"),
        fixed_text(F.col("event_id") / 8.0).alias("eighths_text"),
        slash_text(F.col("time")).alias("slash_text"),
        iso_wall_clock(iso).alias("wall_clock"),
        rint_round(F.col("event_id") / 8.0, 2).alias("eighths"),
    )


@register
def combine_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    main, extra = views.power_sources(spark, sf_dir)
    return power_plan.combine_power(main, extra, tie=["event_id"])


@register
def dedup_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return power_plan.dedup_minutes(views.power(spark, sf_dir), tie=["event_id"])


@register
def clean_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    main, extra = views.power_sources(spark, sf_dir)
    return power_plan.clean_power(main, extra, tie=["event_id"])


@register
def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return power_plan.minute_duplicates(views.power(spark, sf_dir))


@register
def station_start_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.start_cutoff(views.power(spark, sf_dir), feature_table.VALID_FROM)


@register
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.weather_raw(spark, sf_dir)
    cleaned = raw.withColumns({c: clean_measure(F.col(c)) for c in weather.MEASURES})
    return quality.null_counts(cleaned, ["time", *weather.MEASURES])


# --- series and grids ------------------------------------------------------


@register
def interpolate_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.weather_raw(spark, sf_dir)
    cleaned = raw.withColumns({c: clean_measure(F.col(c)) for c in weather.MEASURES})
    filled = interpolate_rows(cleaned, weather.MEASURES, ["time", "event_id"])
    return filled.withColumns({c: rint_round(F.col(c), 2) for c in weather.MEASURES})


@register
def resample_10min_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = resample_linear(views.hourly(spark, sf_dir), ["Solarinsolation"])
    return grid.withColumn("Solarinsolation", rint_round(F.col("Solarinsolation"), 2))


@register
def reindex_10min_daylight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return irradiance.irradiance_ten_minutes(views.quarters(spark, sf_dir))


@register
def upsample_1min_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ["mean_value", "max_value"]
    grid = resample_linear(views.ten_minute_series(spark, sf_dir), values, step=60)
    return grid.withColumns({c: rint_round(F.col(c), 2) for c in values})


@register
def upsample_1min_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsample_hold(views.ten_minute_series(spark, sf_dir), ["mean_value", "max_value"])


@register
def complete_day_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = insolation.filter_station_hours(views.hourly(spark, sf_dir))
    return insolation.station_hours_text(complete)


def _insolation_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = insolation.filter_station_hours(views.hourly(spark, sf_dir))
    return insolation.insolation_minutes(insolation.insolation_ten_minutes(complete))


def _irradiance_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ten = irradiance.irradiance_ten_minutes(views.quarters(spark, sf_dir))
    return irradiance.irradiance_minutes(ten)


def _sun_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sun.sun_table(distinct_days(views.power(spark, sf_dir)))


def _minute_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.power(spark, sf_dir).withColumn("DateTime", floor_minute(F.col("DateTime")))


@register
def backfill_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates_spanned(views.power(spark, sf_dir))


@register
def site_time_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.power(spark, sf_dir).withColumn("site", F.col("LocationCode").cast("string"))
    return add_positions(rows, ["site", "DateTime", "event_id"]).select("event_id", "site", "position")


@register
def forward_fill_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = views.reading().try_cast("double")
    rows = views.events(spark, sf_dir).select(
        "event_id",
        views.site(),
        F.col("ts").alias("DateTime"),
        F.when(k % 10 < 2, k).alias("TEMP"),
        F.when(k % 50 == 7, F.col("value")).alias("H_UVI"),
    )
    return forward_fill(rows, ["TEMP", "H_UVI"], ["DateTime", "event_id"], by=["LocationCode"])


@register
def insolation_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _insolation_minutes(spark, sf_dir)


@register
def irradiance_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _irradiance_minutes(spark, sf_dir)


@register
def sun_position_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sun_table(spark, sf_dir)


# --- joins -----------------------------------------------------------------


def _clean_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.weather_raw(spark, sf_dir)
    return raw.withColumns({c: clean_measure(F.col(c)) for c in weather.MEASURES})


@register
def asof_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.asof_join(
        views.power(spark, sf_dir),
        _clean_weather(spark, sf_dir),
        "DateTime",
        "time",
        weather.MEASURES,
        weather.TOLERANCE_SECONDS,
        sequence="event_id",
    )


@register
def asof_weather_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = views.events(spark, sf_dir).where(F.col("event_type") == "view").select(
        "event_id", views.site(), F.col("ts").alias("time"), F.col("value").alias("H_UVI")
    )
    return joins.asof_join(
        views.power(spark, sf_dir),
        stations,
        "DateTime",
        "time",
        ["H_UVI"],
        3600,
        by=["LocationCode"],
        sequence="event_id",
    )


@register
def weather_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.add_weather(
        views.power(spark, sf_dir),
        _clean_weather(spark, sf_dir),
        order=["DateTime", "event_id"],
        sequence="event_id",
    )


@register
def unmatched_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = weather.match_weather(
        views.power(spark, sf_dir), _clean_weather(spark, sf_dir), sequence="event_id"
    )
    return weather.unmatched_weather(matched)


@register
def join_sun_angle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sun.add_sun_angles(_minute_power(spark, sf_dir), _sun_table(spark, sf_dir))


@register
def join_insolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attach_by_time(_minute_power(spark, sf_dir), _insolation_minutes(spark, sf_dir), ["Solarinsolation"])


@register
def join_irradiance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return irradiance.add_irradiance(_minute_power(spark, sf_dir), _irradiance_minutes(spark, sf_dir))


def _insolation_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = attach_by_time(_minute_power(spark, sf_dir), _sun_table(spark, sf_dir), sun.ANGLES)
    return insolation.add_insolation(rows, _insolation_minutes(spark, sf_dir))


@register
def accept_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _insolation_split(spark, sf_dir)[0]


@register
def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reject_records(_insolation_split(spark, sf_dir)[1], ["LocationCode", "DateTime"], "DateTime")


def _partial_sites(spark: SparkSession) -> DataFrame:
    """The site dimension without two sites, so that the default is seen."""
    return site_dimension(spark, {k: v for k, v in SITE_ATTRIBUTES.items() if k not in (5, 11)})


@register
def site_lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_table.add_site_attributes(views.power(spark, sf_dir), _partial_sites(spark))


@register
def unmapped_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_table.unmapped_sites(views.power(spark, sf_dir), _partial_sites(spark))


# --- features and statistics -----------------------------------------------


@register
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_calendar(views.power(spark, sf_dir))


@register
def onehot_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two sites count as unseen: their rows have zeros only.
    known = sorted(str(site) for site in SITE_ATTRIBUTES if site not in (5, 11))
    return one_hot(views.power(spark, sf_dir), known).drop("DateTime", LABEL)


@register
def site_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = fit_categories(views.power(spark, sf_dir))
    return spark.createDataFrame(list(enumerate(known)), "slot int, site string")


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power with calendar parts, site one-hot and measures with nulls, one of them constant."""
    k = views.reading().try_cast("double")
    rows = views.events(spark, sf_dir).select(
        "event_id",
        views.site(),
        F.col("ts").alias("DateTime"),
        F.col("value").alias(LABEL),
        F.when(k % 10 != 0, k).alias("TEMP"),
        F.lit(1.0).alias("constant"),
    )
    return one_hot(add_calendar(rows), sorted(map(str, SITE_ATTRIBUTES)))


@register
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _measures(spark, sf_dir)
    hot = [c for c in rows.columns if c.startswith("LocationCode_")]
    columns = ["TEMP", "constant", "Hour", "Minute", "Month", *hot, LABEL]
    return statistics.correlation_matrix(rows, columns)


@register
def feature_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["Minute", "TEMP", "GHI", "LocationCode_1", "LocationCode_99"]
    return align_features(_measures(spark, sf_dir), wanted, keep=["event_id"])


@register
def fold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.assign_folds(views.power(spark, sf_dir), ["event_id"]).select("event_id", "fold")


@register
def fold_assign_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.assign_day_folds(views.power(spark, sf_dir)).select("event_id", "fold")


@register
def fold_assign_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.assign_balanced_folds(views.power(spark, sf_dir).select("event_id"), ["event_id"])


def _left_out_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row with the mean power of its site and hour over the other folds."""
    rows = folds.assign_folds(views.power(spark, sf_dir), ["event_id"]).withColumn("Hour", F.hour("DateTime"))
    group = ["LocationCode", "Hour"]
    # The events' values have two decimals, so nothing is left of them.
    exact = F.sum(exact_part(F.col(LABEL)))
    sums = rows.groupBy(*group, "fold").agg(exact.alias("s"), F.count("*").alias("n"))
    cell = Window.partitionBy(*group)
    means = sums.select(
        *group,
        "fold",
        F.try_divide(
            (F.sum("s").over(cell) - F.col("s")).cast("double"),
            (F.sum("n").over(cell) - F.col("n")).cast("double"),
        ).alias(PREDICTION),
    )
    return rows.join(means, [*group, "fold"])


_METRICS = ("rmse", "mse", "mae", "r2")


@register
def fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = regression_metrics(_left_out_means(spark, sf_dir), LABEL, PREDICTION, by=["fold"])
    return table.withColumns({c: rint_round(F.col(c), 4) for c in _METRICS})


@register
def cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = mean_metrics(regression_metrics(_left_out_means(spark, sf_dir), LABEL, PREDICTION, by=["fold"]))
    return table.withColumns({c: rint_round(F.col(c), 4) for c in _METRICS})


@register
def ensemble_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.power(spark, sf_dir).withColumns(
        {"p1": F.col(LABEL) * 0.9, "p2": F.col(LABEL) + 5.0, "p3": F.hour("DateTime") * 3.5}
    )
    scored = boosting.ensemble_mean(rows, ["p1", "p2", "p3"])
    return scored.select("event_id", rint_round(F.col(PREDICTION), 6).alias("prediction"))


def _serving_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Minute rows without a label for views, and a prediction for most of them."""
    minutes = power_plan.dedup_minutes(views.power(spark, sf_dir), tie=["event_id"])
    serving = minutes.withColumn(LABEL, F.when(F.col(LABEL) >= 100.0, F.col(LABEL)))
    scored = minutes.where(F.minute("DateTime") != 7).select(
        "LocationCode", "DateTime", (F.col(LABEL) - 60.0).alias(PREDICTION)
    )
    return serving, scored


@register
def pseudo_label_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feedback.merge_predictions(*_serving_rows(spark, sf_dir))


@register
def pseudo_label_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    serving, scored = _serving_rows(spark, sf_dir)
    return feedback.pseudo_label(views.power(spark, sf_dir), serving, scored)


# --- payloads, sinks and the live feed -------------------------------------


@register
def weather_json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = views.weather_payloads(spark, sf_dir)
    parsed = text.select(F.from_json("payload", schemas.WEATHER_PAYLOAD).alias("p")).select("p.*")
    return payloads.flatten_weather(parsed)


def _irradiance_intervals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    text = views.irradiance_payloads(spark, sf_dir)
    parsed = text.select(F.from_json("payload", schemas.IRRADIANCE_PAYLOAD).alias("p")).select("p.*")
    return payloads.flatten_irradiance(parsed)


@register
def irradiance_json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _irradiance_intervals(spark, sf_dir)[0]


@register
def irradiance_json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _irradiance_intervals(spark, sf_dir)[1]


@register
def csv_sink_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "csv")
    sinks.write_csv(views.power(spark, sf_dir), path, decimals={LABEL: 1})
    schema = f"event_id bigint, LocationCode int, DateTime timestamp_ntz, `{LABEL}` double"
    return files.read_csv(spark, path, schema)


@register
def station_line_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station export with spoilt lines, read back: what became of every line."""
    path = new_shared_path(spark, "station")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:00:00")
    value = fixed_text(F.col("value"))
    kind = F.col("event_id") % 10
    line = (
        F.when(kind == 3, F.concat_ws(",", stamp, value, F.lit("note"), F.lit("one more")))
        .when(kind == 4, stamp)
        .when(kind == 5, F.concat_ws(",", F.lit("soon"), value, F.lit("")))
        .otherwise(F.concat_ws(",", stamp, value, F.lit("note")))
    )
    views.events(spark, sf_dir).select(line.alias("value")).write.text(path)
    lines = files.read_station_lines(spark, path, columns=["DateTime", "Solarinsolation", "Note"])
    return insolation.line_accounting(
        insolation.judge_station_hours(lines, "2024-01-05 00:00:00", "2024-01-25 23:59:59")
    )


@register
def question_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions as a file with the asked-for header, read back with the serial as text."""
    path = new_shared_path(spark, "questions")
    asked = views.questions(spark, sf_dir).select(
        F.col("serial").alias(schemas.SERIAL), F.lit(None).cast("string").alias(schemas.ANSWER)
    )
    sinks.write_csv(asked, path)
    return files.read_questions(spark, path)


@register
def slash_series_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The station's stored hours, read back from their slashed timestamps."""
    path = new_shared_path(spark, "slashes")
    sinks.write_csv(complete_day_grid(spark, sf_dir), path)
    return files.read_slash_series(spark, path)


@register
def timestamp_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps as text in five forms, two of them unusable; unusable ones are dropped."""
    kind = F.col("event_id") % 5
    text = (
        F.when(kind == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 2, F.concat(F.lit("  "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" ")))
        .when(kind == 3, F.date_format("ts", "yyyy-31-dd HH:mm:ss"))
        .when(kind == 4, F.lit("soon"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    read = views.events(spark, sf_dir).select("event_id", as_datetime(text).alias("DateTime"))
    return read.dropna(subset=["DateTime"])


@register
def conditional_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor columns are dropped where the table has them; absent ones are no error."""
    rows = views.power(spark, sf_dir).withColumn("Humidity(%)", F.lit(50.0))
    return quality.drop_if_present(rows, schemas.STATION_SENSORS)


@register
def station_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several station rows for one hour the first stays; days are then completed."""
    rows = views.events(spark, sf_dir).where(F.col("event_type") == "purchase").select(
        "event_id", floor_seconds(F.col("ts"), views.HOUR).alias("DateTime"), F.col("value").alias("Solarinsolation")
    )
    return insolation.filter_station_hours(rows, order=["event_id"])


@register
def site_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site files with two kinds of header, written and read back as one table."""
    path = new_shared_path(spark, "site-files")
    rows = views.power(spark, sf_dir)
    even = F.col("LocationCode") % 2 == 0
    sinks.write_csv(rows.where(even).select(LABEL, "DateTime", "LocationCode", "event_id"), path)
    dry = rows.where(~even).withColumn("Humidity(%)", F.col("event_id") / 4)
    sinks.write_csv(dry.select("event_id", "LocationCode", "Humidity(%)", "DateTime", LABEL), path, mode="append")
    read = files.read_site_files(spark, f"{path}/*.csv", pattern=r"^part-(\d+)")
    return read.select(F.col("event_id").cast("long").alias("event_id"), "LocationCode", "DateTime", LABEL, "Humidity(%)")


@register
def site_partition_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "sites")
    sinks.write_by_site(views.power(spark, sf_dir), path)
    return spark.read.parquet(path)


@register
def reject_json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "rejects")
    sinks.write_rejects(_insolation_split(spark, sf_dir)[1], path)
    return spark.read.schema("LocationCode int, DateTime string").json(path)


@register
def feed_dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = (
        # The pattern lets the table be one file as well as a folder of files.
        spark.readStream.schema(source.schema)
        .parquet(f"{sf_dir}/event[s].parquet")
        # One event in fifty comes without a time.
        .withColumn("ts", F.when(F.col("event_id") % 50 != 7, floor_minute(F.col("ts"))))
    )
    parsed = views.weather_payload_text(stream).select(
        F.from_json("payload", schemas.WEATHER_PAYLOAD).alias("p")
    )
    rows = weather_feed.all_observations(parsed.select("p.*"))
    sink, checkpoint, rejects = (new_shared_path(spark, f"feed{x}") for x in ("", "-state", "-rejects"))
    weather_feed.start_feed(rows, sink, rejects, checkpoint, available_now=True).awaitTermination()
    time = F.col("time").cast("timestamp_ntz").alias("time")
    accepted = spark.read.schema(rows.schema).parquet(sink).select("StationId", time, F.lit("accepted").alias("outcome"))
    rejected = spark.read.parquet(rejects).select("StationId", time, F.col("reason").alias("outcome"))
    return accepted.unionByName(rejected)


# --- the whole feature build, training and scoring -------------------------


def _shared_series(
    spark: SparkSession, sf_dir: str, silent_from: str | None = None
) -> feature_table.SharedSeries:
    minutes = _insolation_minutes(spark, sf_dir)
    if silent_from:
        minutes = minutes.where(F.col("DateTime") < F.lit(silent_from).cast("timestamp_ntz"))
    return feature_table.SharedSeries(
        weather=weather.repair_weather(views.weather_raw(spark, sf_dir), ["time", "event_id"]),
        sun=_sun_table(spark, sf_dir),
        insolation_minutes=minutes,
        irradiance_minutes=_irradiance_minutes(spark, sf_dir),
        sites=site_dimension(spark),
    ).stored()


def _features(
    spark: SparkSession, sf_dir: str, silent_from: str | None = None
) -> tuple[DataFrame, DataFrame]:
    main, extra = views.power_sources(spark, sf_dir)
    # The cleaned table is a stage of its own: at most a row per site and minute.
    rows = materialise(power_plan.clean_power(main, extra, tie=["event_id"]), "power")
    return feature_table.build_features(
        rows,
        _shared_series(spark, sf_dir, silent_from),
        weather_sequence="event_id",
        valid_from=feature_table.VALID_FROM,
        one_per_minute=True,
    )


@register
def training_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)[0]


@register
def training_feature_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power rows that have a sun angle but, with a station that fell silent, no insolation."""
    rejected = _features(spark, sf_dir, silent_from="2024-01-20 00:00:00")[1]
    return quality.reject_records(rejected, ["LocationCode", "DateTime"], "DateTime")


@register
def serving_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = questions.expand_questions(views.questions(spark, sf_dir)).drop("serial")
    return feature_table.build_features(
        minutes,
        _shared_series(spark, sf_dir),
        order=["DateTime", "LocationCode", "event_id"],
        weather_sequence="event_id",
        series=(),
    )[0]


#: Up to 900 rounds; patience ends each fold's model.
STOPPED_BOOST = boosting.BoostParams(
    learning_rate=0.3, max_depth=4, subsample=0.9, colsample=0.8, patience=5, max_bins=64, reg_lambda=2.0
)


def _stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(_features(spark, sf_dir)[0], "features")


def _trained(
    spark: SparkSession, sf_dir: str, variant: str, params: boosting.BoostParams
) -> training.TrainingRun:
    matrix, features = training.prepare_matrix(_stored_features(spark, sf_dir), variant)
    return training.train(matrix, features, params)


@register
def gbt_oof_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _trained(spark, sf_dir, "full", SQL_BOOST).fold_metrics
    return table.withColumns({c: rint_round(F.col(c), 4) for c in _METRICS})


@register
def gbt_node_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trees of all folds as a table."""
    nodes = _trained(spark, sf_dir, "full", SQL_BOOST).models.nodes
    return nodes.select(
        "model", "tree", "node", "feature", "cut", "category", rint_round(F.col("value"), 9).alias("value")
    )


@register
def gbt_ensemble_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _trained(spark, sf_dir, "angle", SQL_BOOST)
    scored = training.score_table(serving_feature_table(spark, sf_dir), run.models)
    return scored.withColumn(PREDICTION, rint_round(F.col(PREDICTION), 6))


@register
def gbt_table_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving rows scored by joins with the stored node table, a level per join."""
    run = _trained(spark, sf_dir, "angle", SQL_BOOST)
    path = new_shared_path(spark, "run")
    run.models.save(path)
    rows = add_calendar(serving_feature_table(spark, sf_dir)).withColumn("_row", F.expr("uuid()"))
    filled = materialise(rows, "serving").fillna(0.0, run.models.features)
    scored = boosting.score_by_joins(filled, boosting.FoldModels.load(path), training.KEYS, ["_row"])
    return scored.withColumn(PREDICTION, rint_round(F.col(PREDICTION), 6))


@register
def gbt_early_stopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 900 rounds, ended by patience: rounds kept and metrics of each fold."""
    run = _trained(spark, sf_dir, "full", STOPPED_BOOST)
    kept = spark.createDataFrame(list(run.models.rounds.items()), "fold int, rounds int")
    return run.fold_metrics.join(F.broadcast(kept), "fold")


@register
def gbt_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved run trained again from its stored parameters and folds: rows and rounded metrics."""
    table = _stored_features(spark, sf_dir)
    matrix, features = training.prepare_matrix(table, "base", fold_count=3)
    run = training.train(matrix, features, SQL_BOOST, fold_ids=range(3))
    path = new_shared_path(spark, "run")
    training.save_run(run, path)
    matrix = training.replay_matrix(table, "base", path)
    again = training.replay(table, "base", path, mode="retrain", matrix=matrix).fold_metrics
    scored = training.replay(table, "base", path, mode="rescore", matrix=matrix).fold_metrics
    named = [t.withColumn("mode", F.lit(m)) for t, m in ((again, "retrain"), (scored, "rescore"))]
    return named[0].unionByName(named[1]).withColumns({c: rint_round(F.col(c), 4) for c in _METRICS})


@register
def gbt_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A study of four trials over three folds: (trial, params, fold, metrics, rounds)."""
    matrix, features = training.prepare_matrix(_stored_features(spark, sf_dir), "full", fold_count=3)
    base = boosting.BoostParams(rounds=2, patience=2, max_bins=64)
    study = search.Study(spark, new_shared_path(spark, "trials"), base)
    study.run(matrix, features, training.SITE, training.KEYS, range(3), trials=4, at_once=4)
    return study.fold_table()
