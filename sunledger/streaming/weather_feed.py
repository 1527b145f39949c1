"""Live weather feed: payload files land in a folder and become deduplicated observations.

Every observation is accepted, a repeat of an accepted one, or rejected with a reason: it
has no usable time, or came later than the watermark and its key was never accepted.

The sink is partitioned by date. A micro-batch reads its source once, and of the sink only the
keys of those dates that its own rows have: today's, and for a row of last year that one day.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from sunledger import schemas
from sunledger.sources import payloads as payload_columns
from sunledger.sources.payloads import flatten_weather

WATERMARK = "30 minutes"
#: The sink's partition column, and the column that says why a row has no time.
DATE = "date"
ERROR = "error"
_MARK = "batch long, high timestamp"
EVERY_MINUTE = "1 minute"


def read_payload_stream(spark: SparkSession, path: str) -> DataFrame:
    """New payload files; a file that is no JSON becomes a row with ``_corrupt_record``."""
    return (
        spark.readStream.schema(f"{schemas.WEATHER_PAYLOAD}, {schemas.CORRUPT} string")
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(path)
    )


def station_columns(stations: DataFrame, *keep: str) -> DataFrame:
    """Flat observations of one station struct ``s`` per row; time is TIMESTAMP or null."""
    flat = payload_columns.station_columns(stations, *keep)
    return flat.withColumn("time", F.col("time").cast("timestamp"))


def all_observations(payloads: DataFrame) -> DataFrame:
    """Flat observations; event time is TIMESTAMP, as watermarks need it, or null."""
    return flatten_weather(payloads).withColumn("time", F.col("time").cast("timestamp"))


def observations(payloads: DataFrame) -> DataFrame:
    """Flat observations with a usable time."""
    return all_observations(payloads).where(F.col("time").isNotNull())


def unreadable(payloads: DataFrame) -> DataFrame:
    """Payload files that are no JSON: (file, text)."""
    # Spark parses, and so finds bad text, only if a data column is used too.
    bad = payloads.where(F.col(schemas.CORRUPT).isNotNull() & F.col("records").isNull())
    return bad.select(F.col("_metadata.file_name").alias("file"), F.col(schemas.CORRUPT).alias("text"))


def untimed(payloads: DataFrame) -> DataFrame:
    """Observations without a usable time."""
    return flatten_weather(payloads).where(F.col("time").isNull())


def dedup_observations(
    stream: DataFrame,
    keys: tuple[str, ...] = ("StationId", "time"),
    time: str = "time",
    watermark: str = WATERMARK,
) -> DataFrame:
    """First arrival per key. State is kept for the watermark's length, then dropped."""
    return stream.withWatermark(time, watermark).dropDuplicatesWithinWatermark(list(keys))


def start_append(
    df: DataFrame, sink: str, checkpoint: str, available_now: bool = False, every: str = EVERY_MINUTE
) -> StreamingQuery:
    """Append to Parquet. The checkpoint lets a failed poll or executor repeat exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start(sink)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _highest(spark: SparkSession, marks: str, number: int):
    """The latest time of all batches before this one."""
    if number == 0:
        return None
    return spark.read.schema(_MARK).parquet(f"{marks}/{(number - 1) % 2}").where(F.col("batch") == number - 1).first()["high"]


def _mark(spark: SparkSession, marks: str, number: int, high) -> None:
    """Kept in turn in two folders, so that a batch that is repeated still finds the one before."""
    row = spark.createDataFrame([(number, high)], _MARK)
    row.coalesce(1).write.mode("overwrite").parquet(f"{marks}/{number % 2}")


def split_batch(batch: DataFrame, stored: DataFrame | None, bound, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of a batch, given the keys in the sink and the watermark.

    Of rows with one key the least by its other columns is accepted, so that a batch that is
    repeated accepts the same. Repeats of accepted rows are in neither table.
    """
    columns = [c for c in batch.columns if c != ERROR]
    error = F.col(ERROR) if ERROR in batch.columns else F.lit(None).cast("string")
    untimed_ = batch.where(F.col("time").isNull()).select(*columns, F.coalesce(error, F.lit("untimed")).alias("reason"))
    timed = batch.where(F.col("time").isNotNull()).select(*columns)
    if stored is not None:
        new = [timed[k].eqNullSafe(stored[k]) for k in keys]
        timed = timed.join(stored, reduce(lambda a, b: a & b, new), "left_anti")
    late = F.lit(False) if bound is None else F.col("time") < F.lit(bound)
    others = [c for c in columns if c not in keys]
    # Copies of a key are merged before the shuffle.
    first = timed.where(~late).groupBy(*keys).agg(F.min(F.struct(*others) if others else F.lit(1)).alias("_first"))
    accepted = first.select(*[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in columns])
    return accepted, timed.where(late).withColumn("reason", F.lit("late")).unionByName(untimed_)


def start_feed(
    rows: DataFrame,
    sink: str,
    rejects: str,
    checkpoint: str,
    available_now: bool = False,
    every: str = EVERY_MINUTE,
    watermark: str = WATERMARK,
    keys: tuple[str, ...] = ("StationId", "time"),
) -> StreamingQuery:
    """Append accepted rows to ``sink``, by date, and the others, with a reason, to ``rejects``.

    A row is late if its time is further behind the latest time of earlier batches than
    ``watermark``. A column ``error`` gives the reason of a row without a time. A batch that is
    repeated after a failure writes nothing twice: the sink's keys leave out what it has
    accepted, and rejects are a folder per batch.
    """
    spark = rows.sparkSession
    if _exists(spark, f"{sink}/_spark_metadata"):
        raise ValueError(f"{sink} was written by a file stream, whose readers see no other files; use a new sink")
    marks = f"{checkpoint.rstrip('/')}-marks"
    kept = [f for f in rows.schema if f.name != ERROR]
    schema = StructType([*kept, StructField(DATE, DateType())])

    def split(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        high = _highest(session, marks, number)
        batch = batch.persist()
        try:
            bound = None
            if high is not None:
                bound = session.range(1).select(F.lit(high) - F.expr(f"INTERVAL {watermark}")).first()[0]
            # A row per date of the batch.
            dates = [r[0] for r in batch.select(F.to_date("time")).where("time IS NOT NULL").distinct().collect()]
            stored = None
            if dates and _exists(session, sink):
                stored = session.read.schema(schema).parquet(sink).where(F.col(DATE).isin(dates)).select(*keys)
            accepted, rejected = split_batch(batch, stored, bound, keys)
            if number == 0 or not rejected.isEmpty():
                rejected.write.mode("overwrite").parquet(f"{rejects}/batch={number}")
            dated = accepted.withColumn(DATE, F.to_date("time"))
            dated.write.mode("append").partitionBy(DATE).parquet(sink)
            newest = batch.agg(F.max("time")).first()[0]
            _mark(session, marks, number, max((t for t in (high, newest) if t is not None), default=None))
        finally:
            batch.unpersist()

    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(split)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def run_weather_feed(
    spark: SparkSession,
    payload_dir: str,
    sink: str,
    checkpoint: str,
    available_now: bool = False,
    watermark: str = WATERMARK,
    rejects: str | None = None,
) -> StreamingQuery:
    """Deduplicated observations. Rows later than ``watermark`` and rows without a usable time
    go to ``rejects`` (the sink's name and ``_rejects`` unless given)."""
    rows = all_observations(read_payload_stream(spark, payload_dir))
    rejects = rejects or f"{sink.rstrip('/')}_rejects"
    return start_feed(rows, sink, rejects, checkpoint, available_now, watermark=watermark)


def run_reject_feed(
    spark: SparkSession, payload_dir: str, sink: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """The unreadable payload files of the same folder, kept for inspection."""
    return start_append(unreadable(read_payload_stream(spark, payload_dir)), sink, checkpoint, available_now)
