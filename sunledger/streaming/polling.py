"""A polled service as a stream: one fetch per tick, and a row for every fetch that fails.

The source is a Spark Python data source whose fetch function is given by the caller. Its
offset is the number of the tick (time divided by the polling interval), kept in the query's
checkpoint. Each trigger polls once, on an executor, if a new tick has begun; ticks that
passed while the query was down cannot be fetched any more and are left out. A fetch that
fails ends neither the task nor the query: it gives a row with the error, and the service
is asked again at the next tick.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from sunledger import schemas
from sunledger.streaming import weather_feed

# Send this module's task code itself: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POLL_SCHEMA = "tick long, polled_at timestamp, payload string, error string"
EVERY_SECONDS = 60.0

#: Asked once per tick, with its number; gives the payload or raises.
Fetch = Callable[[int], str]


class _Tick(InputPartition):
    def __init__(self, tick: int):
        self.tick = tick


class _Polls(DataSourceStreamReader):
    def __init__(self, fetch: Fetch, every: float, clock: Callable[[], float]):
        self.fetch, self.every, self.clock = fetch, every, clock

    def _now(self) -> int:
        return int(self.clock() // self.every)

    def initialOffset(self) -> dict:
        # A new query polls at once.
        return {"tick": self._now() - 1}

    def latestOffset(self) -> dict:
        return {"tick": self._now()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Tick(end["tick"])] if end["tick"] > start["tick"] else []

    def read(self, partition: _Tick) -> Iterator[tuple]:
        at = datetime.fromtimestamp(partition.tick * self.every, timezone.utc)
        try:
            payload = self.fetch(partition.tick)
            if not isinstance(payload, str):
                raise TypeError(f"the service gave {type(payload).__name__}, not text")
            yield partition.tick, at, payload, None
        except Exception as error:  # the next tick asks again
            yield partition.tick, at, None, f"{type(error).__name__}: {error}"


def polled_source(
    name: str, fetch: Fetch, every: float = EVERY_SECONDS, clock: Callable[[], float] = time.time
) -> type[DataSource]:
    """A data source of this name; ``fetch`` and ``clock`` are sent to the executors."""

    class Polled(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return POLL_SCHEMA

        def streamReader(self, schema) -> DataSourceStreamReader:
            return _Polls(fetch, every, clock)

    return Polled


def read_polls(
    spark: SparkSession,
    name: str,
    fetch: Fetch,
    every: float = EVERY_SECONDS,
    clock: Callable[[], float] = time.time,
) -> DataFrame:
    """(tick, polled_at, payload, error): a row per poll."""
    spark.dataSource.register(polled_source(name, fetch, every, clock))
    return spark.readStream.format(name).load()


def polled_observations(polls: DataFrame) -> DataFrame:
    """Observations of all stations, and a row with ``error`` for every poll without any."""
    parsed = polls.withColumn("_payload", F.from_json("payload", schemas.WEATHER_PAYLOAD))
    empty = F.coalesce(F.size("_payload.records.Station"), F.lit(0)) <= 0
    judged = parsed.withColumn("error", F.coalesce("error", F.when(empty, F.lit("unreadable"))))
    stations = F.when(F.col("error").isNull(), F.col("_payload.records.Station"))
    each = judged.select("polled_at", "error", F.explode_outer(stations).alias("s"))
    return weather_feed.station_columns(each, "polled_at", "error")


def run_polled_feed(
    spark: SparkSession,
    fetch: Fetch,
    sink: str,
    checkpoint: str,
    every: float = EVERY_SECONDS,
    name: str = "weather_polls",
    watermark: str = weather_feed.WATERMARK,
    rejects: str | None = None,
    clock: Callable[[], float] = time.time,
) -> StreamingQuery:
    """Poll a service and append its new observations to ``sink``.

    Failed polls, answers without stations, and rows that are late or have no usable time go
    to ``rejects`` with a reason (the sink's name and ``_rejects`` unless given).
    """
    rows = polled_observations(read_polls(spark, name, fetch, every, clock))
    rejects = rejects or f"{sink.rstrip('/')}_rejects"
    return weather_feed.start_feed(rows, sink, rejects, checkpoint, every=f"{every:g} seconds", watermark=watermark)
