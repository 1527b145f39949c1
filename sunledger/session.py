"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_dirs: dict[str, str] = {}


def build_session(
    app_name: str = "sunledger",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset so that the
    submitting environment decides; AQE then coalesces and splits partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # Streaming state on disk, not on the executors' heap.
        "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
        # Recording the call site of every column expression doubles plan building.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a fresh temporary folder: there
    the driver and the executors are one machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="sunledger-")
    return _local_dirs[app]


#: Folders of the scopes that are open, the innermost last.
_scopes: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())


def new_shared_path(spark: SparkSession, label: str) -> str:
    name = f"{label}-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    return f"{_scopes.get()[-1] if _scopes.get() else shared_dir(spark)}/{name}"


@contextmanager
def table_scope(spark: SparkSession) -> Iterator[None]:
    """Owns the tables written to the shared folder inside it, and deletes them at its end.

    What is to outlive the scope has to be stored elsewhere, or read, before it ends. Scopes
    nest: a phase of a job can free its tables before the next one writes its own. Tables
    written outside any scope stay.
    """
    folder = new_shared_path(spark, "scope")
    token = _scopes.set((*_scopes.get(), folder))
    try:
        yield
    finally:
        _scopes.reset(token)
        # Overwriting the folder deletes all that is in it, on any file system Spark can write.
        spark.range(0).coalesce(1).write.mode("overwrite").parquet(folder)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where later steps must all see the same physical rows (row numbers,
    iterative training) and must not recompute them when an executor is lost.
    """
    spark = df.sparkSession
    path = new_shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
