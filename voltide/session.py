"""Session defaults and the shared staging folder."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keyed state with timers needs this store; it also keeps large state out of the heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench, with a temporary folder for staged tables; a cluster brings its own."""
    conf.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="voltide-"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voltide")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_CHOSEN: dict[str, str] = {}


def choose_staging(folder: str) -> None:
    """The folder for staged tables of sessions without ``spark.checkpoint.dir``, for callers that cannot set it."""
    _CHOSEN["root"] = folder


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` of the session, which all executors must see."""
    root = spark.conf.get("spark.checkpoint.dir", None) or _CHOSEN.get("root")
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/voltide"


def staging_path(spark: SparkSession, tag: str) -> str:
    return f"{staging_root(spark)}/{tag}-{uuid.uuid4().hex}"


FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITES, _LOCK = {"open": 0, "before": ""}, threading.Lock()


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of what is run in here when it ends, not when the driver next collects its garbage.

    The session's own setting returns when the last of several threads is done.
    """
    with _LOCK:
        if not _WRITES["open"]:
            _WRITES["before"] = spark.conf.get(FILE_CLEANUP)
        _WRITES["open"] += 1
        spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            _WRITES["open"] -= 1
            if not _WRITES["open"]:
                spark.conf.set(FILE_CLEANUP, _WRITES["before"])


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once as Parquet in the staging folder and read it back.

    Cuts the lineage at a place that outlives executors, freezes values that depend on physical
    partitioning, and lets every consumer prune to the columns it needs. The shuffle files of the write go with it.
    """
    spark = df.sparkSession
    path = staging_path(spark, tag)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
