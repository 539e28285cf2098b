"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"

SETTINGS = {
    # Epoch seconds become calendar hours, days and months in one fixed zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A replayed micro-batch replaces its own partitions of a table, and no other.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Keyed state outgrows the executor heap long before it outgrows a disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "tagpulse", *, kafka: bool = False, **settings: str) -> SparkSession:
    """A session with the settings above; ``kafka`` adds the connector package."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    if kafka:
        builder = builder.config("spark.jars.packages", KAFKA_PACKAGE)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one named in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return configured.rstrip("/")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for the tables of one run of a registered query, removed when the
    interpreter ends. A local session without ``spark.checkpoint.dir``, as in a quick
    trial, gets a temporary one."""
    if spark.conf.get("spark.checkpoint.dir", None) or not spark.sparkContext.master.startswith("local"):
        parent = shared_dir(spark)
    else:
        parent = tempfile.mkdtemp(prefix="tagpulse-")
    path = f"{parent}/tagpulse-{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session, or its JVM, may be gone by now
        remove_folder(spark, path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Of each session, how many are inside :func:`shuffles_once`, and the setting before.
_inside: dict[str, tuple[int, str | None]] = {}
_lock = threading.Lock()


@contextlib.contextmanager
def shuffles_once(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the query that made them, not when the driver collects garbage.
    Jobs that run side by side may share a session."""
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        count, before = _inside.get(session, (0, None))
        if not count:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _inside[session] = count + 1, before
    try:
        yield
    finally:
        with _lock:
            count, before = _inside.pop(session)
            if count > 1:
                _inside[session] = count - 1, before
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)
