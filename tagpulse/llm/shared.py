"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names; a temporary folder only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="llm-")
    return _own["dir"]


def new_folder(spark: SparkSession, name: str) -> str:
    """A name for a folder that all executors share; it goes when the interpreter ends."""
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    atexit.register(remove_folder, spark, path)
    return path


def settle(df: DataFrame, name: str, *, inside: str | None = None) -> DataFrame:
    """Write a table once and read it back: lineage ends, and a lost executor costs no more
    than rereading files. The files go when the interpreter ends, or with the folder
    ``inside``; there, shuffle files of the write go with its end."""
    spark = df.sparkSession
    path = f"{inside}/{name}" if inside else new_folder(spark, name)
    with _shuffles_once(spark) if inside else contextlib.nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _shuffles_once(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the query that made them, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session, or its JVM, may be gone by now
        context = spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def free_names(columns: list[str], *names: str) -> list[str]:
    """The names, or ones like them that no column has, whatever its case."""
    taken, out = {column.lower() for column in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def small(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A few given rows as a table whose size the planner knows."""
    fields = names.split()
    columns = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, fields, strict=True)]) for r in rows])
    return spark.range(1).select(F.inline(columns))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
