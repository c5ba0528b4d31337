"""Session helpers: the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SCOPE: ContextVar[str | None] = ContextVar("scratch folder of the current run", default=None)

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"   # read when a write is planned
_WRITES, _LOCK = {}, threading.Lock()   # writes under way and the setting before the first, by session


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by all executors, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="shelfmark-")
    context.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the scratch root, or below that of the current scope."""
    return f"{_SCOPE.get() or scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate results that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """What this thread stores inside the block lies in one folder, which is deleted at its end.

    Results read from it have to be written or collected before. Scopes nest.
    """
    folder = run_folder(spark, "scope")
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        remove(spark, folder)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside the block leaves no shuffle files behind: its result is read from then on.

    Otherwise they stay until the driver happens to collect its garbage, those of all steps of a
    query together. The setting is what it was again when no write of the session is under way.
    """
    key = spark._jsparkSession.hashCode()
    with _LOCK:
        n, before = _WRITES.get(key) or (0, spark.conf.get(CLEANUP, "false"))
        _WRITES[key] = n + 1, before
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            n, before = _WRITES.pop(key)
            if n > 1:
                _WRITES[key] = n - 1, before
            else:
                spark.conf.set(CLEANUP, before)


def cut_at(df: DataFrame, folder: str) -> DataFrame:
    """Add ``df`` to the Parquet table in ``folder`` and go on from the rows that it has then."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("append").option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def cut(df: DataFrame) -> DataFrame:
    """Store ``df`` as a Parquet table in the shared folder and go on from the stored rows.

    Used where one result feeds several jobs: its input is scanned once, a lost executor
    costs a re-read instead of a recomputation, later steps read only the columns they need,
    and the file sizes tell Spark when a join side is small enough to broadcast.
    """
    return cut_at(df, run_folder(df.sparkSession, "cut"))
