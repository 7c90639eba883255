"""Tables written once and read again, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_own_folder: str | None = None
#: Paths stored by each open ``working_tables`` block of this thread or task of the event loop, outermost first.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("open_tables", default=())


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only where none is set and all tasks run in this process."""
    global _own_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="quotemill-")
    return _own_folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts lineage so that a lost executor costs a read, not a recomputation, and gives Spark the true
    size of the table: whether a join broadcasts it is then decided by ``autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quotemill/{label}-{uuid.uuid4().hex}"
    if blocks := _open.get():
        blocks[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _drop(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes at its end what ``stored`` wrote within, but for tables that ``kept`` wrote.

    What leaves the block must be read from kept tables alone. A block that fails deletes what it wrote, kept tables
    of its own blocks included. Threads that build queries at once have blocks of their own.
    """
    own: list[str] = []
    token = _open.set((*_open.get(), own))
    try:
        yield own
    finally:
        _open.reset(token)
        for path in own:
            _drop(spark, path)


def sweep(spark: SparkSession, seconds: float) -> int:
    """Deletes tables of the shared folder that were written more than ``seconds`` ago, and counts them.

    Tables that a returned DataFrame reads are kept for as long as someone may read it, and have no owner after that: a
    job that runs this, with an age that no query reaches, is their end.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/quotemill")
    files, gone = root.getFileSystem(conf), 0
    if files.exists(root):
        for status in files.listStatus(root):
            if status.getModificationTime() < (time.time() - seconds) * 1000:
                files.delete(status.getPath(), True)
                gone += 1
    return gone


def kept(df: DataFrame, label: str) -> DataFrame:
    """``stored``, for a table that outlives the innermost ``working_tables`` block; a block around that one owns it."""
    token = _open.set(_open.get()[:-1])
    try:
        return stored(df, label)
    finally:
        _open.reset(token)
