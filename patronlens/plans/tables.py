"""Intermediate tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import cache
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_run: ContextVar[str] = ContextVar("run", default="")


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="patronlens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def checkpoint_folder(spark: SparkSession) -> str | None:
    """The shared folder the session names, by option or by ``setCheckpointDir``; a temporary one,
    dropped at exit, only for a local master."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    named = spark.sparkContext._jsc.sc().getCheckpointDir()
    if named.isDefined():
        return named.get()
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_folder()
    return None


def table_path(spark: SparkSession, name: str) -> str | None:
    """A fresh path for a table, or None without a shared folder."""
    folder = checkpoint_folder(spark)
    return None if folder is None else f"{folder.rstrip('/')}/patronlens/{_run.get()}{name}-{uuid.uuid4().hex}"


_freeing: dict[SparkSession, tuple[int, str | None]] = {}
_lock = Lock()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries made inside the block delete their shuffle files as they end.

    Otherwise the files lie on the executors' disks until the driver's garbage happens to be
    collected, those of one stage beside those of the next. Blocks of several threads may overlap.
    """
    with _lock:
        n, before = _freeing.get(spark) or (0, spark.conf.get(CLEANUP, None))
        _freeing[spark] = n + 1, before
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            n, before = _freeing.pop(spark)
            if n > 1:
                _freeing[spark] = n - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table under the checkpoint folder and read it back.

    With ``by``, a folder per value of that column (of few values): a filter on it reads no others.

    Several consumers then share one computation, each reading only its columns; a lost
    executor costs a re-read, not a recomputation; and Spark knows the true size of the table
    when it chooses a join. Without a shared folder there is nowhere to put it: an error. The
    shuffle files behind the table are deleted once it is written.
    """
    spark = df.sparkSession
    path = table_path(spark, name)
    if path is None:
        raise ValueError(f"{name} is staged: set {CHECKPOINT_DIR} to a folder that all executors share")
    with freed_shuffles(spark):
        if by is None:
            df.write.parquet(path)
            return spark.read.schema(df.schema).parquet(path)
        df.hint("rebalance", by).write.partitionBy(by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df``, staged first if shuffles go into it: what is built on it then does not hold their
    files beside its own. A table that is merely read and projected is not copied."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return staged(df, name) if re.search(r"\bExchange (hash|range|RoundRobin)", plan) else df


def dropped(*tables: DataFrame) -> None:
    """Delete staged tables (without ``by``) that nothing reads any more."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def staged_together(frames: dict[str, DataFrame]) -> list[DataFrame]:
    """Stage independent frames at the same time: each fills the executors the others leave idle."""
    with ThreadPoolExecutor(len(frames)) as pool:
        writes = [pool.submit(copy_context().run, staged, df, name) for name, df in frames.items()]
        return [write.result() for write in writes]


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Drop the tables staged inside the block when it ends.

    For jobs that write their results before they return; a DataFrame that still reads a
    staged table must not leave the block unread.
    """
    token = _run.set(f"run-{uuid.uuid4().hex}/")
    folder = checkpoint_folder(spark)
    try:
        yield
    finally:
        if folder is not None:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/patronlens/{_run.get()}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _run.reset(token)
