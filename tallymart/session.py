"""Session helpers: a local session for tests and the folder shared by all executors."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A ``local[n]`` session for tests and benchmarks, with a folder for stages of its own.

    Clusters bring their own session and name a shared folder in ``spark.checkpoint.dir``.
    """
    stages = tempfile.mkdtemp(prefix="tallymart-")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallymart")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", stages)
        .config("spark.sql.warehouse.dir", f"{stages}/warehouse")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A local session that names none gets a folder for the process, named in the session from then on.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tallymart-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_scopes: list[list[Callable[[], object]]] = []


def on_release(action: Callable[[], object]) -> None:
    """Run ``action`` when the innermost ``scratch`` block ends; without one the caller keeps what it made."""
    if _scopes:
        _scopes[-1].append(action)


@contextmanager
def scratch() -> Iterator[None]:
    """Stored stages and catalog tables made inside the block are deleted at its end.

    Use results inside the block: a DataFrame that reads a stage cannot be read after it.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for action in reversed(_scopes.pop()):
            action()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system; nothing happens if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; two callers never get the same one."""
    path = f"{shared_dir(spark)}/tallymart/{name}-{uuid.uuid4().hex}"
    on_release(lambda: delete_path(spark, path))
    return path


def stable(df: DataFrame) -> DataFrame:
    """Write the rows to a table in the shared folder and read them from there.

    Cuts the lineage: later passes see the same rows, do not repeat the work behind them, survive
    lost executors, and read only the columns they need. The table stays until the ``scratch`` block around
    the caller ends, or else until the folder is cleared.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_parallel(spark: SparkSession, work: Callable[[int], Result], times: int, threads: int = 8) -> list[Result]:
    """Results of ``work(0..times-1)``, a few fits at a time, so that short jobs of one fit do not idle the cluster."""
    run = inheritable_thread_target(spark)(work)
    with ThreadPool(min(threads, times)) as pool:
        return pool.map(run, range(times))
