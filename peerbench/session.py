"""Session defaults and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where the split costs the next step one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(app: str = "peerbench", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, ANSI casts and UTC; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    shared_dir(session)  # asked for now rather than in the middle of a query
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or the checkpoint folder of the context.

    Only a session of this machine may go without; its folder is removed when Python ends. A cluster that
    names none is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="peerbench-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
        named = spark.sparkContext.getCheckpointDir()
    return named


@contextmanager
def setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


#: Rows that the session's partitions may hold before there are more of them, and what is put together again at most.
TASK_ROWS = 500_000
TASK_BYTES = "8m"


@contextmanager
def sized(spark: SparkSession, rows: int) -> Iterator[None]:
    """Shuffles of a block in so many partitions that the memory of a task does not grow with the rows.

    Sorts and hash tables take many times the bytes of a shuffle, so the usual 64 MB are too much for one task.
    """
    if rows <= TASK_ROWS:
        yield
        return
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    with setting(spark, "spark.sql.shuffle.partitions", partitions), \
            setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES):
        yield


def fresh_path(spark: SparkSession, label: str) -> str:
    """An unused path in the shared folder, below a subfolder of this application."""
    return f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/peerbench-{spark.sparkContext.applicationId}"


def remove_stored(spark: SparkSession) -> None:
    """Delete the stored tables of this application; call it when its results have been written."""
    delete_path(spark, _own_dir(spark))


def _located(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of this name, on whatever file system it names."""
    system, found = _located(spark, path)
    return system.exists(found)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds, if there is one."""
    system, found = _located(spark, path)
    system.delete(found, True)


def together(spark: SparkSession, *jobs: Callable[[], T]) -> list[T]:
    """Results of independent jobs that are submitted side by side (at most eight at a time)."""
    run = inheritable_thread_target(spark)(lambda job: job())
    with ThreadPool(min(len(jobs), 8)) as pool:
        return pool.map(run, jobs, chunksize=1)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage without relying on executor-local blocks, and gives the planner real file
    sizes, so that a small result is broadcast only when its bytes are known to fit.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
