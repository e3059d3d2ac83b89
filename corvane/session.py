"""Session helpers.  A cluster brings its own session; only tests and bench build one."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(name: str, cpus: str | int = "*", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A local session for tests and bench."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config(SPREAD, str(os.cpu_count() if cpus == "*" else cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the session names none (local tests), a fresh temporary folder is set once.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corvane-"))
    return spark.sparkContext.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """``df``, kept in the executors' memory and on their disks once something has read it.

    Several consumers then cost one run.  Nothing runs while a query is built, and what a lost
    executor held is computed again.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is planned and run inside leaves no shuffle files behind; else they stay until the driver collects garbage."""
    before = spark.conf.get(SHUFFLES, None)
    spark.conf.set(SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES, before) if before is not None else spark.conf.unset(SHUFFLES)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder, compressed, and read again: for what is too much to be kept."""
    path = private_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Let the session cut Arrow batches at ``BATCH_BYTES``, unless it cuts smaller ones.

    A batch is held by the JVM, by the worker and, where rows are taken apart, as Python objects; with
    long texts 10,000 rows of it fill an executor.
    """
    now = spark.conf.get(BATCH).lower().removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(BATCH, f"{BATCH_BYTES}b")


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for a worker that lives on after its task: what the task freed goes back to the system."""
    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return task


SPREAD = "spark.corvane.spread"
"""Session setting: over how many tasks ``spread`` deals rows; unset, it leaves them as they are."""


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a small table over all cores for CPU-heavy work, where the session asks for it.

    Test and bench sessions do, since their tables are single files.  On a cluster the setting is unset
    and the splits of the files are the tasks: no rows are moved, whatever the size.
    """
    tasks = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(tasks), *keys) if tasks else df


def private_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder, removed when the session's JVM ends."""
    path = f"{shared_folder(spark).rstrip('/')}/corvane-{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def version(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and time of change of a table's folder or file, by the file system that holds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(target).getLength(), files.getFileStatus(target).getModificationTime()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    The archive is staged next to the driver only; Spark hands it to every executor.
    """
    context = spark.sparkContext
    if getattr(context, "_corvane_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="corvane-"), "corvane"),
                                  "zip", root, "corvane")
    context.addPyFile(archive)
    context._corvane_shipped = True
