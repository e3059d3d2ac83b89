"""What the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.session import BATCH, BATCH_BYTES, lean, shared_folder, ship_package, small_batches  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the package is sent to the Python workers first."""
    ship_package(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder of the cluster, removed when the session's JVM ends."""
    path = f"{shared_folder(spark).rstrip('/')}/corvane-{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again.

    Later steps then read the same rows after the loss of an executor, and nothing runs twice.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty_text(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_blocks(batches: Iterable[pa.RecordBatch], column: str,
                limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of the batches whose texts hold about ``limit`` bytes, at least one row each."""
    for batch in batches:
        texts = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start), texts.slice(start, i - start).to_pylist()
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start), texts.slice(start).to_pylist()


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows with equal keys.  The partition must be sorted by the keys."""
    current, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if rows and key != current:
                yield current, rows
                rows = []
            current = key
            rows.append(row)
    if rows:
        yield current, rows
