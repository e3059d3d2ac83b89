"""Running numbers over sorted rows whose groups may be larger than a task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import stored


def _numbered(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[pa.RecordBatch]:
    """Adds ``_pos``, the place of a row among the rows of its group in this task."""
    current, at = None, 0
    for batch in batches:
        places = []
        for value in batch.column(group).to_pylist():
            at = at + 1 if value == current and at else 1
            current = value
            places.append(at - 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], [*batch.schema.names, "_pos"])


def ranked(rows: DataFrame, group: str, order: list[Column], keep: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``keep`` columns with ``rank`` (from 0) inside ``group`` in the given order, and the group sizes (group, n).

    Rows are cut into ranges of (group, order), so a group of any size is dealt over many tasks; a
    task numbers its stretch as it streams by, and the stretches before it are added as an offset: a
    row for each task and group.  The numbered rows are written once, so a lost executor moves none.
    Rows equal in group and order are interchangeable.  The group must not be null.
    """
    columns = list(dict.fromkeys([group, *keep]))
    cut = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order).select(*columns)
    schema = T.StructType([*cut.schema.fields, T.StructField("_pos", T.LongType())])
    placed = stored(cut.mapInArrow(lambda batches: _numbered(batches, group), schema)
                    .withColumn("_stretch", F.spark_partition_id()), name)
    parts = placed.groupBy(group, "_stretch").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(group, "_stretch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    sizes = parts.groupBy(group).agg(F.sum("_n").alias("n"))
    out = placed.join(starts, [group, "_stretch"]).select(*columns, (F.col("_start") + F.col("_pos")).alias("rank"))
    return out, sizes


CRC_BITS = "list_transform(range(8 * strlen({0})), lambda i: (ord(substr({0}, (i // 8 + 1)::int, 1)) >> (i % 8)::int) & 1)"


def crc32_sql(text: str) -> str:
    """DuckDB expression: unsigned CRC-32 of an ASCII string expression, bit by bit."""
    step = "xor(c >> 1, 3988292384 * (xor(c, b) & 1))"
    bits = CRC_BITS.format(text)
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform({bits}, lambda x: x::bigint)), "
            f"lambda c, b: {step}), 4294967295::bigint)")
