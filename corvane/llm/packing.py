"""Best-fit packing of documents into token sequences, with a bounded number of open bins."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import tokens
from corvane.llm.common import empty_text, lean, stored, table, text_blocks

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
PART = 1 << 18
"""Pieces of open bins that one task of the second pass packs."""
SECOND = 1 << 62
"""Added to the sequence ids of the second pass."""


class Bins:
    """Online best fit.  Open bins lie on stacks by free space; a bitset marks filled stacks.

    A piece goes into the open bin with the least free space that holds it.  Where none does, a bin
    opens; beyond ``most`` open bins the fullest closes.
    """

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.filled = 0  # bit f: some open bin has f free places
        self.open = self.opened = 0
        self.closed: list[int] = []  # full or closed, until the caller takes them

    def place(self, length: int) -> tuple[int, int]:
        """Bin number and offset of a piece."""
        fitting = self.filled >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.opened
            self.opened += 1
        left = free - length
        if left:
            self.stacks[left].append(number)
            self.filled |= 1 << left
            self.open += 1
            if self.open > self.most:
                self.closed.append(self._take((self.filled & -self.filled).bit_length() - 1))
        else:
            self.closed.append(number)
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        stack = self.stacks[free]
        number = stack.pop()
        if not stack:
            self.filled &= ~(1 << free)
        self.open -= 1
        return number


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
         end_id: int = 2, open_bins: int = 2048, tokenizer: str | None = None) -> DataFrame:
    """One row per piece of a document, with its sequence and place there.

    A document's ids are those of its text, then ``end_id``.  Up to ``capacity`` ids stay whole;
    longer ones are cut into pieces of ``capacity``, of which the first takes the remainder.  Every
    task packs the rows of its split, in one pass and with at most ``open_bins`` open bins.  What lies
    in bins that are open at the end of a split is packed again, from the longest piece on, in parts
    of about PART pieces of all splits: so the number of sequences hardly depends on the splits.  Only
    these pieces are shuffled, without their ids.

    A null or empty text is one piece with ``end_id``.  A null id stays null.  Repeated rows are
    packed each.  An empty table gives no row.  Other columns are not read.  ``sequence_id`` is the
    task's partition times 2^40 plus the number of the bin there (in the second pass plus SECOND), so
    a retried task gives the same.
    """
    path = tokenizer or tokens.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        bins = Bins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        held: dict[int, list[tuple]] = {}  # the pieces of open bins
        for batch, texts in text_blocks(batches, "text"):
            flat, begins = encode.encode(texts)
            rows: list[tuple] = []
            for doc, a, b in zip(batch.column("id").to_pylist(), begins[:-1].tolist(), begins[1:].tolist()):
                ids = np.append(flat[a:b], np.uint32(end_id)).astype("<u4")
                start, stop = 0, len(ids) % capacity or capacity
                for piece in range(-(-len(ids) // capacity)):
                    number, offset = bins.place(stop - start)
                    held.setdefault(number, []).append((
                        doc, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes()), base + number, offset))
                    start, stop = stop, stop + capacity
                for number in bins.closed:
                    rows += held.pop(number)
                bins.closed.clear()
            yield _batch(rows)
        yield _batch([(*row[:5], None, None) for of in held.values() for row in of])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(capacity, 4 * PART)
        base = SECOND + (TaskContext.get().partitionId() << 40)
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array([base + n for n, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())], names=batch.schema.names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), empty_text(text_col).alias("text"))
    first = stored(rows.mapInArrow(lean(run), SCHEMA), "packed")
    left = first.filter("sequence_id IS NULL")
    parts = max(1, math.ceil(left.count() / PART))
    second = (left.repartition(parts).sortWithinPartitions(F.desc("length"), "doc_id", "piece", "start", "ids_crc32")
              .mapInArrow(lean(again), SCHEMA))
    return first.filter("sequence_id IS NOT NULL").unionByName(second).withColumnRenamed("doc_id", id_col)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32()] + [pa.int64()] * 5
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                                      names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
