"""Exact duplicates against a history of digests held in minimal perfect hash tables."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.common import empty_text, groups, stored, table

BUCKET = 2048
"""Digests in a hash table, on average."""

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """A place for every digest, from other bits and another product on each level."""
    h = (words[:, level % 4] ^ np.uint64(level)) * (_MIX + np.uint64(2 * level))
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return ((h >> np.uint64(33)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Maps n distinct 32-byte digests one to one to 0..n-1; slots keep digest and locator.

    Level by level, keys alone at their place of a bit array of twice their number are settled, the
    others go on to the next level.  A key's number is the rank of its bit.
    """

    def __init__(self, levels: list[np.ndarray], slots: np.ndarray, winners: np.ndarray, counts: np.ndarray):
        self.levels, self.slots, self.winners, self.counts = levels, slots, winners, counts
        sums = [np.cumsum(bits) for bits in levels]
        before = np.cumsum([0] + [int(s[-1]) for s in sums])
        self.ranks = [s - 1 + b for s, b in zip(sums, before)]

    @classmethod
    def build(cls, digests: np.ndarray, winners: np.ndarray, counts: np.ndarray) -> PerfectHash:
        words = digests.view("<u8").reshape(-1, 4)
        levels, rest = [], np.arange(len(words))
        while len(rest):
            size = 2 * len(rest)
            at = _places(words[rest], len(levels), size)
            bits = np.bincount(at, minlength=size) == 1
            levels.append(bits)
            rest = rest[~bits[at]]
        table = cls(levels, digests, winners, counts)
        number = table._numbers(words)
        order = np.argsort(number)
        return cls(levels, digests[order], winners[order], counts[order])

    def _numbers(self, words: np.ndarray) -> np.ndarray:
        """Slot of every digest; -1 for one that no level settles."""
        out = np.full(len(words), -1, np.int64)
        rest = np.arange(len(words))
        for level, bits in enumerate(self.levels):
            at = _places(words[rest], level, len(bits))
            hit = bits[at]
            out[rest[hit]] = self.ranks[level][at[hit]]
            rest = rest[~hit]
            if not len(rest):
                break
        return out

    def lookup(self, digests: np.ndarray) -> np.ndarray:
        """Slot of every digest whose 32 bytes equal those in the slot, else -1."""
        out = self._numbers(digests.view("<u8").reshape(-1, 4))
        member = out >= 0
        member[member] = (self.slots[out[member]] == digests[member]).all(axis=1)
        return np.where(member, out, -1)

    def dump(self) -> bytes:
        file = io.BytesIO()
        np.savez(file, sizes=np.array([len(x) for x in self.levels], np.int64),
                 bits=np.packbits(np.concatenate(self.levels or [np.empty(0, bool)])),
                 slots=self.slots, winners=self.winners, counts=self.counts)
        return file.getvalue()

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        parts = np.load(io.BytesIO(data))
        sizes = parts["sizes"]
        bits = np.unpackbits(parts["bits"], count=int(sizes.sum())).astype(bool)
        return cls(np.split(bits, np.cumsum(sizes)[:-1]), parts["slots"], parts["winners"], parts["counts"])


def text_digest(text: str) -> Column:
    """SHA-256 of the unchanged text in UTF-8, as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(empty_text(text).cast("binary"), 256))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket")


def _totals(rows: DataFrame) -> DataFrame:
    """Per digest the number of rows and the largest id, combined before the shuffle."""
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("winner"))


def build_index(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, blob): a perfect hash table for each bucket of the distinct digests of ``rows``.

    ``rows``: id, digest.  A bucket holds about ``BUCKET`` distinct digests, whatever their copies.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), found in groups(batches, ["bucket"]):
            digests = np.frombuffer(b"".join(r["digest"] for r in found), np.uint8).reshape(-1, 32)
            winners = np.array([_NONE if r["winner"] is None else r["winner"] for r in found], np.int64)
            counts = np.array([r["n"] for r in found], np.int64)
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array([bucket], pa.int64()),
                 "blob": [PerfectHash.build(digests, winners, counts).dump()]})

    keyed = _totals(rows).select(_bucket(buckets), "digest", "n", "winner")
    return (keyed.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(run, "bucket long, blob binary"))


_NONE = -(1 << 63)
"""Stands for a null id in a locator."""


def lookup(index: DataFrame, rows: DataFrame, buckets: int) -> DataFrame:
    """Classes of the new ``rows`` (id, digest): digest, n, winner over history and new rows.

    Members of the history join its slot, after their bytes were compared; the others are classes
    of their own.  Slots that no new row meets come out as they were.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in groups(batches, ["bucket"]):
            new = [r for r in found if r["blob"] is None]
            digests = np.frombuffer(b"".join(r["digest"] for r in new), np.uint8).reshape(-1, 32)
            winners = np.array([_NONE if r["winner"] is None else r["winner"] for r in new], np.int64)
            counts = np.array([r["n"] for r in new], np.int64)
            parts = [(digests, counts, winners)]
            if len(found) > len(new):
                table = PerfectHash.load(next(r["blob"] for r in found if r["blob"] is not None))
                slots = table.lookup(digests)
                member, at = slots >= 0, slots[slots >= 0]
                table.counts[at] += counts[member]
                table.winners[at] = np.maximum(table.winners[at], winners[member])
                parts = [(digests[~member], counts[~member], winners[~member]),
                         (table.slots, table.counts, table.winners)]
            for keys, n, best in parts:
                yield pa.RecordBatch.from_pydict(
                    {"digest": pa.array([k.tobytes() for k in keys], pa.binary()),
                     "n": pa.array(n, pa.int64()),
                     "winner": pa.array(best, pa.int64(), mask=best == _NONE)})

    new = _totals(rows).select(_bucket(buckets), "digest", "n", "winner",
                               F.lit(None).cast("binary").alias("blob"))
    old = index.select("bucket", F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("n"),
                       F.lit(None).cast("long").alias("winner"), "blob")
    return (new.unionByName(old).repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(run, "digest binary, n long, winner long"))


def exact_dedup(docs: DataFrame, historical: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the row that stays of its equal texts, and how many there are.

    ``historical`` marks the rows whose digests are indexed first; the others are looked up.  The
    result does not depend on it.  Equal texts are those with equal SHA-256; the largest id stays,
    and where all ids of a class are null, keep_id is null.  Null text counts as empty.  Rows that
    repeat an id and text are all kept or all dropped.  An empty table gives no row, other columns
    are not read.

    A group of copies is one row before any shuffle by digest.  Only the last join meets its rows
    again, as a plain sort-merge join whose large partitions Spark splits at run time.
    """
    rows = stored(docs.select(F.col(id_col).cast("long").alias("id"), text_digest(text_col).alias("digest"),
                              F.coalesce(historical, F.lit(False)).alias("old")), "digests")
    buckets = rows.count() // BUCKET + 1
    index = stored(build_index(rows.filter("old"), buckets), "perfect-hash")
    classes = lookup(index, rows.filter("NOT old"), buckets)
    return (rows.join(classes.hint("merge"), "digest")
            .select(F.col("id").alias(id_col), F.col("winner").alias("keep_id"), F.col("n").alias("group_size"),
                    F.col("id").eqNullSafe(F.col("winner")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history are the documents that have the older half of the ids, by the mean id."""
    docs = table(spark, sf_dir, "documents")
    middle = docs.agg(F.avg("doc_id")).first()[0]
    return exact_dedup(docs, F.col("doc_id") <= F.lit(middle))


OP8_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
