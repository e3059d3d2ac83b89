"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.common import stored, table, text_blocks
from corvane.llm.words import MULTIPLIER, mixed, word_hashes

BITS = 16


def buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words, of all pairs of words (2^BITS across texts), and where texts begin."""
    words, offsets = word_hashes(texts)
    shift = np.uint64(64 - BITS)
    pairs = np.full(len(words), 1 << BITS, np.int64)
    if len(words) > 1:
        pairs[:-1] = mixed(words[:-1] * np.uint64(MULTIPLIER) + words[1:]) >> shift
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    pairs[last] = 1 << BITS
    return (words >> shift).astype(np.int64), pairs, offsets


def fit(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample: int = 20_000, smoothing: float = 1.0) -> np.ndarray:
    """Log ratio of the target and the raw model for every bucket, and 0 for no bucket.

    The raw model counts all documents.  The target model counts those whose id is in ``target``
    (id), of which a sample of about ``sample`` by a hash is taken where there are more; so these ids
    are a bounded broadcast.
    """
    width = (1 << BITS) + 1
    ids = target.select(F.col(id_col).alias("_target")).filter("_target IS NOT NULL").distinct()
    n = ids.count()
    ids = ids.filter(F.pmod(F.xxhash64("_target"), F.lit(max(n, 1))) < sample)
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(ids), F.col("id") == F.col("_target"), "left")
            .select("text", F.col("_target").isNotNull().alias("target")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch, texts in text_blocks(batches, "text"):
            words, pairs, offsets = buckets(texts)
            chosen = np.repeat(np.array(batch.column("target").to_pylist(), bool), np.diff(offsets))
            for part in (words, pairs):
                raw += np.bincount(part, minlength=width)
                good += np.bincount(part[chosen], minlength=width)
        at = np.flatnonzero(raw[:-1])
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "raw": pa.array(raw[at]),
                                          "good": pa.array(good[at])})

    found = (rows.mapInArrow(count, "bucket int, raw long, good long").groupBy("bucket")
             .agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toArrow())
    counts = np.zeros((2, width - 1))
    at = found.column("bucket").to_numpy()
    counts[0, at], counts[1, at] = found.column("raw").to_numpy(), found.column("good").to_numpy()
    if not counts[1].any():  # no target: no preference
        return np.zeros(width)
    shares = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True)
    return np.append(np.log(shares[1] / shares[0]), 0.0)


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int = 0, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, log_weight, sample_key): the sum of log ratios of a text's n-grams, and that plus Gumbel noise.

    The noise is drawn from a hash of seed, id and text, so a retried task draws the same.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch, texts in text_blocks(batches, "text"):
            words, pairs, offsets = buckets(texts)
            sums = np.zeros(len(texts))
            full = offsets[1:] > offsets[:-1]
            if full.any():
                sums[full] = np.add.reduceat(weights[words] + weights[pairs], offsets[:-1][full])
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "draw": batch.column("draw"),
                                              "log_weight": pa.array(sums)})

    draw = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), draw.alias("draw"))
    # The upper 52 bits as a number strictly between 0 and 1.
    uniform = (F.shiftrightunsigned("draw", 12) + F.lit(0.5)) / float(1 << 52)
    return rows.mapInArrow(run, "id long, draw long, log_weight double").select(
        F.col("id").alias(id_col), "log_weight",
        (F.col("log_weight") - F.log(-F.log(uniform))).alias("sample_key"))


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 1024, few: int = 10_000) -> float | None:
    """The k-th largest value, exactly: histograms of the interval that holds it, ever narrower.

    Every step sends ``bins`` counts to the driver, the last one at most ``few`` values or one value.
    """
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if not 0 < k <= n:
        return None
    while n > few and low < high:
        width = (high - low) / bins
        if low + width == low or high - width == high:
            break
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))
        inside = rows.filter(F.col(column).between(low, high))
        found = sorted(inside.groupBy(place.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"),
                                                            F.max(column).alias("high")).collect(), reverse=True)
        for row in found:
            if k <= row["n"]:
                break
            k -= row["n"]
        low, high, n = row["low"], row["high"], row["n"]
    if low == high:
        return low
    inside = rows.filter(F.col(column).between(low, high)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    for value, n in inside.orderBy(F.desc(column)).toLocalIterator():
        if k <= n:
            return value
        k -= n
    return low


def resample(docs: DataFrame, target: DataFrame, share: float, seed: int = 0, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per document with log_weight, sample_key and kept: the ``share`` with the largest keys.

    Adding Gumbel noise to log weights and taking the top k samples k rows without replacement in
    proportion to their weights.  k is ``share`` of the rows, rounded.  Rows equal in id and text
    have the same key and are kept or not together, so ties at the cut may add rows.  A null or
    empty text has weight 1 (log 0).  Without target documents all weights are 1.  An empty table
    gives no row, other columns are not read.
    """
    rows = stored(weigh(docs, fit(docs, target, id_col, text_col), seed, id_col, text_col), "weights")
    k = round(share * rows.count())
    cut = kth_largest(rows, "sample_key", k)
    kept = F.lit(False) if cut is None else F.col("sample_key") >= F.lit(cut)
    return rows.withColumn("kept", kept)


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled good and not toxic.  Kept: as large a share as is labelled good."""
    labels = table(spark, sf_dir, "labels")
    good = F.coalesce(F.col("quality") == 1, F.lit(False))
    share = labels.agg(F.avg(good.cast("double"))).first()[0] or 0.0
    target = labels.filter(good & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).select("doc_id")
    return resample(table(spark, sf_dir, "documents"), target, share)
