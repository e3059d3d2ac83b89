"""Similarity of a set of query vectors with a large table of vectors: exact top-k, exact threshold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.operators.joins import QUERY_BYTES, checked

BLOCK_ROWS = 512  # vectors of one side that are multiplied at a time
SIM_DIGITS = 6    # similarities are compared at this precision
SALTS = 256
HELD_HITS = 1 << 20  # hits of a task that wait for better ones


def unit(vector: Column) -> Column:
    """Vector of length 1; a zero vector stays as it is."""
    v = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v)


def _blocks(df: DataFrame, id_col: str, vector: str, rows: int) -> DataFrame:
    """n, ids, m: vectors of length 1 packed into matrices of at most ``rows`` rows.  A zero vector
    has no direction, so no cosine with anything, and is left out."""
    named = (df.select(F.col(id_col).alias("id"), unit(F.col(vector)).alias("v"))
             .filter(F.exists("v", lambda x: x != 0)))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), rows):
                part = pdf.iloc[at:at + rows]
                matrix = np.stack(part["v"].to_numpy()).astype("float64")
                yield pd.DataFrame({"n": [len(part)], "ids": [part["id"].to_numpy()], "m": [matrix.tobytes()]})

    return named.mapInPandas(pack, f"n int, ids array<{dict(named.dtypes)['id']}>, m binary")


def similarity_join(vectors: DataFrame, queries: DataFrame, left_id: str, right_id: str, vector: str,
                    k: int | None = None, threshold: float | None = None,
                    block_rows: int = BLOCK_ROWS, query_bytes: int | None = QUERY_BYTES) -> DataFrame:
    """left_id, right_id, similarity: the k most similar vectors of every query (ties by id), or
    all pairs with cosine similarity at or above the threshold.

    The large side is read once and packed into blocks; every block meets every block of the query
    set, and a task keeps the k best hits per query over all its products (as long as they fit in
    ``HELD_HITS``, else per product).  Queries are sent to every task;
    more than ``query_bytes`` of them are refused.  None takes any number: the blocks of vectors are
    dealt over salts, the query blocks are shuffled to each salt.
    """
    if (k is None) == (threshold is None):
        raise ValueError("give either k or threshold")
    lefts = _blocks(vectors, left_id, vector, block_rows)
    asked = _blocks(queries, right_id, vector, block_rows).toDF("qn", "qids", "qm")
    if query_bytes is not None:
        pairs = lefts.join(F.broadcast(checked(asked, query_bytes)))
    else:
        salted = asked.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        pairs = lefts.withColumn("_salt", F.pmod(F.xxhash64("ids"), F.lit(SALTS)).cast("int")).join(salted, "_salt")

    def frame(ids, qids, sims) -> pd.DataFrame:
        return pd.DataFrame({"left_id": ids, "right_id": qids, "similarity": sims})

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best, held = {}, 0  # ids of a query block -> left ids and similarities, a row per query

        def flush():
            for qids, (ids, sims) in best.items():
                yield frame(ids.ravel(), np.repeat(np.asarray(qids), ids.shape[1]), sims.ravel())
            best.clear()

        for pdf in batches:
            for n, ids, m, qn, qids, qm in pdf[["n", "ids", "m", "qn", "qids", "qm"]].itertuples(index=False):
                order = np.argsort(ids, kind="stable")
                ids = np.asarray(ids)[order]
                sims = np.round(np.frombuffer(qm).reshape(qn, -1) @ np.frombuffer(m).reshape(n, -1)[order].T, SIM_DIGITS)
                if threshold is not None:
                    rows, cols = np.nonzero(sims >= threshold)
                    yield frame(ids[cols], np.asarray(qids)[rows], sims[rows, cols])
                    continue
                cols = np.argsort(-sims, axis=1, kind="stable")[:, :k]
                ids, sims, key = ids[cols], np.take_along_axis(sims, cols, 1), tuple(qids)
                if key in best:
                    held -= best[key][0].size
                    ids, sims = (np.hstack(x) for x in zip(best[key], (ids, sims)))
                    for by in (lambda: ids, lambda: -sims):
                        cols = np.argsort(by(), axis=1, kind="stable")
                        ids, sims = np.take_along_axis(ids, cols, 1), np.take_along_axis(sims, cols, 1)
                    ids, sims = ids[:, :k], sims[:, :k]
                best[key] = ids, sims
                held += ids.size
                if held > HELD_HITS:
                    yield from flush()
                    held = 0
        yield from flush()

    types = [dict(side.dtypes)[name] for side, name in ((vectors, left_id), (queries, right_id))]
    hits = pairs.mapInPandas(multiply, f"left_id {types[0]}, right_id {types[1]}, similarity double")
    if k is None:
        return hits
    best = W.partitionBy("right_id").orderBy(F.desc("similarity"), "left_id")
    return hits.withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= k).drop("_rn")
