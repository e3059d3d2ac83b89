"""Join helpers that stay whole and spread out under hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16
QUERY_BYTES = 256 << 20  # limit of a stated query set that is sent to every task, as JSON text


def checked(df: DataFrame, limit: int = QUERY_BYTES) -> DataFrame:
    """``df`` as long as its rows, written as JSON, have at most ``limit`` bytes; else the query
    that uses it fails with a message.  What passes may be sent to every task."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).scalar()
    too_large = F.raise_error(F.concat(F.lit(f"over {limit} bytes to broadcast: "), size.cast("string")))
    return df.filter(F.when(size > limit, too_large).otherwise(F.lit(True)))


def salted_lookup(big: DataFrame, small: DataFrame, on: list[str], spread: list[str],
                  salts: int = SALTS, how: str = "inner", flag: str | None = None) -> DataFrame:
    """Join of a large skewed table with a lookup table, inner or left.

    One key of ``big`` is spread over ``salts`` reduce tasks by the hash of ``spread`` (a row
    key); ``small`` is repeated once per salt.  No size is assumed: adaptive execution turns the
    join into a broadcast when the measured lookup side is small.  ``flag`` names a column that
    tells whether a row was found.
    """
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if flag is not None:
        repeated = repeated.withColumn(flag, F.lit(True))
    joined = salted.join(repeated, [*on, "_salt"], how).drop("_salt")
    return joined if flag is None else joined.withColumn(flag, F.coalesce(flag, F.lit(False)))


def equi_match(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str) -> DataFrame:
    """Match table of two sources on an equal key, as id pairs; missing keys match nothing."""
    a = left.select(F.col(key).alias("_ka"), F.col(left_id))
    b = right.select(F.col(key).alias("_kb"), F.col(right_id))
    return a.join(b, F.col("_ka") == F.col("_kb")).select(left_id, right_id)


def missing_key_pairs(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: how many rows of either side have no key, and how many pairs a merge that lets
    missing keys match each other would add.  The pairs themselves are all of one side with all
    of the other, so they are only counted."""
    n = [side.agg(F.count_if(F.col(key).isNull()).alias(out)) for side, out in ((left, "n_left"), (right, "n_right"))]
    return n[0].select("n_left", n[1].scalar().alias("n_right")).withColumn("pairs", F.col("n_left") * F.col("n_right"))


def zip_rows(left: DataFrame, right: DataFrame, rank: str) -> DataFrame:
    """Positional zip of two frames that carry the same dense rank column."""
    return left.join(right, rank)


def unseen(incoming: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows of ``incoming`` whose key is neither in ``seen`` nor null."""
    return incoming.filter(F.col(key).isNotNull()).join(seen.select(key).distinct(), key, "left_anti")


def complete_papers(papers: DataFrame, key: str, *parts: DataFrame) -> DataFrame:
    """Papers for which every part table has at least one row."""
    for part in parts:
        papers = papers.join(part.select(key).distinct(), key, "left_semi")
    return papers


def attach_metadata(content: DataFrame, metadata: DataFrame, key: str, found: str = "found") -> DataFrame:
    """Content with its metadata; ``found`` tells which rows have any."""
    joined = content.join(metadata.withColumn(found, F.lit(True)), key, "left")
    return joined.withColumn(found, F.coalesce(found, F.lit(False)))


def true_labels(pairs: DataFrame, match_table: DataFrame, left_id: str, right_id: str,
                out: str = "true_label") -> DataFrame:
    """1 when the id pair is in the match table, else 0; ids arrive as text like ``12.0`` and an
    unreadable id counts as no match."""
    def as_id(c: str):
        return F.col(c).cast("string").try_cast("double").cast("long")

    known = match_table.select(F.col(left_id).cast("long").alias("_l"),
                               F.col(right_id).cast("long").alias("_r")).distinct()
    keyed = pairs.withColumn("_pl", as_id(left_id)).withColumn("_pr", as_id(right_id))
    joined = keyed.join(known.withColumn("_hit", F.lit(1)),
                        (F.col("_pl") == F.col("_l")) & (F.col("_pr") == F.col("_r")), "left")
    return joined.select(*pairs.columns, F.coalesce("_hit", F.lit(0)).cast("int").alias(out))
