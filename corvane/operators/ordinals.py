"""Global row numbers, shuffles, samples and splits without a one-task window.

A rank over a whole table is built from bounded buckets: rows are numbered inside their bucket,
bucket sizes are pre-aggregated, and the running sum of sizes is added as an offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# 16**3 buckets: the offsets table has at most 4,096 rows per group, whatever the data size.
BUCKET_DIGITS = 3


def hash_order(keys: list[str], seed: int = 42) -> Column:
    """Order key of a reproducible shuffle: md5 of the seed and the row key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def with_shuffle_rank(df: DataFrame, keys: list[str], out: str = "rank", seed: int = 42,
                      within: list[str] | None = None, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Number rows 1..n in hash order, over the table or inside each ``within`` group.

    ``keys`` must identify a row: the hash then spreads every group, also one that holds a third
    of the table, evenly over 16**digits buckets.
    """
    within = within or []
    hashed = (df.withColumn("_h", hash_order(keys, seed))
                .withColumn("_b", F.substring("_h", 1, digits)))
    sizes = hashed.groupBy(*within, "_b").agg(F.count(F.lit(1)).alias("_n"))
    # at most 16**digits rows per group reach one task here
    before = W.partitionBy(*within).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*within, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    if not within:
        offsets = F.broadcast(offsets)  # proven bound: 16**digits rows
    in_bucket = W.partitionBy(*within, "_b").orderBy("_h", *keys)
    numbered = hashed.withColumn("_r", F.row_number().over(in_bucket))
    on = [hashed_col for hashed_col in [*within, "_b"]]
    condition = None
    left, right = numbered.alias("l"), offsets.alias("r")
    for c in on:
        term = F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
        condition = term if condition is None else condition & term
    return left.join(right, condition).select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col("l._r") + F.col("r._off")).cast("long").alias(out))


def with_key_rank(df: DataFrame, key: str, out: str = "rank", start: Column | int = 1,
                  bits: int = 20) -> DataFrame:
    """Number rows in the order of a unique non-negative bigint ``key``.

    Rows are numbered inside blocks of 2**bits neighbouring keys; block sizes are summed inside
    super-blocks of 2**bits blocks, and super-block sizes in one small window (a 10**15 key range
    gives under 1,000 of them).
    """
    size = F.lit(2 ** bits)
    keyed = df.withColumn("_blk", F.floor(F.col(key) / size))
    blocks = keyed.groupBy("_blk").agg(F.count(F.lit(1)).alias("_n"))
    blocks = blocks.withColumn("_sup", F.floor(F.col("_blk") / size))
    supers = blocks.groupBy("_sup").agg(F.sum("_n").alias("_n"))
    preceding = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    supers = supers.select("_sup", F.coalesce(
        F.sum("_n").over(preceding(W.orderBy("_sup"))), F.lit(0)).alias("_soff"))
    offsets = (blocks.join(supers, "_sup")
               .withColumn("_off", F.col("_soff") + F.coalesce(
                   F.sum("_n").over(preceding(W.partitionBy("_sup").orderBy("_blk"))), F.lit(0)))
               .select("_blk", "_off"))
    numbered = keyed.withColumn("_r", F.row_number().over(W.partitionBy("_blk").orderBy(key)))
    first = start if isinstance(start, Column) else F.lit(start)
    return numbered.join(offsets, "_blk").select(
        *df.columns, (F.col("_r") + F.col("_off") - 1 + first).cast("long").alias(out))


def shuffle_rows(df: DataFrame, keys: list[str], seed: int = 42) -> DataFrame:
    """All rows with their position in a reproducible full shuffle; sort by it when writing."""
    return with_shuffle_rank(df, keys, "position", seed)


def split_three(df: DataFrame, keys: list[str], train: float = 0.7, valid: float = 0.15,
                seed: int = 42) -> DataFrame:
    """Exact train/valid/test split: floor(train*n), floor(valid*n), the remainder to test."""
    ranked = with_shuffle_rank(df, keys, "_rank", seed)
    n = df.agg(F.count(F.lit(1))).scalar()
    n_train = F.floor(F.lit(train) * n)
    n_valid = F.floor(F.lit(valid) * n)
    return ranked.withColumn(
        "split",
        F.when(F.col("_rank") <= n_train, "train")
        .when(F.col("_rank") <= n_train + n_valid, "valid")
        .otherwise("test")).drop("_rank")


def first_n(df: DataFrame, keys: list[str], n: Column | int, seed: int = 42,
            within: list[str] | None = None) -> DataFrame:
    """n rows without replacement (per group), in hash order."""
    if isinstance(n, int) and not within:
        hashed = df.withColumn("_h", hash_order(keys, seed))
        return hashed.orderBy("_h", *keys).limit(n).drop("_h")
    limit = n if isinstance(n, Column) else F.lit(n)
    ranked = with_shuffle_rank(df, keys, "_rank", seed, within)
    return ranked.filter(F.col("_rank") <= limit).drop("_rank")


def sample_chunks(df: DataFrame, key: str, fraction: float, chunk_rows: int = 1000,
                  seed: int = 42) -> DataFrame:
    """Sample ``round(fraction * rows)`` rows of every chunk of ``chunk_rows`` rows in key order."""
    numbered = with_key_rank(df, key, "_ord", start=0)
    chunked = (numbered.withColumn("_chunk", F.floor(F.col("_ord") / chunk_rows))
               .withColumn("_h", hash_order([key], seed)))
    chunk = W.partitionBy("_chunk")  # at most chunk_rows rows each
    picked = (chunked.withColumn("_pos", F.row_number().over(chunk.orderBy("_h", key)))
              .withColumn("_size", F.count(F.lit(1)).over(chunk))
              .filter(F.col("_pos") <= F.bround(F.lit(fraction) * F.col("_size"))))
    return picked.select(*df.columns)


def balanced_sample(df: DataFrame, keys: list[str], label: str, fraction: float = 0.3,
                    seed: int = 42) -> DataFrame:
    """At most ``floor(fraction*n)//2 + 1`` rows of each label."""
    n = df.agg(F.count(F.lit(1))).scalar()
    per_class = F.floor(F.floor(F.lit(fraction) * n) / 2) + 1
    return first_n(df, keys, per_class, seed, within=[label])


def page_of_rows(df: DataFrame, key: str, start: int, max_results: int) -> DataFrame:
    """Rows ``start .. start+max_results-1`` (from 0) in key order."""
    return (with_key_rank(df, key, "ordinal", start=0)
            .filter(F.col("ordinal").between(start, start + max_results - 1)))
