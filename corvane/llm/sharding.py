"""Shards that each hold the mixture of the sources, by fractional ranks.  DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.llm.common import stored, table

BUCKET = 2000
"""Rows ranked by one task at a time, on average."""
STEP = 1000
"""Neighbouring buckets whose counts are summed by one task at a time."""


def _rank(rows: DataFrame, strata: list[str], place: str, ties: list[str], buckets: int, out: str) -> DataFrame:
    """Exact rank (from 0) of every row of a stratum by ``place`` in [0, 1), then by ``ties``.

    Rows are ranked inside equal intervals of ``place``; an interval begins at the number of rows
    before it, summed inside steps of buckets and over the steps.  So no task holds a stratum, however
    many rows that has.
    """
    keyed = rows.withColumn("_bucket", F.floor(F.col(place) * buckets))
    counts = (keyed.groupBy(*strata, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_step", F.floor(F.col("_bucket") / STEP)))

    def earlier(keys: list[str], order: str) -> Column:
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    steps = counts.groupBy(*strata, "_step").agg(F.sum("_n").alias("_n")).select(
        *[F.col(s).alias(f"_from_{s}") for s in strata], F.col("_step").alias("_from_step"),
        earlier(strata, "_step").alias("_start"))
    met = F.col("_step") == F.col("_from_step")
    for s in strata:
        met &= F.col(s).eqNullSafe(F.col(f"_from_{s}"))
    before = counts.withColumn("_inside", earlier([*strata, "_step"], "_bucket")).join(steps, met).select(
        *[F.col(s).alias(f"_of_{s}") for s in strata], F.col("_bucket").alias("_of_bucket"),
        (F.col("_start") + F.col("_inside")).alias("_before"))
    inside = Window.partitionBy(*strata, "_bucket").orderBy(place, *ties)
    met = F.col("_bucket") == F.col("_of_bucket")
    for s in strata:
        met &= F.col(s).eqNullSafe(F.col(f"_of_{s}"))
    return (keyed.withColumn("_row", F.row_number().over(inside)).join(before, met)
            .withColumn(out, F.col("_before") + F.col("_row") - 1)
            .drop("_bucket", "_row", "_before", "_of_bucket", *[f"_of_{s}" for s in strata]))


def interleave(docs: DataFrame, shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """Shard and place in it of every document: counts differ by one at most.

    Rows of a source are shuffled by a hash of seed, id and text and ranked; row r of n gets the
    fraction (r + h) / n, where h in (0, 1) is a hash of seed and source, so that many small sources
    spread over all shards and no fraction is common to them.  All rows in the order of fraction, source and hash are cut into
    ``shards`` runs, so every run holds each source in its share, to about a row.  Two passes of
    ranks move a few numbers per row, never the text.

    A null source is a source of its own.  A null text has no bytes.  Rows equal in id, text and
    source are interchangeable.  An empty table gives no row, other columns are not read.
    """
    narrow = stored(docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("-")),
                          F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))).cast("binary")).alias("shuffle")),
        "shard-rows")
    # The first 12 hex digits, as a number in [0, 1).
    narrow = narrow.withColumn("u", F.conv(F.substring("shuffle", 1, 12), 16, 10).cast("double") / float(1 << 48))
    total = narrow.count()
    buckets = total // BUCKET + 1
    ranked = _rank(narrow, ["source"], "u", ["shuffle", "id"], buckets, "r")
    sizes = narrow.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("_size"))
    shift = (F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 32)) + 0.5) / float(1 << 32)
    placed = (ranked.join(sizes, F.col("source").eqNullSafe(F.col("_source")))
              .withColumn("fraction", (F.col("r") + shift) / F.col("_size")).drop("_source", "_size"))
    whole = _rank(placed, [], "fraction", ["source", "shuffle", "id"], buckets, "g")
    return (whole.withColumn("_shard", F.expr(f"(g * {shards}L) div {max(total, 1)}L"))
            .select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"),
                    F.col("_shard").cast("int").alias("shard"),
                    F.expr(f"g - (_shard * {total}L + {shards - 1}L) div {shards}L").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), F.col("source").alias(source_col)))


def op6_stratified_interleaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave(table(spark, sf_dir, "documents"), 24).drop("source")
