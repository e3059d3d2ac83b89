"""Incremental ingest: only papers not seen before, the seen set kept across runs."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators.joins import unseen
from corvane.session import exists


def new_papers(spark: SparkSession, folder: str, pattern: str = "*.{html,xml}") -> DataFrame:
    """Stream of landed markup files: paper_id, source, markup."""
    files = (spark.readStream.format("text").option("wholetext", True)
             .option("pathGlobFilter", pattern).load(folder)
             .withColumn("name", F.col("_metadata.file_name")))
    return files.select(F.regexp_replace("name", r"\.(html|xml)$", "").alias("paper_id"),
                        F.element_at(F.split("name", r"\."), -1).alias("source"),
                        F.col("value").alias("markup"))


def first_of_batch(batch: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the smallest ``order``; aggregated per task first."""
    rest = [c for c in batch.columns if c != key]
    best = batch.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("r"))
    return best.select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


BUCKETS = 256


def ingest(stream: DataFrame, key: str, order: str, target: str, checkpoint: str, buckets: int = BUCKETS):
    """Append unseen keys of every micro-batch to the table at ``target``.

    The table itself is the seen set, so no streaming state grows.  It is partitioned by a hash bucket of
    the key and by batch; a batch reads the keys of the buckets that its own keys fall in, and nothing
    else of the table.  A batch that is run again after a failure overwrites its own partitions and
    never looks at them, so no row is lost or doubled.
    """
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = first_of_batch(batch, key, order).filter(F.col(key).isNotNull()).withColumn("bucket", bucket)
        fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)  # asked for its buckets, then written
        try:
            touched = [r[0] for r in fresh.select("bucket").distinct().collect()]  # ``buckets`` numbers at most
            # as a literal list, so that only these partitions are listed and read; it may not exist yet
            folders = [f"{target}/bucket={b}" for b in touched if exists(spark, f"{target}/bucket={b}")]
            new = fresh
            if folders:
                seen = spark.read.schema(f"{key} {dict(fresh.dtypes)[key]}, batch long").option("basePath", target).parquet(*folders)
                new = unseen(fresh, seen.filter(F.col("batch") != batch_id), key)
            (new.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket", "batch").parquet(target))
        finally:
            fresh.unpersist()

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
