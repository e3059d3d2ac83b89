"""One action per output; no append loops.  What a line or an object looks like is a function of
its own, so it can be used on any table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True, escape='"')


def csv_lines(df: DataFrame, out: str = "value") -> DataFrame:
    """Every row as one CSV line."""
    return df.select(F.to_csv(F.struct(*df.columns), {"escape": '"'}).alias(out))


def lines(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    df.select(F.col(column).alias("value")).write.mode(mode).text(path)


def jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def json_lines(df: DataFrame, out: str = "value") -> DataFrame:
    """Every row as one JSON object."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(out))


def routes(df: DataFrame, kept: Column, reason: str | None = None) -> DataFrame:
    """Rows with ``route`` (kept or rejected); a kept row has no reason."""
    out = df.withColumn("route", F.when(kept, "kept").otherwise("rejected"))
    if reason is not None:
        out = out.withColumn(reason, F.when(F.col("route") == "rejected", F.col(reason)))
    return out


def routed(df: DataFrame, kept: Column, path: str, reason: str | None = None) -> None:
    """Kept and rejected rows under ``route=kept`` and ``route=rejected``, in one pass."""
    routes(df, kept, reason).write.mode("overwrite").partitionBy("route").parquet(path)


def splits(df: DataFrame, path: str) -> None:
    """train, valid and test folders of a frame with a ``split`` column."""
    df.write.mode("overwrite").partitionBy("split").csv(path, header=True, escape='"')


def json_lists(objects: DataFrame, path: str, key: str = "paper_id") -> None:
    """One line per paper with its objects as a JSON array."""
    object_lists(objects, key).write.mode("overwrite").json(path)


def object_lists(objects: DataFrame, key: str = "paper_id") -> DataFrame:
    """key, objects: the objects of a paper as a JSON array.  They entered as one file, so a list
    is bounded by that file."""
    rest = [c for c in objects.columns if c != "ordinal"]
    packed = objects.groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct("ordinal", F.struct(*rest).alias("o")))).alias("l"))
    return packed.select(key, F.to_json(F.transform("l", lambda x: x["o"])).alias("objects"))


def link_maps(links: DataFrame) -> DataFrame:
    """paper_id, links: the map object_id -> paragraph ids of every paper as JSON."""
    per_object = (links.groupBy("paper_id", "object_id")
                  .agg(F.array_sort(F.collect_list(F.struct("ordinal", "position", "paragraph_id")))
                       .alias("l")))
    entry = F.struct("object_id", F.transform("l", lambda x: x["paragraph_id"]).alias("ids"))
    return per_object.groupBy("paper_id").agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("links"))


def create_table(df: DataFrame, name: str, replace: bool = False) -> None:
    """Create the table when absent; ``replace`` overwrites it."""
    df.write.mode("overwrite" if replace else "ignore").saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def load_checked(df: DataFrame, ok: Column, path: str) -> tuple[int, int]:
    """Write the good rows and return (written, refused); bad rows do not stop the load."""
    df.filter(F.coalesce(ok, F.lit(False))).write.mode("append").parquet(path)
    row = load_counts(df, ok).first()
    return row["written"], row["refused"]


def load_counts(df: DataFrame, ok: Column) -> DataFrame:
    """One row: how many rows a checked load writes and refuses; an unknown verdict refuses."""
    good = F.coalesce(ok, F.lit(False))
    return df.agg(F.count_if(good).alias("written"), F.count_if(~good).alias("refused"))


def run_entry(initial: DataFrame, budget: DataFrame, final: DataFrame, label: str,
              params: dict[str, str]) -> DataFrame:
    """One-row run log: label counts at three stages and the parameters."""
    def counts(df: DataFrame, stage: str) -> DataFrame:
        return (df.groupBy(F.col(label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit(stage).alias("stage"), "label", "n"))

    stages = counts(initial, "initial").unionByName(counts(budget, "post_budget")) \
        .unionByName(counts(final, "final"))
    fixed = [F.lit(x) for pair in sorted(params.items()) for x in pair]
    return stages.agg(
        F.current_timestamp().alias("timestamp"),
        F.array_sort(F.collect_list(F.struct("stage", "label", "n"))).alias("sizes")) \
        .withColumn("params", F.create_map(*fixed) if fixed else F.lit(None).cast("map<string,string>"))
