"""The driver tables in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators import search, stored_index
from corvane.session import dropping_shuffles, private_folder, spread, version


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_WRITTEN: dict[tuple, stored_index.StoredIndex] = {}


def index_of(spark: SparkSession, sf_dir: str, name: str, fields, docs, keep: tuple[str, ...] = ()) -> stored_index.StoredIndex:
    """The index ``name`` over the tables of a folder: written once per application and state of the
    documents, read by every later search.  ``docs`` gives the rows to index, ``fields`` their analyzers: a table or a
    function of the rows."""
    source = f"{sf_dir.rstrip('/')}/documents.parquet"
    key = (spark.sparkContext.applicationId, name, source, version(spark, source))
    if key not in _WRITTEN:
        with dropping_shuffles(spark):
            found = docs(spark, sf_dir)
            rows = search.Index(found, fields(found) if callable(fields) else fields)
            _WRITTEN[key] = stored_index.write_index(rows, private_folder(spark, f"index-{name}"), keep)
    return _WRITTEN[key]


def spread_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table for CPU-heavy work, over all cores where the session asks for it."""
    return spread(table(spark, sf_dir, name), key)


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as papers: title is the first line, abstract the rest."""
    docs = spread_table(spark, sf_dir, "documents", "doc_id")
    title = F.substring_index("text", "\n", 1)
    return docs.select("doc_id", "lang", "source", "text", title.alias("title"),
                       F.expr("substring(text, length(substring_index(text, '\n', 1)) + 2)")
                       .alias("abstract"))


def passages(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """Benchmark passages as queries with one clause per field, each asking the whole text."""
    clauses = F.array(*[F.struct(F.lit(i).alias("clause"), F.lit(f).alias("field"))
                        for i, f in enumerate(fields)])
    return (table(spark, sf_dir, "benchmark")
            .select(F.col("item_id").alias("query_id"), "text", F.explode(clauses).alias("c"))
            .select("query_id", "c.clause", "c.field", "text"))
