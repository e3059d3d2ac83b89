"""Ranking evaluation: P@k, average precision and nDCG per query, and their macro averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def relevance_verdict(answer: Column) -> Column:
    """Judge answer to 0/1: a ``1`` anywhere wins, everything else is 0."""
    return F.when(answer.contains("1"), 1).otherwise(0)


def override_verdict(suggested: Column, human: Column) -> Column:
    """Human answer over the suggestion: blank keeps it, ``s`` is 0, unknown text keeps it."""
    said = F.lower(F.trim(human))
    return (F.when(said.isNull() | (said == ""), suggested).when(said == "s", 0)
            .when(said.isin("0", "1"), said.try_cast("int")).otherwise(suggested))


def annotate(hits: DataFrame, judge: DataFrame) -> DataFrame:
    """Ranked hits with the relevance of a judgement table (query_id, doc_id, relevance);
    unjudged hits count as 0."""
    return (hits.join(judge, ["query_id", "doc_id"], "left")
            .withColumn("relevance", F.coalesce("relevance", F.lit(0)).cast("int")))


def per_query(annotations: DataFrame, k: int = 10) -> DataFrame:
    """query_id, n, precision, average_precision, ndcg from (query_id, rank, relevance).

    Precision divides by min(k, n); average precision by the relevant *returned*; the ideal order
    sorts the same list.  The list of a query is what one search returned, so it is bounded by
    the search depth.
    """
    by_rank = W.partitionBy("query_id").orderBy("rank")
    numbered = (annotations
                .withColumn("i", F.row_number().over(by_rank))
                .withColumn("seen", F.sum("relevance").over(
                    by_rank.rowsBetween(W.unboundedPreceding, W.currentRow)))
                .withColumn("best_i", F.row_number().over(
                    W.partitionBy("query_id").orderBy(F.desc("relevance"), "rank"))))
    gain = F.pow(F.lit(2.0), F.col("relevance")) - 1
    rel = F.col("relevance")
    sums = numbered.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("i") <= k, rel).otherwise(0)).alias("rel_at_k"),
        F.sum(rel).alias("n_rel"),
        F.sum(F.when(rel != 0, F.col("seen") / F.col("i")).otherwise(0.0)).alias("ap_sum"),
        F.sum(F.when(F.col("i") <= k, gain / F.log2(F.col("i") + 1)).otherwise(0.0)).alias("dcg"),
        F.sum(F.when(F.col("best_i") <= k, gain / F.log2(F.col("best_i") + 1)).otherwise(0.0))
        .alias("ideal"))
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return sums.select(
        "query_id", "n",
        (F.col("rel_at_k") / F.least(F.lit(k), F.col("n"))).alias("precision"),
        ratio("ap_sum", "n_rel").alias("average_precision"),
        ratio("dcg", "ideal").alias("ndcg"))


def macro(per_query_metrics: DataFrame) -> DataFrame:
    """One row: number of queries, mean P@k, MAP and mean nDCG."""
    return per_query_metrics.agg(
        F.count(F.lit(1)).alias("n_queries"), F.avg("precision").alias("precision"),
        F.avg("average_precision").alias("map"), F.avg("ndcg").alias("ndcg"))


def ordered_relevance(annotations: DataFrame) -> DataFrame:
    """query_id -> relevances in rank order, as one array per query."""
    return (annotations.groupBy("query_id")
            .agg(F.array_sort(F.collect_list(F.struct("rank", "relevance"))).alias("l"))
            .select("query_id", F.transform("l", lambda x: x["relevance"]).alias("relevances")))
