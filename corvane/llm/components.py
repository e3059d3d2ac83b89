"""Connected components of a graph whose edges and nodes stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours of a node are linked to the least node around it.

    Large: the neighbours above the node.  Small: those below it, and the node.  The least node is
    found with a partial aggregation, and the join that hands it out is one that Spark splits at run
    time where a node has a large share of the edges.
    """
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = around.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    if large:
        least = least.select("c", F.least("c", "m").alias("m"))
        linked = around.filter("v > u").join(least.hint("merge"), F.col("u") == F.col("c")).select(F.col("v").alias("u"),
                                                                                 F.col("m").alias("v"))
    else:
        linked = around.join(least.hint("merge"), F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        linked = linked.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return linked.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node that has an edge; the label is the least node of its component.

    ``edges``: u, v, of any orderable type; loops and repeated edges do not matter.  Alternates large
    and small stars, each pair of steps written to the shared folder, until nothing changes: then
    every node points to its label.
    """
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .filter("u <> v").distinct(), "edges")
    before = None
    while True:
        digest = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.bit_xor(F.xxhash64("v", F.lit(1), "u"))).first()
        if digest == before or not digest[0]:
            break
        before = digest
        edges = stored(_star(_star(edges, True), False), "edges")
    labels = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
    return labels.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
