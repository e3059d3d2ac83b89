"""Texts with similar sets of word shingles, found by chosen paths."""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.common import groups, lean, stored, table, text_blocks, unused
from corvane.llm.components import components
from corvane.llm.words import shingles

TOKENS = 64
"""Sampled tokens (minima under as many hashes) that stand for a set while it is split."""
SMALL = 256
"""Sets in a bucket that is not split."""
PART = 2048
"""Sets of a part of a larger leaf, whose parts are compared two by two."""
DEPTH = 5
"""Splits of a bucket before it is taken as dense."""
HEADS = 3
"""Sets of a larger bucket that its sets are compared with before it is split."""
BLOCK_SETS, BLOCK_WORDS = 512, 400_000
"""Sets and words of a block whose pairs one task verifies."""
_FACTORS = np.array([random.Random(i).getrandbits(64) | 1 for i in range(TOKENS)], np.uint64)


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, th, set, n, sig) per row: hash of the text, digest and size of its shingles, their minima.

    ``set`` is null for a text without words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, "text"):
            sets = shingles(texts, words)
            sizes = np.array([len(s) for s in sets])
            filled = np.flatnonzero(sizes)
            sig = np.zeros((len(sets), TOKENS), np.int32)
            if len(filled):
                flat = np.concatenate(sets)
                starts = (np.cumsum(sizes) - sizes)[filled]
                for k, factor in enumerate(_FACTORS):
                    sig[filled, k] = np.minimum.reduceat((flat * factor) >> np.uint64(32), starts).astype(np.uint32).view(np.int32)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("th"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()),
                 pa.FixedSizeListArray.from_arrays(pa.array(sig.ravel()), TOKENS).cast(pa.list_(pa.int32()))],
                names=["id", "th", "set", "n", "sig"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(run), "id long, th long, set binary, n int, sig array<int>")


def runs_for(recall: float, depth: int = 3) -> int:
    """Independent runs until a pair just at the threshold meets in a leaf with this probability.

    A pair shares one child per split on average, so it survives d splits in one run with p_d =
    1 - exp(-p_(d-1)).  Three splits are counted; more similar pairs survive more often.
    """
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def _marks(threshold: float) -> tuple[int, int]:
    """Equal sampled tokens from which two sets look similar, and from which they may yet be."""
    return int((threshold - 0.2) * TOKENS), int((threshold - 0.4) * TOKENS)


def leaves(reps: DataFrame, threshold: float, recall: float, seed: int) -> tuple[DataFrame, DataFrame | None]:
    """(path, node, size) of the buckets of two sets and more that end the paths, and edges (u, v).

    ``reps``: node, sig.  A path starts in each run and splits its bucket by the tokens it samples:
    every one with probability 1 / (threshold x TOKENS), so a pair at the threshold shares one child
    on average.  Buckets of up to SMALL sets are leaves, as are those that DEPTH splits leave larger;
    all pairs of either are compared.  Singletons end at once.

    Before a larger bucket is split, its sets are compared with a few of them, the heads.  Those that
    look similar to one get an edge to it and leave the path, so a group of near copies is not
    carried down all paths.  Sets that are similar to one of these cannot be far from its head
    (distances obey the triangle inequality); they get an edge as well and go on.
    """
    rate = 1 / (threshold * TOKENS)
    wide, loose = _marks(threshold)
    draw = random.Random(seed)
    root = [(r, k) for r in range(runs_for(recall)) for k in range(TOKENS) if draw.random() < rate]
    level = reps.select("node", F.explode(F.array(*[
        F.xxhash64(F.lit(r), F.lit(k), F.col("sig")[k]) for r, k in root])).alias("path"))
    chosen = F.filter(F.sequence(F.lit(0), F.lit(TOKENS - 1)), lambda k: F.pmod(
        F.xxhash64(F.lit(seed), "path", k), F.lit(1_000_000)) < F.lit(int(rate * 1_000_000)))
    found = edges = None
    for depth in range(1, DEPTH + 1):
        counts = level.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        level = stored(level.join(counts.hint("merge"), "path"), "paths")
        large = level.filter(F.col("size") > SMALL)
        ended = level if depth == DEPTH else level.filter(F.col("size") <= SMALL)
        found = ended if found is None else found.unionByName(ended)
        if depth == DEPTH or large.isEmpty():
            return found, edges
        large = large.join(reps.hint("merge"), "node")
        heads = large.groupBy("path").agg(F.array(*[
            F.min(F.struct(F.xxhash64("node", F.lit(j)), "node", "sig")) for j in range(HEADS)]).alias("heads"))
        compared = F.transform("heads", lambda h: F.struct(h["node"].alias("node"), F.size(F.filter(
            F.zip_with("sig", h["sig"], lambda a, b: a == b), lambda x: x)).alias("same")))
        met = stored(large.join(heads.hint("merge"), "path").select("path", "node", "sig", compared.alias("heads")),
                     "heads")
        near = met.select(F.col("node").alias("u"), F.explode(F.filter("heads", lambda h: h["same"] >= loose)).alias("h"))
        near = near.select("u", F.col("h.node").alias("v")).filter("u <> v")
        edges = near if edges is None else edges.unionByName(near)
        level = met.filter(F.forall("heads", lambda h: h["same"] < wide)).select("node", F.explode(F.transform(
            chosen, lambda k: F.xxhash64("path", k, F.get("sig", k)))).alias("path"))


def _short(sig: str) -> Column:
    """The low bytes of the sampled tokens, as a binary of TOKENS bytes."""
    return F.unhex(F.array_join(F.transform(sig, lambda v: F.lpad(F.hex(v.bitwiseAND(255)), 2, "0")), ""))


def candidate_edges(found: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Edges that hold together the sets of each leaf that look similar.

    A leaf is compared by brute force on the sampled tokens.  One of more than SMALL sets is cut into
    parts of about PART sets by hash, and every two parts meet in a task of their own: all pairs of
    the leaf are compared, and no task holds more than two parts.  Estimates pass well below the
    threshold; the exact check follows.
    """
    wide, _ = _marks(threshold)
    sketch = reps.select("node", _short("sig").alias("sketch"))
    parts = F.when(F.col("size") > SMALL, F.ceil(F.col("size") / PART)).otherwise(1).cast("int")
    rows = found.join(sketch, "node").withColumn("parts", parts).withColumn(
        "own", F.pmod(F.xxhash64("node", "path"), F.col("parts")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: (p != F.col("own")) | (F.col("parts") == 1))
    members = rows.select("path", "own", "node", "sketch", F.explode(others).alias("other")).select(
        "path", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "node", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: list[tuple[bytes, bytes]] = []
        for _, bucket in groups(batches, ["path", "a", "b"]):
            sketch_of = {r["node"]: r["sketch"] for r in bucket}
            nodes = sorted(sketch_of)  # the same forest in every run
            if len(nodes) > 1:
                edges += _linked(nodes, np.frombuffer(b"".join(sketch_of[n] for n in nodes), np.uint8)
                                 .reshape(-1, TOKENS), wide)
            if len(edges) > 50_000:
                yield _pairs(edges)
                edges = []
        yield _pairs(edges)

    return (members.repartition("path", "a", "b").sortWithinPartitions("path", "a", "b")
            .mapInArrow(lean(run), "u binary, v binary").distinct())


def _pairs(edges: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"u": pa.array([e[0] for e in edges], pa.binary()),
                                       "v": pa.array([e[1] for e in edges], pa.binary())})


def _linked(nodes: list[bytes], sketch: np.ndarray, wide: int) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the sets with enough equal tokens, from the first set on."""
    rest = np.ones(len(nodes), bool)
    edges = []
    for start in range(len(nodes)):
        if not rest[start]:
            continue
        rest[start] = False
        queue = [start]
        while queue and rest.any():
            i = queue.pop()
            others = np.flatnonzero(rest)
            near = others[(sketch[others] == sketch[i]).sum(axis=1) >= wide]
            rest[near] = False
            queue += near.tolist()
            edges += [(nodes[i], nodes[j]) for j in near]
    return edges


def _adjacent(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Whether two sets' exact Jaccard similarity reaches the threshold, for all pairs of a block."""
    sizes = np.array([len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    common = count[column] > 1  # others are in no intersection
    number = np.cumsum(count > 1) - 1
    row, column = row[common], number[column[common]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    meet = np.zeros((len(sets), len(sets)), np.float32)
    step = 8192
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [low, low + step])
        part = np.zeros((len(sets), min(step, int(column[b - 1]) - low + 1) if b > a else 1), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        meet += part @ part.T
    union = sizes[:, None] + sizes[None, :] - meet.astype(np.float64)
    near = meet / union >= threshold
    np.fill_diagonal(near, False)
    return near


def verified(members: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int,
             threshold: float) -> DataFrame:
    """(node, parent, links) from exact similarities inside each candidate group.

    ``members``: node, label, copies, n, id, th.  A group is dealt into blocks by hash, and a task
    takes two blocks; so no task holds a large group, and no pair leaves its task: what comes out is
    one row per set and pair of blocks, with the documents it is linked to there and the least set
    it hangs together with.
    """
    size = members.groupBy("label").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS),
                                                   F.ceil(F.sum("n") / BLOCK_WORDS)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (members.join(size.hint("merge"), "label").withColumn("own", own)
             .select("label", "node", "copies", "own", F.col("id").alias("_id"), F.col("th").alias("_th"),
                     F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")))
    texts = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("text"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"))
    # The hint: the same plan at every size, not a broadcast that small groups would get.
    rows = (dealt.hint("merge").join(texts, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_th") == F.col("_text")))
            .select("label", F.least("own", "with").alias("a"), F.greatest("own", "with").alias("b"), "own", "node",
                    "copies", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (_, a, b), block in groups(batches, ["label", "a", "b"]):
            block = list({r["node"]: r for r in block}.values())  # rows that repeat an id and text
            near = _adjacent(shingles([r["text"] for r in block], words), threshold)
            if a != b:  # pairs inside a block belong to (a, a) and (b, b)
                side = np.array([r["own"] == a for r in block])
                near &= side[:, None] != side[None, :]
            links = near @ np.array([r["copies"] for r in block], np.int64)
            nodes = [r["node"] for r in block]
            out += zip(nodes, _roots(near, nodes), links.tolist())
            if len(out) > 20_000:
                yield _links(out)
                out = []
        yield _links(out)

    return (rows.repartition("label", "a", "b").sortWithinPartitions("label", "a", "b")
            .mapInArrow(lean(run), "node binary, parent binary, links long"))


def _links(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in
                                       enumerate((pa.binary(), pa.binary(), pa.int64()))],
                                      names=["node", "parent", "links"])


def _roots(near: np.ndarray, nodes: list[bytes]) -> list[bytes]:
    """The least node that each one hangs together with."""
    roots: list[bytes | None] = [None] * len(nodes)
    for start in sorted(range(len(nodes)), key=nodes.__getitem__):
        if roots[start] is None:
            queue, seen = [start], np.zeros(len(nodes), bool)
            seen[start] = True
            while queue:
                i = queue.pop()
                roots[i] = nodes[start]
                more = np.flatnonzero(near[i] & ~seen)
                seen[more] = True
                queue += more.tolist()
    return roots


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                 threshold: float = 0.8, recall: float = 0.999, seed: int = 0) -> DataFrame:
    """One row per document: its class and how many other documents it is linked to.

    Two documents are linked when the Jaccard similarity of their sets of ``words``-word shingles is
    at least ``threshold``; classes are what links hold together, named by the least id.  Candidates
    come from chosen paths, repeated until pairs at the threshold meet with probability ``recall``;
    similarities are then exact.

    Documents with the same set are one set from the first shuffle on; their links to each other
    count.  A text without words (null, empty) has no link and is a class of its own, with its own
    id.  A class whose ids are all null has a null id.  Repeated rows are documents linked to each
    other.  An empty table gives no row, other columns are not read.
    """
    rows = stored(sketches(docs, id_col, text_col, words), "sketches")
    reps = stored(rows.filter("set IS NOT NULL").groupBy(F.col("set").alias("node"))
                  .agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"),
                       F.min(F.struct("id", "th")).alias("doc"), F.first("n").alias("n"), F.first("sig").alias("sig")),
                  "sets")
    found, edges = leaves(reps.select("node", "sig"), threshold, recall, seed)
    near = candidate_edges(found, reps, threshold)
    group = components(near if edges is None else near.unionByName(edges))
    members = stored(reps.select("node", "copies", "n", "doc.id", "doc.th").join(group, "node"), "groups")
    linked = stored(verified(members, docs, id_col, text_col, words, threshold), "links")
    classes = components(linked.select(F.col("node").alias("u"), F.col("parent").alias("v")))
    degree = linked.groupBy("node").agg(F.sum("links").alias("links"))
    known = stored(reps.select("node", "copies", "least").join(degree, "node", "left").join(classes, "node", "left")
                   .select("node", "least", F.coalesce("label", "node").alias("label"),
                           (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    names = known.groupBy("label").agg(F.min("least").alias("class_id"))
    named = known.join(names.hint("merge"), "label").select("node", "class_id", "n_links")
    alone = rows.filter("set IS NULL").select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return (rows.join(named.hint("merge"), F.col("set") == F.col("node")).select("id", "class_id", "n_links")
            .unionByName(alone).withColumnRenamed("id", id_col))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the document of the least id of each class; all columns as they were.

    Rows that repeat that id with a text of the class stay together; rows with a null id stay.
    """
    own = unused(docs, "_kept")
    kept = stored(jaccard_join(docs, id_col, text_col, **options).filter(F.col(id_col) == F.col("class_id"))
                  .select(F.col(id_col).alias(own)).distinct(), "kept")
    return docs.join(kept.hint("merge"), F.col(id_col).cast("long") == F.col(own), "left_semi").unionByName(
        docs.filter(F.col(id_col).isNull()))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
