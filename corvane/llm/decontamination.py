"""Benchmark items in training texts: a BM25 index with block maxima, then overlap of question and answer."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.common import lean, stored, table, text_blocks, unused
from corvane.llm.words import MULTIPLIER, NOT_ALNUM, mixed, word_hashes

BLOCK = 16
"""Items under one block maximum."""
STRETCH = 1 << 20
"""Characters of a long text that are searched at a time."""
STEP = 1 << 20
"""Numbers that the sums of block maxima hold at a time."""
GRAM = 3
"""Words of the runs that the overlap counts; fewer where a question or an answer is shorter."""

_CUT = re.compile(r"[\x00-/:-@\[-`{-\x7f]")


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    if len(words) < size or not size:
        return np.empty(0, np.uint64)
    h = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        h = h * np.uint64(MULTIPLIER) + words[k:len(words) - size + 1 + k]
    return mixed(h)


@dataclass
class Part:
    """The distinct runs of a question or an answer, and how many words a run has."""

    size: int
    runs: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray) -> Part:
        size = min(GRAM, len(words))
        return cls(size, np.unique(_runs(words, size)))

    def overlap(self, words: np.ndarray) -> float:
        """Share of the runs that a passage holds; 1 for an empty part."""
        if not len(self.runs):
            return 1.0
        return float(np.isin(self.runs, _runs(words, self.size)).mean())


@dataclass
class Statistics:
    """What scores depend on besides the item: counted over all items, whatever index holds them."""

    items: int
    mean: float
    width: int
    """Words of the longest item."""
    terms: np.ndarray
    df: np.ndarray

    @classmethod
    def of(cls, docs: list[np.ndarray]) -> Statistics:
        terms, df = np.unique(np.concatenate([*map(np.unique, docs), np.empty(0, np.uint64)]), return_counts=True)
        lengths = [len(d) for d in docs]
        return cls(len(docs), float(np.mean(lengths)) if docs else 0.0, max([1, *lengths]), terms, df)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all given runs, one after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Index:
    """Inverted index of items: term -> items and impacts, and term -> blocks of items with the largest impact.

    Impacts are BM25 weights divided by the item's own total, so an item scores 1 against itself and
    one threshold holds for short and long items.  An index may hold a part of the items; ``known``
    then are the statistics of all.
    """

    def __init__(self, items: list[tuple], known: Statistics | None = None, k1: float = 1.2, b: float = 0.75):
        self.ids = [i for i, _, _ in items]
        self.questions, self.answers, docs = [], [], []
        for _, question, answer in items:
            q, a = (word_hashes([t], NOT_ALNUM)[0] for t in (question, answer))
            self.questions.append(Part.of(q))
            self.answers.append(Part.of(a))
            docs.append(np.concatenate([q, a]))
        known = known or Statistics.of(docs)
        self.width = known.width
        self.terms = np.unique(np.concatenate([*docs, np.empty(0, np.uint64)]))
        found = [np.unique(np.searchsorted(self.terms, d), return_counts=True) for d in docs]
        term = np.concatenate([t for t, _ in found] or [np.empty(0, np.int64)])
        item = np.repeat(np.arange(len(docs)), [len(t) for t, _ in found])
        tf = np.concatenate([c for _, c in found] or [np.empty(0, np.int64)]).astype(float)
        df = known.df[np.searchsorted(known.terms, self.terms)]
        idf = np.log(1 + (known.items - df + 0.5) / (df + 0.5))
        norm = k1 * (1 - b + b * np.array([len(d) for d in docs], float) / max(known.mean, 1))
        impact = idf[term] * tf * (k1 + 1) / (tf + norm[item]) if len(term) else tf
        impact /= np.maximum(np.bincount(item, impact, minlength=len(docs)), 1e-12)[item]
        order = np.lexsort((item, term))
        term, self.postings, self.impacts = term[order], item[order], impact[order]
        self.starts = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.blocks = -(-len(docs) // BLOCK)
        key = term * max(self.blocks, 1) + self.postings // BLOCK
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.block_of = key[first] % max(self.blocks, 1)
        self.maxima = np.maximum.reduceat(self.impacts, first) * 1.000001 if len(first) else self.impacts
        self.block_starts = np.searchsorted(key[first] // max(self.blocks, 1), np.arange(len(self.terms) + 1))

    def scores(self, terms: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items of the given blocks (sorted) with their scores for a passage of these distinct terms."""
        at = _spread(self.starts[terms], self.starts[terms + 1] - self.starts[terms])
        block = self.postings[at] // BLOCK
        rank = np.minimum(np.searchsorted(blocks, block), len(blocks) - 1)
        inside = blocks[rank] == block
        at, rank = at[inside], rank[inside]
        total = np.bincount(rank * BLOCK + self.postings[at] % BLOCK, self.impacts[at], minlength=len(blocks) * BLOCK)
        return (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel(), total

    def _bounds(self, chunk: np.ndarray, term: np.ndarray, low: int, high: int) -> np.ndarray:
        """Sum of the block maxima over the distinct terms of the chunks ``low`` to ``high``."""
        a, b = np.searchsorted(chunk, [low, high])
        chunk, term = chunk[a:b] - low, term[a:b]
        sizes = self.block_starts[term + 1] - self.block_starts[term]
        ends = np.cumsum(sizes)
        out = np.zeros((high - low) * self.blocks)
        i = 0
        while i < len(term):
            j = max(i + 1, int(np.searchsorted(ends, ends[i] - sizes[i] + STEP, side="right")))
            at = _spread(self.block_starts[term[i:j]], sizes[i:j])
            key = np.repeat(chunk[i:j] * self.blocks, sizes[i:j]) + self.block_of[at]
            out += np.bincount(key, self.maxima[at], minlength=len(out))
            i = j
        return out.reshape(-1, self.blocks)

    def search(self, texts: list[str | None], threshold: float, overlap: float) -> Iterator[tuple]:
        """(text number, item number, score, question overlap, answer overlap) of every item found.

        A passage is two neighbouring chunks, each as long as the longest item: so every occurrence
        of an item lies in some passage whole.  As in block-max WAND, a block of items is left out
        where the sum of its maxima over the passage's terms stays below the threshold; the test is
        made for many passages and all blocks at once.  In the other blocks all items are scored.
        A text of more than STRETCH characters is searched in stretches that overlap by a passage.
        """
        if not len(self.terms):
            return
        best: dict[tuple[int, int], tuple] = {}
        long = [i for i, t in enumerate(texts) if t and len(t) > STRETCH]
        short = [None if t and len(t) > STRETCH else t for t in texts]
        self._passages(*word_hashes(short, NOT_ALNUM), np.arange(len(texts)), threshold, overlap, best)
        for i in long:
            text, start, words = texts[i].lower(), 0, np.empty(0, np.uint64)
            while start < len(text):
                cut = _CUT.search(text, start + STRETCH)
                end = cut.end() if cut else len(text)
                words = np.concatenate([words, word_hashes([text[start:end]], NOT_ALNUM, lower=False)[0]])
                start = end
                self._passages(words, np.array([0, len(words)]), np.array([i]), threshold, overlap, best)
                # The next stretch goes on with the last whole chunk, which waits for its neighbour.
                words = words[max(0, len(words) // self.width - 1) * self.width:]
        for (i, item), values in sorted(best.items()):
            yield i, item, *values

    def _passages(self, words: np.ndarray, offsets: np.ndarray, numbers: np.ndarray, threshold: float,
                  overlap: float, best: dict[tuple[int, int], tuple]) -> None:
        """Notes the best values of each item that the passages of these texts hold."""
        if not len(words):
            return
        chunks = -(-np.diff(offsets) // self.width)
        first_chunk = np.cumsum(chunks) - chunks
        at = np.searchsorted(self.terms, words)
        place = np.flatnonzero(self.terms[np.minimum(at, len(self.terms) - 1)] == words)
        text = np.searchsorted(offsets, place, side="right") - 1
        chunk = first_chunk[text] + (place - offsets[text]) // self.width
        pairs = np.unique(chunk * len(self.terms) + at[place])  # distinct terms of each chunk
        chunk, term = pairs // len(self.terms), pairs % len(self.terms)
        owner = np.repeat(np.arange(len(chunks)), chunks)
        same = np.append(owner[1:] == owner[:-1], False)
        begins = np.searchsorted(chunk, np.arange(len(owner) + 1))
        step = max(1, STEP // self.blocks)
        for low in range(0, len(owner), step):
            high = min(low + step, len(owner))
            bounds = self._bounds(chunk, term, low, min(high + 1, len(owner)))
            upper = bounds[:high - low].copy()
            nearby = np.flatnonzero(same[low:high])
            upper[nearby] += bounds[nearby + 1]
            for c in np.flatnonzero((upper >= threshold).any(axis=1)).tolist():
                items, score = self.scores(np.unique(term[begins[low + c]:begins[low + c + 1 + same[low + c]]]),
                                           np.flatnonzero(upper[c] >= threshold))
                hits = np.flatnonzero(score >= threshold)
                if not len(hits):
                    continue
                i = int(owner[low + c])
                a = offsets[i] + (low + c - first_chunk[i]) * self.width
                passage = words[a:min(a + 2 * self.width, offsets[i + 1])]
                for item, value in zip(items[hits].tolist(), score[hits].tolist()):
                    q, r = self.questions[item].overlap(passage), self.answers[item].overlap(passage)
                    if q >= overlap and r >= overlap:
                        key = int(numbers[i]), item
                        best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (value, q, r))


def items_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, question, answer) of one text: the answer is the last sentence, if there are several."""
    parts = r"(?s)^(.*[.?!])\s+(\S.*)$"
    text = F.trim(F.coalesce(F.col(text_col), F.lit("")))
    several = text.rlike(parts)
    return benchmark.select(F.col(id_col).cast("long").alias("item_id"),
                            F.when(several, F.regexp_extract(text, parts, 1)).otherwise(text).alias("question"),
                            F.when(several, F.regexp_extract(text, parts, 2)).otherwise("").alias("answer"))


def _entries(items: DataFrame, parts_bytes: int) -> tuple[DataFrame, int]:
    """(key, question, answer, part, words, terms) of the distinct items that have a word, and the number of parts.

    ``terms`` are the hashes of the distinct words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [np.concatenate([word_hashes([t], NOT_ALNUM)[0] for t in pair])
                    for pair in zip(batch.column("question").to_pylist(), batch.column("answer").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(w) for w in both], pa.int32()),
                 pa.array([np.unique(w).view(np.int64) for w in both], pa.list_(pa.int64()))],
                names=["key", "question", "answer", "words", "terms"])

    rows = items.select("key", "question", "answer").groupBy("key").agg(
        F.first("question").alias("question"), F.first("answer").alias("answer"))
    made = stored(rows.mapInArrow(lean(run), "key string, question string, answer string, words int, terms array<long>")
                  .filter("words > 0"), "items")
    size = made.agg(F.sum(F.octet_length("question") + F.octet_length("answer"))).first()[0] or 0
    parts = size // parts_bytes + 1
    return made.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts))), parts


def find_items(docs: DataFrame, items: DataFrame, threshold: float = 0.5, overlap: float = 0.5,
               id_col: str = "doc_id", text_col: str = "text", part_bytes: int = 1 << 24) -> DataFrame:
    """(id, item_id, score, question_overlap, answer_overlap) of every document that holds an item.

    Every passage of every document is a query against the index of ``items`` (item_id, question,
    answer).  Retrieved are all items that score ``threshold`` or more; they count where the passage
    also holds a share of ``overlap`` of the word runs of the question and of the answer.  Words are
    lower-cased runs of letters and digits.

    Items with the same question and answer are one entry of the index; each gives its rows.  Number
    of entries, document frequencies, mean and greatest length are counted once over all of them by
    Spark.  An index of entries of ``part_bytes`` is broadcast; more are dealt into parts of about
    that size, with one pass over the documents each.  Scores do not depend on the parts.

    Items without a word are never found, a null text holds none, repeated rows each give their
    rows, and an empty table gives no row.
    """
    spark = docs.sparkSession
    question, answer = (F.coalesce(F.col(c), F.lit("")) for c in ("question", "answer"))
    keyed = items.select("item_id", question.alias("question"), answer.alias("answer"),
                         F.sha2(F.to_json(F.struct(question.alias("q"), answer.alias("a"))), 256).alias("key"))
    entries, parts = _entries(keyed, part_bytes)
    count, mean, width = entries.agg(F.count(F.lit(1)), F.avg("words"), F.max("words")).first()
    terms = entries.select("part", F.explode("terms").alias("term"))
    counts = stored(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "frequencies")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, key string, score double, question_overlap double, answer_overlap double"
    found = spark.createDataFrame([], schema)
    for k in range(parts if count else 0):
        asked = terms.filter(F.col("part") == k).select("term").distinct()
        df = counts.join(asked, "term", "left_semi").select("term", "df").toArrow()
        term = df.column("term").to_numpy().view(np.uint64)
        order = np.argsort(term)
        known = Statistics(count, mean, width, term[order], df.column("df").to_numpy()[order])
        part = entries.filter(F.col("part") == k).select("key", "question", "answer")
        shared = spark.sparkContext.broadcast(Index(sorted(map(tuple, part.collect())), known))
        found = found.unionByName(rows.mapInArrow(lean(_searcher(shared, threshold, overlap)), schema))
    return (found.join(keyed.select("key", F.col("item_id").cast("long").alias("item_id")), "key")
            .select(F.col("id").alias(id_col), "item_id", "score", "question_overlap", "answer_overlap"))


def _searcher(shared, threshold: float, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch, texts in text_blocks(batches, "text"):
            hits = list(index.search(texts, threshold, overlap))
            ids = batch.column("id").to_pylist()
            yield pa.RecordBatch.from_pydict({
                "id": pa.array([ids[h[0]] for h in hits], pa.int64()),
                "key": pa.array([index.ids[h[1]] for h in hits], pa.string()),
                **{name: pa.array([h[k] for h in hits], pa.float64())
                   for k, name in ((2, "score"), (3, "question_overlap"), (4, "answer_overlap"))}})

    return run


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """``docs`` without the documents that hold an item; all columns as they were.

    Rows with the same id go together.  Rows with a null id stay unless such a row holds an item.
    """
    own = unused(docs, "_found")
    found = stored(find_items(docs, items, id_col=id_col, text_col=text_col, **options)
                   .select(F.col(id_col).alias(own)).distinct(), "contaminated")
    return docs.join(found, F.col(id_col).cast("long").eqNullSafe(F.col(own)), "left_anti")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), items_of(table(spark, sf_dir, "benchmark")))
