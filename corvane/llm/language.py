"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import lean, table, text_blocks

BITS = 16
PIECE = 1 << 20
"""A longer text is read in pieces of this many characters, each as if a word ended there."""

_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Lower-case letter of every code point, 0 for what is no letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                _LETTERS[point] = ord(char.lower()[0])
    return _LETTERS


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the 1- to 3-grams of all texts' words, with word ends, in batch form.

    Returns an array of three rows with a bucket or 2^BITS (none) at every place, where the texts
    that have letters begin there, and the numbers of those texts.
    """
    pieces, owner = [], []
    for i, text in enumerate(texts):
        for start in range(0, len(text or ""), PIECE):
            pieces.append(text[start:start + PIECE])
            owner.append(i)
    points = np.frombuffer(("\n" + "\n".join(pieces) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.cumsum([0] + [len(p) + 1 for p in pieces])  # the line end before each piece
    x = _letters()[points]
    keep = x != 0
    keep[0] = True
    keep[1:] |= x[:-1] != 0
    place = np.cumsum(keep) - 1
    x = x[keep]
    first = place[begins]
    full = first[1:] > first[:-1]  # pieces with a letter
    none = np.uint32(1 << BITS)
    y, z = np.append(x[1:], 0).astype(np.uint32), np.append(x[2:], [0, 0])[:len(x)].astype(np.uint32)
    a, b, c = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)

    def bucket(h: np.ndarray, valid: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        return np.where(valid, (h ^ (h >> np.uint32(13))) * np.uint32(0x297A2D39) >> np.uint32(32 - BITS), none)

    two = x * a + y * b
    inside = np.ones(len(x), bool)
    inside[-1] = False
    grams = np.stack([bucket(x * a + np.uint32(1), x != 0), bucket(two + np.uint32(2), inside),
                      bucket(two + z * c + np.uint32(3), (y != 0) & inside)])
    return grams, first[:-1][full], np.array(owner, np.int64)[full]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = 20_000, smoothing: float = 0.1, most: int = 200) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities: a row per language, a column per bucket, then the prior.

    Learns from the rows with a language, or from a sample of about ``sample`` of them by a hash of
    the id where there are more.  The counts, at most ``most`` x 2^BITS numbers, go to the driver.
    """
    labelled = docs.filter(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = labelled.count()
    chosen = labelled.filter(F.pmod(F.xxhash64("id"), F.lit(max(rows, 1))) < sample)
    width = (1 << BITS) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch, texts in text_blocks(batches, "text"):
            langs = batch.column("lang").to_pylist()
            grams, first, owner = features(texts)
            ends = np.append(first[1:], grams.shape[1])
            for lang in set(langs):
                total = totals.setdefault(lang, np.zeros(width + 1, np.int64))
                total[width] += langs.count(lang)
            for a, b, i in zip(first.tolist(), ends.tolist(), owner.tolist()):
                totals[langs[i]][:width] += np.bincount(grams[:, a:b].ravel(), minlength=width)
            if len(totals) > most:
                yield from _emit(totals)
                totals = {}
        yield from _emit(totals)

    sums = (chosen.mapInArrow(lean(count), "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    found = sums.toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    if len(langs) > most:
        raise ValueError(f"{len(langs)} languages; the model is bounded to {most}")
    counts = np.zeros((len(langs), width + 1))
    at = {lang: i for i, lang in enumerate(langs)}
    counts[[at[x] for x in found.column("lang").to_pylist()], found.column("bucket").to_numpy()] = \
        found.column("n").to_numpy()
    model = np.zeros_like(counts)
    if langs:
        grams = counts[:, :width - 1] + smoothing
        model[:, :width - 1] = np.log(grams / grams.sum(axis=1, keepdims=True))
        model[:, width] = np.log(counts[:, width] / counts[:, width].sum())
    return langs, model


def _emit(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        at = at[at != 1 << BITS]
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()),
                                          "bucket": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})


def score(texts: list[str | None], langs: list[str], model: np.ndarray) -> tuple[list[str], list[float], list[float | None]]:
    """Best language, its posterior and fit for each text; und, 0 and null without a letter or a language.

    The fit is the mean log probability of the text's n-grams in that language less the mean that the
    language's own n-grams have: near 0 for its texts of any length, far below for what is none.
    """
    grams, first, owner = features(texts)
    own = (np.exp(model[:, :1 << BITS]) * model[:, :1 << BITS]).sum(axis=1)
    counts = np.add.reduceat((grams < 1 << BITS).sum(axis=0), first) if len(first) else []
    sizes = np.zeros(len(texts))
    np.add.at(sizes, owner, counts)
    sums = np.zeros((len(langs), len(texts)))
    if len(first):
        for row, weights in zip(sums, model):
            at = weights[grams[0]] + weights[grams[1]] + weights[grams[2]]
            np.add.at(row, owner, np.add.reduceat(at, first))
    read = np.zeros(len(texts), bool)
    read[owner] = bool(langs)
    names, values, fits = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)
    for i in np.flatnonzero(read):
        posterior = sums[:, i] + model[:, -1]
        best = int(posterior.argmax())
        names[i] = langs[best]
        values[i] = float(1 / np.exp(posterior - posterior[best]).sum())
        fits[i] = float(sums[best, i] / sizes[i] - own[best])
    return names, values, fits


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text",
             pred_col: str = "lang_pred", score_col: str = "score", fit_col: str | None = None) -> DataFrame:
    """``docs`` (columns as they are) with the predicted language, its score and, if asked, its fit (see ``score``).

    Columns that have these names already are replaced.

    The prediction reads the whole text and nothing else.  A text that is null or has no letter is
    ``und`` with score 0, as is every text when no language was learned.  Ties go to the first
    language by name.  The matrix is broadcast; its size is bounded by ``train``.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    added = [pred_col, score_col, *([] if fit_col is None else [fit_col])]
    docs = docs.drop(*added)
    fields = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, weights = shared.value
        for batch, texts in text_blocks(batches, text_col):
            names, *values = score(texts, langs, weights)
            numbers = [pa.array(v, pa.float64()) for v in values[:len(added) - 1]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), *numbers], names=[*fields, *added])

    schema = T.StructType([*docs.schema, T.StructField(pred_col, T.StringType()),
                           *[T.StructField(c, T.DoubleType()) for c in added[1:]]])
    return docs.mapInArrow(lean(run), schema)


def held_out(id_col: str = "doc_id") -> Column:
    """A third of the documents, by the CRC-32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
