"""Quality filter for synthetic pairs, with thresholds from the data."""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import cleaning
from corvane.functions.binding import let, occurrence_runs
from corvane.operators.joins import salted_lookup
from corvane.operators.pairtext import split_line
from corvane.session import lean, materialise, small_batches

# Sizes and patterns of the quality filter.
NGRAM = 3            # n-gram size of the repetition statistic
VOCABULARY = 10_000  # size of the TF-IDF vocabulary, a fixed value: its table may be broadcast
MIN_DF = 2
HEAD = 50_000        # words of the frequency list, the most frequent, that the task of a text looks up; all others are joined
TALLY = 200_000      # distinct words that a task counts before it hands the counts on
REST_OF_SIDE = r"COL\s+(.+?)\s+VAL\s+([^\t]+)"
ONE_VALUE = r"COL\s+(.+?)\s+VAL\s+((?:(?!\sCOL\s)[^\t])+)"
CONTROL = r"[\x00-\x1F\x7F]"


def full_text(line: Column) -> Column:
    return F.concat_ws(" ", split_line(line, 1), split_line(line, 2))


def unbalanced_brackets(text: Column) -> Column:
    brackets = F.regexp_replace(text, r"[^()\[\]{}]+", "")  # one search, and little is left to count

    def count(ch: str) -> Column:
        return F.length(brackets) - F.length(F.replace(brackets, F.lit(ch), F.lit("")))

    return (count("(") != count(")")) | (count("[") != count("]")) | (count("{") != count("}"))


def value_lengths(line: Column, per_value: bool = False) -> Column:
    """Lengths of the VAL texts.  By default a value runs to the end of its side, as the source
    pattern does; ``per_value`` stops at the next COL."""
    pattern = ONE_VALUE if per_value else REST_OF_SIDE
    return F.transform(F.regexp_extract_all(line, F.lit(pattern), F.lit(2)),
                       lambda v: F.length(cleaning.strip(v)).cast("long"))


def ngrams(text: Column, n: int) -> Column:
    """n-grams of lower-cased ASCII letters and digits, as one array per text."""
    def build(words: Column) -> Column:
        shifted = [F.slice(words, i + 1, F.size(words)) for i in range(n)]
        zipped = F.arrays_zip(*[s.alias(str(i)) for i, s in enumerate(shifted)])
        whole = F.slice(zipped, 1, F.greatest(F.size(words) - n + 1, F.lit(0)))
        return F.transform(whole, lambda z: F.concat_ws(" ", *[z[str(i)] for i in range(n)]))

    # bound: a text is searched once, not for every use of its words
    return let(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)), build)


def repetition(text: Column, n: int) -> Column:
    """How often the most frequent n-gram of a text occurs (0 without any), counted inside the
    row."""
    runs = occurrence_runs(F.sort_array(ngrams(text, n)), lambda x: x, lambda items, at, size: size)
    return F.coalesce(F.array_max(runs), F.lit(0)).cast("long")


def repeats_ngram(lines: DataFrame, id_col: str, n: Column, column: str = "line") -> DataFrame:
    """id, repeated: whether a line holds some n-gram of size ``n`` twice; never for n = 0."""
    texts = lines.select(F.col(id_col).alias("id"), F.lower(full_text(cleaning.canonical_line(F.col(column)))).alias("text"),
                         n.cast("int").alias("n"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("text").to_pylist(), batch.column("n").to_pylist())
            found = [_repeats(GRAM_WORDS.findall(text), size or 0) for text, size in rows]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.bool_())], names=["id", "repeated"])

    return _in_batches(texts, judged, texts.schema["id"], T.StructField("repeated", T.BooleanType()))


def _repeats(words: list[str], n: int) -> bool:
    """Whether ``n`` words in a row occur twice.  Windows grow by joining two smaller ones, and windows that
    are all distinct stay so, however far they grow."""
    if n < 1 or len(words) <= n:
        return False
    size = min(n, NGRAM)
    windows = list(zip(*(words[i:] for i in range(size))))
    codes = dict.fromkeys(windows)
    if len(codes) == len(windows) or size == n:
        return len(codes) < len(windows)
    number = {w: i for i, w in enumerate(codes)}
    code = np.array([number[w] for w in windows], np.int64)
    while size < n:
        step = min(size, n - size)
        pairs = code[:-step] * (int(code.max()) + 1) + code[step:]
        distinct, code = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return False
        size += step
    return True


def _in_batches(df: DataFrame, run: Callable, *fields: T.StructField) -> DataFrame:
    """``run`` over small Arrow batches of ``df``."""
    small_batches(df.sparkSession)
    return df.mapInArrow(lean(run), T.StructType(list(fields)))


def alphabetic(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))


def word_frequencies(texts: DataFrame, column: str) -> DataFrame:
    """word, zipf of a reference corpus: log10 of the occurrences per billion words."""
    words = (texts.select(F.explode_outer(alphabetic(F.col(column))).alias("word"))
             .filter(F.col("word").isNotNull())
             .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    total = words.agg(F.sum("n")).scalar()
    return words.select("word", F.round(F.log10(F.col("n") / total * 1e9), 2).alias("zipf"))


def dictionary_scores(texts: DataFrame, id_col: str, text: Column, frequencies: DataFrame) -> DataFrame:
    """id, n_words, hit_rate (1 without words), mean_zipf (0 without words); ``frequencies`` should
    be a stored table."""
    known = _dictionary(frequencies)
    read = _read(texts.select(F.col(id_col).alias("id"), F.lower(text).alias("text")), known)
    return _dictionary_scores(read if known.whole else materialise(read), known).select("id", "n_words", "hit_rate", "mean_zipf")


@dataclass
class _Dictionary:
    """word, n (its rows), z (the sum of their zipf) of a frequency list, and the first ``HEAD`` words by z."""

    words: DataFrame
    head: dict[str, tuple[int, float]]
    whole: bool  # no word lies outside the head


def _dictionary(frequencies: DataFrame) -> _Dictionary:
    words = (frequencies.filter("zipf > 0 AND word IS NOT NULL").groupBy("word")
             .agg(F.count(F.lit(1)).alias("rows"), F.sum("zipf").alias("z")))
    first = words.orderBy(F.desc("z"), "word").limit(HEAD).toArrow().to_pydict()
    head = dict(zip(first["word"], zip(first["rows"], first["z"])))
    return _Dictionary(words, head, len(head) < HEAD)


def _dictionary_scores(read: DataFrame, known: _Dictionary) -> DataFrame:
    """The texts of ``_read`` with hit_rate and mean_zipf; words outside the head of the dictionary are joined."""
    hits, z = F.col("hits"), F.col("z")
    if not known.whole:
        more = (salted_lookup(read.select("id", F.inline("rest")), known.words, ["word"], ["id"]).groupBy("id")
                .agg(F.sum(F.col("n") * F.col("rows")).alias("_hits"), F.sum(F.col("n") * F.col("z")).alias("_z")))
        read = read.join(more, "id", "left")
        hits, z = hits + F.coalesce("_hits", F.lit(0)), z + F.coalesce("_z", F.lit(0.0))
    some = F.col("n_words") > 0
    return read.withColumn("hit_rate", F.when(some, hits / F.col("n_words")).otherwise(1.0)) \
        .withColumn("mean_zipf", F.when(some, z / F.col("n_words")).otherwise(0.0))


def tfidf_means(texts: DataFrame, id_col: str, text: Column, fit_on: Column | None = None) -> DataFrame:
    """id, tfidf: mean weight over all vocabulary cells of a text.

    Vocabulary: words in two or more fitted texts, the 10,000 most frequent (ties by word); smooth
    idf; every text normalised to length 1.
    """
    rows = texts.select(F.col(id_col).alias("id"), (fit_on if fit_on is not None else F.lit(True)).alias("fit"), F.lower(text).alias("text"))
    return _tfidf_means(rows.select("id", "text"), materialise(_read(rows)))


def _tfidf_means(texts: DataFrame, read: DataFrame) -> DataFrame:
    """``tfidf_means`` of texts in lower case (id, text) with the vocabulary counted by ``_read``."""
    n = read.agg(F.count_if("fit")).first()[0]
    vocabulary = (read.filter("word IS NOT NULL").groupBy("word").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
                  .filter(F.col("df") >= MIN_DF).orderBy(F.desc("total"), "word").limit(VOCABULARY).toArrow().to_pydict())
    size = len(vocabulary["word"])
    sent = texts.sparkSession.sparkContext.broadcast(
        {w: math.log((1 + n) / (1 + df)) + 1 for w, df in zip(vocabulary["word"], vocabulary["df"])})  # at most VOCABULARY words
    word_class = _word_class()

    def mean(words: list[str], idf: dict[str, float]) -> float:
        cells = [tf * idf[w] for w, tf in Counter(words).items() if w in idf]
        return sum(cells) / math.sqrt(sum(w * w for w in cells)) / size if cells else 0.0

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            means = [mean(_vocabulary_words(text or "", word_class), sent.value) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(means, pa.float64())], names=["id", "tfidf"])

    return _in_batches(texts, weighed, texts.schema["id"], T.StructField("tfidf", T.DoubleType()))


# --- one reading of a text ---------------------------------------------------------------------
GRAM_WORDS, ALPHABETIC, ASCII_WORDS = re.compile("[a-z0-9]+"), re.compile("[a-z]+"), re.compile("[A-Za-z0-9_]{2,}")
ABOVE_BMP = re.compile("[\U00010000-\U0010ffff]")


@lru_cache
def _word_class() -> tuple[str, str]:
    """The words of ``VOCAB_PATTERN`` as patterns of ``re``, which has no classes by name: for texts in the basic
    plane, which are searched by a bitmap, and for all texts."""
    def ranges(codes: range) -> str:
        inside = [c for c in codes if c == ord("_") or unicodedata.category(chr(c))[0] in "LMN"]
        starts = [c for i, c in enumerate(inside) if not i or c != inside[i - 1] + 1]
        ends = [c for i, c in enumerate(inside) if i + 1 == len(inside) or c + 1 != inside[i + 1]]
        return "".join(f"{chr(a)}-{chr(z)}" for a, z in zip(starts, ends))

    basic = ranges(range(0x10000))
    return f"[{basic}]{{2,}}", f"[{basic}{ranges(range(0x10000, sys.maxunicode + 1))}]{{2,}}"


def _vocabulary_words(text: str, word_class: tuple[str, str], gram_words: list[str] | None = None) -> list[str]:
    """The words of ``VOCAB_PATTERN``; in plain texts these are the ``gram_words``, if given, of two letters or more."""
    if not text.isascii():
        return re.findall(word_class[ABOVE_BMP.search(text) is not None], text)
    if gram_words is None or "_" in text:
        return ASCII_WORDS.findall(text)
    return [w for w in gram_words if len(w) > 1]


REST = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())]))
READ = [T.StructField(name, kind) for name, kind in (
    ("repetition", T.LongType()), ("n_words", T.LongType()), ("hits", T.LongType()), ("z", T.DoubleType()), ("rest", REST),
    ("word", T.StringType()), ("df", T.LongType()), ("total", T.LongType()))]


def _read(texts: DataFrame, known: _Dictionary | None = None) -> DataFrame:
    """Texts in lower case (``text``), each searched once, with their other columns: ``repetition``, ``n_words``, and
    with ``known`` hits and z of the words in its head and the ``rest`` of its words.

    With a column ``fit`` also rows of the vocabulary (``word``, its ``df`` and ``total`` in texts that fit): a task
    hands on what it has counted whenever it holds ``TALLY`` words.
    """
    spark, others = texts.sparkSession, [T.StructField(f.name, f.dataType) for f in texts.schema if f.name != "text"]
    names, fits = [f.name for f in others], "fit" in texts.columns
    whole = known is None or known.whole
    sent = spark.sparkContext.broadcast(known.head if known else {})  # at most HEAD words
    word_class = _word_class()
    ints, floats, strings = pa.int64(), pa.float64(), pa.string()
    rest_type = pa.list_(pa.struct([("word", strings), ("n", ints)]))

    def measured(text: str | None, head: dict, rest: dict[str, list]) -> tuple[tuple, list[str]]:
        if text is None:
            return (0, None, 0, 0.0), []
        words = GRAM_WORDS.findall(text)
        grams = list(zip(*(words[i:] for i in range(NGRAM))))
        repetition = 1 if len(set(grams)) == len(grams) else max(Counter(grams).values())
        hits, z, n_words = 0, 0.0, 0
        for gram_word, n in Counter(words).items():
            for word in (gram_word,) if gram_word.isalpha() else ALPHABETIC.findall(gram_word):
                n_words += n
                found = head.get(word)
                if found is not None:
                    hits += n * found[0]
                    z += n * found[1]
                elif not whole:
                    rest["word"].append(word)
                    rest["n"].append(n)
        return (repetition if grams else 0, n_words, hits, z), words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total, types = Counter(), Counter(), []

        def tally() -> pa.RecordBatch:
            words = list(total)
            found = [pa.array(words, strings), pa.array([df[w] for w in words], ints), pa.array(total.values(), ints)]
            empty = [pa.nulls(len(words), t) for t in (*types, ints, ints, ints, floats, rest_type)]
            df.clear(), total.clear()
            return pa.RecordBatch.from_arrays([*empty, *found], names=[*names, *(f.name for f in READ)])

        for batch in batches:
            types, texts = [batch.column(c).type for c in names], batch.column("text").to_pylist()
            fitted = batch.column("fit").to_pylist() if fits else [False] * len(texts)
            found, rest, cut = [], {"word": [], "n": []}, [0]
            for text, fit in zip(texts, fitted):
                counts, words = measured(text, sent.value, rest)
                found.append(counts)
                cut.append(len(rest["n"]))
                if fit and text is not None:
                    words = _vocabulary_words(text, word_class, words)
                    df.update(set(words))
                    total.update(words)
                    if len(total) >= TALLY:
                        yield tally()
            counts = [pa.array([row[i] for row in found], t) for i, t in enumerate((ints, ints, ints, floats))]
            words = pa.StructArray.from_arrays([pa.array(rest["word"], strings), pa.array(rest["n"], ints)], ["word", "n"])
            none = [pa.nulls(len(texts), t) for t in (strings, ints, ints)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *counts, pa.ListArray.from_arrays(pa.array(cut, pa.int32()), words), *none],
                names=[*names, *(f.name for f in READ)])
        if total:
            yield tally()

    return _in_batches(texts, run, *others, *READ)


@dataclass
class Thresholds:
    """Fixed cut-offs; None is derived from the data as mean plus or minus delta deviations."""

    max_length: int | None = None
    max_dup_ngrams: int | None = None
    min_tfidf: float | None = None
    min_dict_hit_rate: float | None = None
    min_zipf: float | None = None
    delta: float = 2.0
    only_label_1: bool = False


def line_features(lines: DataFrame, id_col: str, frequencies: DataFrame, options: Thresholds,
                  column: str = "line") -> DataFrame:
    """Narrow table of per-line measures; the line text is not carried along.

    Every line is searched and counted in one pass, whose measures and counts of the vocabulary are kept; a
    second pass weighs its words.  No words of a line are kept or dealt, but those outside the head of the dictionary."""
    line, text, label = F.col("_line"), F.col("_text"), F.col("label")
    canon = (lines.select(F.col(id_col).alias("id"), cleaning.canonical_line(F.col(column)).alias("_line"))
             .withColumn("_text", full_text(line)).withColumn("label", F.trim(split_line(line, 3))))
    in_scope = label.isNotNull() & ((label == "1") | F.lit(not options.only_label_1))
    basic = canon.withColumn("_lengths", value_lengths(line))
    lengths, zero = F.col("_lengths"), F.lit(0).cast("long")
    basic = basic.select(
        "id", "label", in_scope.alias("in_scope"),
        F.coalesce(F.array_max(lengths), F.lit(0)).alias("longest"),
        F.size(lengths).cast("long").alias("n_values"),
        F.aggregate(lengths, zero, lambda a, x: a + x).alias("length_sum"),
        F.aggregate(lengths, zero, lambda a, x: a + x * x).alias("length_sq"),
        text.rlike(CONTROL).alias("control"), unbalanced_brackets(text).alias("unbalanced"),
        F.md5(line).alias("line_md5"), F.coalesce(in_scope, F.lit(False)).alias("fit"), F.lower(text).alias("text"))
    known = _dictionary(frequencies)
    read = materialise(_read(basic, known))
    measured = _dictionary_scores(read.filter("word IS NULL"), known).drop("fit", "hits", "z", "_hits", "_z", "rest", "word", "df", "total")
    return measured.join(_tfidf_means(canon.select("id", F.lower(text).alias("text")), read), "id")


def auto_thresholds(features: DataFrame, options: Thresholds) -> DataFrame:
    """One row of cut-offs: max_length, max_dup_ngrams, min_tfidf, min_dict_hit_rate, min_zipf."""
    scoped = features.filter("in_scope")

    def cut(measure: str, sign: int) -> Column:
        spread = F.when(F.count(measure) >= 2, F.stddev_samp(measure)).otherwise(0.0)
        return F.coalesce(F.avg(measure) + sign * options.delta * spread, F.lit(0.0))

    n, s, q = (F.sum(c).cast("double") for c in ("n_values", "length_sum", "length_sq"))
    mean = s / n
    spread = F.when(n >= 2, F.sqrt(F.greatest(q - n * mean * mean, F.lit(0.0)) / (n - 1))).otherwise(0.0)
    longest = F.coalesce(F.when(n > 0, mean + options.delta * spread), F.lit(0.0))
    auto = {
        "max_length": F.when(longest.cast("long") == 0, 1).otherwise(longest.cast("long")),
        "max_dup_ngrams": F.greatest(F.lit(0), cut("repetition", 1).cast("long")),
        "min_tfidf": cut("tfidf", -1),
        "min_dict_hit_rate": F.greatest(F.lit(0.0), cut("hit_rate", -1)),
        "min_zipf": F.greatest(F.lit(0.0), cut("mean_zipf", -1)),
    }
    return scoped.agg(*[
        (auto[k] if getattr(options, k) is None else F.lit(getattr(options, k))).alias(k) for k in auto])


def judge(features: DataFrame, thresholds: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """Features (with ``repeated`` from repeats_ngram) plus kept and reasons.  Only label-1 lines
    that are not in ``originals`` (line_md5) are tested."""
    cut = {c: thresholds.select(c).scalar() for c in thresholds.columns}
    checks = {
        "too_long": F.col("longest") > cut["max_length"],
        "control_char": F.col("control"),
        "unbalanced_brackets": F.col("unbalanced"),
        "dup_ngrams": F.col("repeated"),
        "low_tfidf": (cut["min_tfidf"] > 0) & (F.col("tfidf") < cut["min_tfidf"]),
        "low_dict_hit": F.col("hit_rate") < cut["min_dict_hit_rate"],
        "low_zipf_entropy": F.col("mean_zipf") < cut["min_zipf"],
    }
    found = F.array_compact(F.array(*[F.when(test, name) for name, test in checks.items()]))
    if originals is None:
        marked = features.withColumn("original", F.lit(False))
    else:
        known = originals.select("line_md5").distinct().withColumn("original", F.lit(True))
        marked = features.join(known, "line_md5", "left").withColumn("original", F.coalesce("original", F.lit(False)))
    none = F.array().cast("array<string>")
    reasons = (F.when(F.col("original"), none).when(F.col("label").isNull(), F.array(F.lit("bad_format")))
               .when(F.col("label") == "1", found).otherwise(none))
    return marked.withColumn("reasons", reasons).withColumn("kept", F.size("reasons") == 0)


def filter_lines(lines: DataFrame, id_col: str, frequencies: DataFrame,
                 originals: DataFrame | None = None, options: Thresholds | None = None,
                 column: str = "line") -> DataFrame:
    """Verdict per line: id, label, original, kept, reasons.

    As in the source rule, the derived repetition bound is the size of the n-grams that must not
    occur twice.
    """
    options = options or Thresholds()
    features = materialise(line_features(lines, id_col, frequencies, options, column))
    thresholds = materialise(auto_thresholds(features, options))
    size = thresholds.select("max_dup_ngrams").scalar()
    repeated = repeats_ngram(lines, id_col, size, column)
    return judge(features.join(repeated, "id"), thresholds, originals).select(
        "id", "label", "original", "kept", "reasons")


def route_lines(lines: DataFrame, id_col: str, verdicts: DataFrame) -> DataFrame:
    """Lines with kept and reasons, for the two-way output."""
    return lines.join(verdicts.select(F.col("id").alias(id_col), "kept", "reasons"), id_col)
