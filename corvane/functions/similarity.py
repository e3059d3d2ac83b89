"""Similarity of two column values, and phonetic codes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Soundex letter classes.
SOUNDEX_LETTERS = "BFPVCGJKQSXZDTLMNR"
SOUNDEX_DIGITS = "111122222222334556"


def soundex(text: Column) -> Column:
    """Four-character soundex code, also for values that start with a digit.

    The first character is kept as it is; h and w do not separate equal codes, every other
    uncoded character does.
    """
    upper = F.upper(text)
    joined = F.concat(F.substring(upper, 1, 1),
                      F.regexp_replace(F.substring(upper, 2, 2 ** 30), "[HW]", ""))
    codes = F.translate(F.regexp_replace(joined, "[^A-Z]", "0"), SOUNDEX_LETTERS, SOUNDEX_DIGITS)
    codes = F.regexp_replace(F.regexp_replace(codes, "[^1-6]", "0"), r"([1-6])\1+", "$1")
    digits = F.replace(F.substring(codes, 2, 2 ** 30), F.lit("0"), F.lit(""))
    return F.when(text != "", F.concat(F.substring(upper, 1, 1), F.rpad(digits, 3, "0")))


def exact(a: Column, b: Column) -> Column:
    """1 when equal, 0 when different or missing."""
    return F.coalesce((a == b).cast("double"), F.lit(0.0))


def gauss(a: Column, b: Column, offset: float, scale: float) -> Column:
    """1 inside the offset, halved at offset+scale; 0 when missing."""
    d = F.abs(a.cast("double") - b.cast("double"))
    fall = F.pow(F.lit(2.0), -F.pow((d - offset) / scale, F.lit(2.0)))
    return F.coalesce(F.when(d <= offset, 1.0).otherwise(fall), F.lit(0.0))


def log_price_distance(a: Column, b: Column) -> Column:
    """Distance of two positive prices on a log scale; null when missing."""
    return F.when((a > 0) & (b > 0), F.abs(F.log10(a) - F.log10(b)))


def jaro(a: str, b: str) -> float:
    """Jaro similarity.  Per character of ``b`` a pointer moves only forward, so long texts cost
    linear time."""
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    where: dict[str, list[int]] = {}
    for j, ch in enumerate(b):
        where.setdefault(ch, []).append(j)
    upto = dict.fromkeys(where, 0)
    taken: list[int] = []
    kept: list[str] = []
    for i, ch in enumerate(a):
        places = where.get(ch)
        if places is None:
            continue
        k = upto[ch]
        while k < len(places) and places[k] < i - reach:
            k += 1
        if k < len(places) and places[k] <= i + reach:
            taken.append(places[k])
            kept.append(ch)
            k += 1
        upto[ch] = k
    m = len(kept)
    if m == 0:
        return 0.0
    moved = sum(x != b[j] for x, j in zip(kept, sorted(taken))) // 2
    return (m / len(a) + m / len(b) + (m - moved) / m) / 3


def jaro_winkler_value(a: str, b: str) -> float:
    score = jaro(a, b)
    if score > 0.7:
        same = 0
        for x, y in zip(a[:4], b[:4]):
            if x != y:
                break
            same += 1
        score += same * 0.1 * (1 - score)
    return score


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity; null when a side is missing.  Repeated pairs of a batch are
    computed once."""
    done: dict[tuple[str, str], float] = {}
    out = []
    for pair in zip(a, b):
        if pair[0] is None or pair[1] is None:
            out.append(None)
            continue
        if pair not in done:
            done[pair] = jaro_winkler_value(*pair)
        out.append(done[pair])
    return pd.Series(out, dtype="float64")


def string_match(a: Column, b: Column, threshold: float = 0.6) -> Column:
    """1 when Jaro-Winkler reaches the threshold, 0 when below or missing."""
    return F.coalesce((jaro_winkler(a, b) >= threshold).cast("double"), F.lit(0.0))
