"""Text analysis: token arrays from string columns, one analyzer per field."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Analyzer = Callable[[Column], Column]

# Word characters, and the characters that keep a word or a number together when
# they stand between two letters or two digits (Unicode word-break classes MidLetter, MidNum).
WORD = r"[\p{L}\p{M}\p{N}_]+"
MID_LETTER = r"[.:'’·]"
MID_NUMBER = r"[.,;'’]"
TOKEN_PATTERN = (
    rf"{WORD}(?:(?:(?<=\p{{L}}){MID_LETTER}(?=\p{{L}})|(?<=\p{{N}}){MID_NUMBER}(?=\p{{N}})){WORD})*"
)

# The default English stop set of the public Lucene analyzer.
ENGLISH_STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their "
    "then there these they this to was will with"
).split()


def standard_tokens(text: Column) -> Column:
    """Lower-cased words in text order; numbers, abbreviations and contractions stay whole."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def keyword_tokens(text: Column) -> Column:
    """The untouched value as the only token (exact-match fields)."""
    return F.when(text.isNotNull(), F.array(text))


def title_query_tokens(text: Column) -> Column:
    """Query-time analysis of titles: standard words split again at letter/digit edges and at
    inner punctuation, a possessive ending dropped."""
    def parts(token: Column) -> Column:
        bare = F.regexp_replace(token, r"['’]s$", "")
        return F.regexp_extract_all(bare, F.lit(r"[\p{L}\p{M}]+|\p{N}+"), F.lit(0))

    return F.flatten(F.transform(standard_tokens(text), parts))


def english_tokens(text: Column) -> Column:
    """Standard words without possessive ending and stop words, reduced to Porter stems."""
    words = F.transform(standard_tokens(text), lambda t: F.regexp_replace(t, r"['’]s$", ""))
    kept = F.filter(words, lambda t: (t != "") & ~t.isin(ENGLISH_STOP_WORDS))
    return stem_array(kept)


ANALYZERS: dict[str, Analyzer] = {
    "standard": standard_tokens,
    "english": english_tokens,
    "keyword": keyword_tokens,
    "title_query": title_query_tokens,
}


@F.pandas_udf(T.ArrayType(T.StringType()))
def stem_array(tokens: pd.Series) -> pd.Series:
    return tokens.map(lambda row: None if row is None else [porter_stem(t) for t in row])


# --- Porter (1980) ---------------------------------------------------------------------------
# The suffix tables of the published algorithm, longest match first within a step.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize",
    "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def _shape(stem: str) -> str:
    """The stem as a string of c (consonant) and v (vowel); y after a consonant is a vowel."""
    out = ""
    for ch in stem:
        vowel = ch in "aeiou" or (ch == "y" and out.endswith("c"))
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _short_ending(stem: str) -> bool:
    return _shape(stem).endswith("cvc") and stem[-1] not in "wxy"


def _swap_suffix(word: str, table: dict[str, str]) -> str:
    for suffix in sorted(table, key=len, reverse=True):
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            return stem + table[suffix] if _measure(stem) > 0 else word
    return word


@lru_cache(maxsize=200_000)
def porter_stem(word: str) -> str:
    if len(word) < 3:
        return word
    # plural endings
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # past and progressive endings
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            stem = word[: len(word) - len(suffix)]
            if word.endswith(suffix) and "v" in _shape(stem):
                word = stem
                if word.endswith(("at", "bl", "iz")):
                    word += "e"
                elif len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c":
                    word = word if word[-1] in "lsz" else word[:-1]
                elif _measure(word) == 1 and _short_ending(word):
                    word += "e"
                break
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _swap_suffix(word, STEP_2)
    word = _swap_suffix(word, STEP_3)
    for suffix in sorted(STEP_4, key=len, reverse=True):
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem[-1:] in ("s", "t")):
                word = stem
            break
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short_ending(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word
