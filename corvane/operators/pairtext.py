"""Serialised record pairs: ``COL name VAL value ...<TAB>COL ...<TAB>label``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.functions import cleaning
from corvane.functions.analysis import ENGLISH_STOP_WORDS
from corvane.functions.binding import let
from corvane.operators.joins import salted_lookup
from corvane.operators.linkage import LABEL, LEFT, RIGHT

SEGMENT = r"COL (\S+) VAL((?: (?!COL(?: |$))\S+)*+)"
VALID_SIDE = rf"^(?:{SEGMENT}(?: |$))*+$"
PARSED = ("label", "left", "right", "attrs", "reason")


# --- writing ---------------------------------------------------------------------------------
def _side_columns(pairs: DataFrame, suffix: str) -> list[str]:
    return [c for c in pairs.columns if c.endswith(suffix) and "vin" not in c]


def serialise_side(pairs: DataFrame, suffix: str, missing: str | None = None) -> Column:
    """``COL name VAL value`` of every column of a side; VIN columns stay out.  ``missing`` is the
    text of an absent value (the source scripts write ``nan``), by default it is empty."""
    blank = F.lit(missing or "")
    return F.concat_ws(" ", *[
        F.rtrim(F.concat(F.lit(f"COL {c[:-len(suffix)]} VAL "),
                         F.coalesce(cleaning.strict_clean(F.col(c)), blank)))
        for c in _side_columns(pairs, suffix)])


def serialise_pairs(pairs: DataFrame, missing: str | None = None) -> Column:
    left, right = _side_columns(pairs, LEFT), _side_columns(pairs, RIGHT)
    if not left or len(left) != len(right):
        raise ValueError(f"the sides have {len(left)} and {len(right)} columns")
    return F.concat_ws("\t", serialise_side(pairs, LEFT, missing),
                       serialise_side(pairs, RIGHT, missing), F.col(LABEL).cast("int").cast("string"))


def json_pair(pairs: DataFrame) -> Column:
    """``[{left}, {right}]`` with loosely cleaned values."""
    def side(suffix: str) -> Column:
        return F.create_map(*[x for c in _side_columns(pairs, suffix) for x in (
            F.lit(c[:-len(suffix)]),
            F.coalesce(cleaning.loose_clean(F.col(c)), F.lit("")))])

    return F.to_json(F.array(side(LEFT), side(RIGHT)))


def serialise_map(entity: Column) -> Column:
    """Attribute map in its own order, with the trailing blank of the pair scorer's input."""
    return F.array_join(F.transform(F.map_entries(entity), lambda e: F.concat(
        F.lit("COL "), e["key"], F.lit(" VAL "), e["value"], F.lit(" "))), "")


def scorer_line(left: Column, right: Column) -> Column:
    """Input line of the pair scorer: both sides, label 0."""
    return F.concat(serialise_map(left), F.lit("\t"), serialise_map(right), F.lit("\t0"))


def sides_as_json(line: Column) -> Column:
    """The first two fields of a line as a JSON array, the input of the pair scorer."""
    return F.to_json(F.slice(F.split(line, "\t"), 1, 2))


# --- reading ---------------------------------------------------------------------------------
def _has_two_tabs(line: Column) -> Column:
    return F.substring_index(line, "\t", 2) != line


def _cut_part(line: Column, part: int) -> Column:
    """Part 1, 2 or 3 of a line with two tabs."""
    tail = F.substring_index(line, "\t", -2)
    if part == 1:
        return F.substring(line, F.lit(1), F.length(line) - F.length(tail) - 1)
    return F.substring_index(tail, "\t", 1 if part == 2 else -1)


def split_line(line: Column, part: int) -> Column:
    """Part 1, 2 or 3 of a line cut at its last two tabs; null without two tabs."""
    return F.when(_has_two_tabs(line), _cut_part(line, part))


def parse_side(side: Column) -> Column:
    """Ordered attr/val structs; null when the side is malformed.  A repeated attribute keeps its
    first place and its last value."""
    def last_values(found: Column) -> Column:
        return F.transform(F.array_distinct(found["attr"]), lambda n: F.struct(
            n.alias("attr"),
            F.element_at(F.filter(found, lambda p: p["attr"] == n), -1)["val"].alias("val")))

    def pairs(text: Column) -> Column:
        names = F.regexp_extract_all(text, F.lit(SEGMENT), F.lit(1))
        values = F.transform(F.regexp_extract_all(text, F.lit(SEGMENT), F.lit(2)), lambda v: F.ltrim(v))
        return F.when(text.rlike(VALID_SIDE), let(F.arrays_zip(names.alias("attr"), values.alias("val")), last_values))

    return let(cleaning.strip(F.regexp_replace(side, r"\s+", " ")), pairs)


def parse_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """Add label, left, right, attrs (attr, v1, v2 in order of appearance) and ``reason`` (null
    for a well-formed line)."""
    def value(side: Column, name: Column) -> Column:
        found = F.get(F.filter(side, lambda x: x["attr"] == name), F.lit(0))["val"]
        return F.coalesce(found, F.lit(""))

    def fields(line: Column, cut: Column) -> Column:
        return F.struct(cut.alias("whole"), F.when(cut, F.trim(_cut_part(line, 3))).try_cast("int").alias("label"),
                        F.when(cut, parse_side(_cut_part(line, 1))).alias("left"),
                        F.when(cut, parse_side(_cut_part(line, 2))).alias("right"))

    def judged(f: Column) -> Column:
        names = F.array_distinct(F.concat(f["left"]["attr"], f["right"]["attr"]))
        attrs = F.transform(names, lambda n: F.struct(
            n.alias("attr"), value(f["left"], n).alias("v1"), value(f["right"], n).alias("v2")))
        reason = (F.when(~f["whole"], "no_three_fields").when(f["label"].isNull(), "bad_label")
                  .when(f["left"].isNull() | f["right"].isNull(), "bad_side"))
        return F.struct(f["label"].alias("label"), f["left"].alias("left"), f["right"].alias("right"),
                        attrs.alias("attrs"), reason.alias("reason"))

    # A generator: the line is parsed once, and a filter on the outcome is not moved below it, where it would parse again.
    line = F.col(column)
    parsed = let(fields(line, _has_two_tabs(line)), judged)
    return lines.select(*[F.col(c) for c in lines.columns if c not in PARSED], F.inline_outer(F.array(parsed)))


def attribute_order(parsed: DataFrame, order: str) -> DataFrame:
    """Distinct attribute names in order of first appearance over all lines."""
    seen = parsed.select(order, F.posexplode_outer("attrs").alias("pos", "a"))
    return (seen.filter(F.col("a").isNotNull()).groupBy(F.col("a.attr").alias("attr"))
            .agg(F.min(F.struct(order, "pos")).alias("first_seen")))


def join_attrs(attrs: Column, label: Column) -> Column:
    """Line of attr/v1/v2 structs; an attribute is written on both sides when either has a value."""
    def side(which: str) -> Column:
        used = F.filter(attrs, lambda a: (a["v1"] != "") | (a["v2"] != ""))
        return F.array_join(F.transform(used, lambda a: F.rtrim(F.concat(
            F.lit("COL "), a["attr"], F.lit(" VAL "), F.trim(a[which])))), " ")

    return F.concat_ws("\t", side("v1"), side("v2"), label.cast("string"))


# --- normalisation of tokens -----------------------------------------------------------------
def is_number_like(token: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(token, r"^[+\-±~]", ""), "[,.]", "")
    return bare.rlike(r"^\d+(/\d+)?$")


def normalise_number(token: Column) -> Column:
    """Integral numbers without decimals, others with two; unreadable ones stay."""
    number = F.when(token.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), token.try_cast("double"))
    text = F.when(number == F.floor(number), number.try_cast("decimal(38,0)").cast("string")) \
        .otherwise(F.format_string("%.2f", number))
    return F.when(is_number_like(token) & number.isNotNull(), text).otherwise(token)


def tag_id(token: Column) -> Column:
    """``ID`` before tokens of seven or more characters with a digit that are no numbers."""
    tagged = ~is_number_like(token) & (F.length(token) >= 7) & token.rlike(r"\p{Nd}")
    return F.when(tagged, F.concat(F.lit("ID "), token)).otherwise(token)


def inject_knowledge(entry: Column) -> Column:
    """Numbers normalised and identifiers tagged in a serialised side."""
    tokens = F.filter(F.split(entry, r"\s+"), lambda t: t != "")
    return F.array_join(F.transform(tokens, lambda t: tag_id(normalise_number(t))), " ")


def inject_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """Both sides of every line; lines without exactly three fields are left out."""
    parts = F.split(F.col(column), "\t")
    return lines.filter(F.size(parts) == 3).withColumn(column, F.concat_ws(
        "\t", inject_knowledge(parts[0]), inject_knowledge(parts[1]), parts[2]))


# --- TF-IDF summary --------------------------------------------------------------------------
VOCAB_PATTERN = r"[\p{L}\p{M}\p{N}_]{2,}"


def entry_idf(lines: DataFrame, column: str = "line") -> DataFrame:
    """Smoothed idf of every word, each side of each line being one entry: word, idf."""
    parts = F.split(F.col(column), "\t")
    entries = lines.filter(F.size(parts) == 3).select(
        F.explode_outer(F.slice(parts, 1, 2)).alias("entry"))
    n = entries.agg(F.count(F.lit(1))).scalar()
    words = F.array_distinct(F.regexp_extract_all(F.lower("entry"), F.lit(VOCAB_PATTERN), F.lit(0)))
    df = (entries.select(F.explode_outer(words).alias("word")).filter(F.col("word").isNotNull())
          .groupBy("word").agg(F.count(F.lit(1)).alias("df")))
    return df.select("word", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"))


def summarise(lines: DataFrame, id_col: str, idf: DataFrame, max_len: int = 128,
              token_length: Column | None = None, column: str = "line") -> DataFrame:
    """id, summary: every line cut to the tokens with the most accumulated idf.

    COL and VAL always stay and count first; per side tokens are taken by weight (ties by text)
    until the budget would overflow; a token is written once, at its first place.  Stop words and
    unknown words weigh nothing and come last.  ``idf`` should be a stored table.  ``token_length`` is an expression over ``token``;
    by default a token has length 1.  All groups lie inside one line.
    """
    length = token_length if token_length is not None else F.lit(1)
    parts = F.split(F.col(column), "\t")
    markers = ["COL", "VAL"]
    kept = lines.filter(F.size(parts) == 3)
    sides = (kept.select(F.col(id_col).alias("id"), F.posexplode(F.slice(parts, 1, 2)).alias("side", "text"))
             .select("id", "side", F.posexplode_outer(F.split("text", " ")).alias("pos", "token")))
    is_marker = F.col("token").isin(markers)
    word = F.lower("token")
    weighed = ~is_marker & ~F.col("token").isin(ENGLISH_STOP_WORDS)
    counted = (sides.filter(~is_marker).groupBy("id", "side", "token")
               .agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first")))
    per_pair = (counted.filter(weighed).groupBy("id", "token", word.alias("word"))
                .agg(F.sum("n").alias("n")))
    weights = (salted_lookup(per_pair, idf, ["word"], ["id"])
               .select("id", "token", (F.col("n") * F.col("idf")).alias("weight")))
    budget = sides.groupBy("id", "side").agg(F.count_if(is_marker).alias("used"))
    ranked = (counted.join(weights, ["id", "token"], "left").join(budget, ["id", "side"])
              .withColumn("weight", F.round(F.coalesce("weight", F.lit(0.0)), 9))
              .withColumn("len", length.cast("long")))
    order = W.partitionBy("id", "side").orderBy(F.desc("weight"), "token")
    chosen = (ranked.withColumn("total", F.col("used") + F.sum("len").over(
        order.rowsBetween(W.unboundedPreceding, W.currentRow)))
        .filter(F.col("total") <= max_len).select("id", "side", F.col("first").alias("pos"), "token"))
    shown = sides.filter(is_marker).select("id", "side", "pos", "token").unionByName(chosen)
    text = (shown.groupBy("id", "side")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("l"))
            .select("id", "side", F.array_join(F.transform("l", lambda x: x["token"]), " ").alias("t")))
    both = text.groupBy("id").agg(
        F.max(F.when(F.col("side") == 0, F.col("t"))).alias("l"),
        F.max(F.when(F.col("side") == 1, F.col("t"))).alias("r"))
    labels = kept.select(F.col(id_col).alias("id"), F.trim(F.get(parts, F.lit(2))).alias("label"))
    return (labels.join(both, "id", "left")
            .select("id", F.concat_ws("\t", F.coalesce("l", F.lit("")), F.coalesce("r", F.lit("")), "label")
                    .alias("summary")))
