"""Augmentation of serialised pairs, token by token.

A pair is ``left [SEP] right``.  Every random choice is a hash of the row id, the operation and a
slot, so a result does not depend on partitions or retries.  COL, VAL and the separators are never
touched by the token operations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.operators import ordinals

# Markers of a serialised pair, inserted symbols, size of a short column, operations
# that ``all`` draws from.
SEPARATOR = "[SEP]"
HEADS = ["COL", "VAL"]
SEPARATORS = ["[CLS]", SEPARATOR]
SYMBOLS = "-*.,#&"
SHORT_COLUMN = 8
COMBINED = ["del", "swap", "drop_col", "append_col"]


def draw(row_id: Column, seed: int, op: str, slot, n: Column | int) -> Column:
    """A number in [0, n) fixed by the row, the seed, the operation and the slot."""
    slot = slot if isinstance(slot, Column) else F.lit(slot)
    text = F.concat_ws("|", F.lit(f"{seed}|{op}"), row_id.cast("string"), slot.cast("string"))
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    n = n if isinstance(n, Column) else F.lit(n)
    return F.when(n > 0, number % F.greatest(n, F.lit(1))).cast("int")


def _is_value(token: Column) -> Column:
    return ~token.isin(HEADS + SEPARATORS)


def _indices(tokens: Column) -> Column:
    return F.when(F.size(tokens) > 0, F.sequence(F.lit(0), F.size(tokens) - 1))


def _spans(tokens: Column, length: Column) -> Column:
    """Starts of runs of ``length`` value tokens."""
    return F.filter(_indices(tokens), lambda i: (i + length <= F.size(tokens)) & F.forall(
        F.slice(tokens, i + 1, length), _is_value))


def _value_places(tokens: Column) -> Column:
    return F.filter(_indices(tokens), lambda i: _is_value(F.get(tokens, i)))


def _cut(tokens: Column, start: Column, length: Column, middle: Column) -> Column:
    """Tokens with ``length`` tokens from ``start`` replaced by ``middle``."""
    return F.concat(F.slice(tokens, 1, start), middle,
                    F.slice(tokens, start + length + 1, F.size(tokens)))


def _nothing() -> Column:
    return F.array().cast("array<string>")


Step = Callable[[DataFrame, int, str], DataFrame]


def delete_span(df: DataFrame, seed: int, op: str = "del") -> DataFrame:
    """Remove a span of one or two value tokens."""
    out = df.withColumn("_len", draw(F.col("_id"), seed, "del", "len", 2) + 1)
    out = out.withColumn("_cand", _spans(F.col("_t"), F.col("_len")))
    out = out.withColumn("_at", F.get("_cand", draw(F.col("_id"), seed, "del", "at", F.size("_cand"))))
    changed = _cut(F.col("_t"), F.col("_at"), F.col("_len"), _nothing())
    return out.withColumn("_t", F.coalesce(changed, "_t")).drop("_len", "_cand", "_at")


def swap_span(df: DataFrame, seed: int, op: str = "swap") -> DataFrame:
    """Reorder a span of two to four value tokens by hash."""
    out = df.withColumn("_len", draw(F.col("_id"), seed, "swap", "len", 3) + 2)
    out = out.withColumn("_cand", _spans(F.col("_t"), F.col("_len")))
    out = out.withColumn("_at", F.get("_cand", draw(F.col("_id"), seed, "swap", "at", F.size("_cand"))))
    span = F.slice("_t", F.col("_at") + 1, F.col("_len"))
    mixed = F.transform(F.sort_array(F.transform(span, lambda t, i: F.struct(
        F.md5(F.concat_ws("|", F.lit(f"{seed}|swap"), F.col("_id").cast("string"), i.cast("string")))
        .alias("h"), t.alias("t")))), lambda x: x["t"])
    changed = _cut(F.col("_t"), F.col("_at"), F.col("_len"), mixed)
    return out.withColumn("_t", F.coalesce(changed, "_t")).drop("_len", "_cand", "_at")


def drop_length(df: DataFrame, seed: int, op: str = "drop_len") -> DataFrame:
    """Drop the value tokens that are as long as a drawn one."""
    values = F.filter("_t", _is_value)
    size = F.size(F.col("_values"))
    target = F.length(F.get("_values", draw(F.col("_id"), seed, "drop_len", "len", size)))
    out = df.withColumn("_values", values).withColumn("_target", target)
    kept = F.filter("_t", lambda t: ~_is_value(t) | (F.length(t) != F.col("_target")))
    return out.withColumn("_t", F.when(F.col("_target").isNotNull(), kept).otherwise(F.col("_t"))) \
        .drop("_values", "_target")


def drop_symbols(df: DataFrame, seed: int, op: str = "drop_sym") -> DataFrame:
    """In one of five value tokens, replace everything but letters and digits by blanks."""
    def change(t: Column, i: Column) -> Column:
        hit = _is_value(t) & (draw(F.col("_id"), seed, "drop_sym", i, 5) == 0)
        return F.when(hit, F.regexp_replace(t, r"[^\p{L}\p{N}]", " ")).otherwise(t)

    return df.withColumn("_t", F.transform("_t", change))


def drop_shared(df: DataFrame, seed: int, op: str = "drop_same") -> DataFrame:
    """Drop one drawn token that both sides have, everywhere."""
    at = F.array_position("_t", F.lit(SEPARATOR)).cast("int")
    lowered = lambda a: F.transform(F.filter(a, _is_value), F.lower)
    left = F.slice("_t", 1, F.greatest(F.col("_sep") - 1, F.lit(0)))
    right = F.slice("_t", F.col("_sep") + 1, F.size("_t"))
    same = F.sort_array(F.array_intersect(lowered(left), lowered(right)))
    out = df.withColumn("_sep", F.when(at > 0, at)).withColumn("_same", same)
    out = out.withColumn("_target", F.get("_same", draw(F.col("_id"), seed, "drop_same", "t", F.size("_same"))))
    kept = F.filter("_t", lambda t: ~_is_value(t) | (F.lower(t) != F.col("_target")))
    return out.withColumn("_t", F.when(F.col("_target").isNotNull(), kept).otherwise(F.col("_t"))) \
        .drop("_sep", "_same", "_target")


def drop_tokens(df: DataFrame, seed: int, op: str = "drop_token") -> DataFrame:
    """Drop every value token with probability one in five."""
    return df.withColumn("_t", F.filter("_t", lambda t, i: ~_is_value(t) | (
        draw(F.col("_id"), seed, "drop_token", i, 5) != 0)))


def insert_symbol(df: DataFrame, seed: int, op: str = "ins") -> DataFrame:
    """Insert a symbol before a drawn value token."""
    out = df.withColumn("_cand", _value_places(F.col("_t")))
    at = F.get("_cand", draw(F.col("_id"), seed, "ins", "at", F.size("_cand")))
    symbol = F.substring(F.lit(SYMBOLS), draw(F.col("_id"), seed, "ins", "sym", len(SYMBOLS)) + 1, F.lit(1))
    changed = _cut(F.col("_t"), at, F.lit(0), F.array(symbol))
    return out.withColumn("_t", F.coalesce(changed, "_t")).drop("_cand")


def _columns(tokens: Column) -> Column:
    """start, last and size of every column; a separator at its end does not count."""
    starts = F.filter(_indices(tokens), lambda i: F.get(tokens, i) == "COL")
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(tokens)))
    return F.zip_with(starts, ends, lambda s, e: F.struct(
        s.alias("start"),
        (e - F.when(F.get(tokens, e - 1) == SEPARATOR, 2).otherwise(1)).alias("last"),
        (F.get(tokens, e - 1) == SEPARATOR).alias("closes")))


def append_column(df: DataFrame, seed: int, op: str = "append_col") -> DataFrame:
    """Move the value of one drawn column of the left side to the end of another and drop the
    column."""
    out = df.withColumn("_cols", _columns(F.col("_t")))
    closing = F.array_position(F.transform("_cols", lambda c: c["closes"]), True).cast("int")
    out = out.withColumn("_cols", F.when(closing > 0, F.slice("_cols", 1, closing)).otherwise(F.col("_cols")))
    n = F.size("_cols")
    first = draw(F.col("_id"), seed, "append_col", "from", n)
    second = (first + 1 + draw(F.col("_id"), seed, "append_col", "to", n - 1)) % n
    out = (out.withColumn("_from", F.when(n >= 2, F.get("_cols", first)))
           .withColumn("_to", F.when(n >= 2, F.get("_cols", second))))
    start, last = F.col("_from.start"), F.col("_from.last")
    source = F.slice("_t", start + 1, last - start + 1)
    # without a VAL the whole column moves
    value = F.slice(source, F.array_position(source, F.lit("VAL")).cast("int") + 1, F.size(source))
    moved = F.flatten(F.transform("_t", lambda t, i: F.when(
        (i >= start) & (i <= last), _nothing()).when(
        i == F.col("_to.last"), F.concat(F.array(t), value)).otherwise(F.array(t))))
    return out.withColumn("_t", F.when(F.col("_from").isNotNull(), moved).otherwise(F.col("_t"))) \
        .drop("_cols", "_from", "_to")


def drop_column(df: DataFrame, seed: int, op: str = "drop_col") -> DataFrame:
    """Drop a drawn column of at most eight tokens."""
    out = df.withColumn("_cols", F.filter(
        _columns(F.col("_t")), lambda c: c["last"] - c["start"] + 1 <= SHORT_COLUMN))
    out = out.withColumn("_c", F.get("_cols", draw(F.col("_id"), seed, "drop_col", "c", F.size("_cols"))))
    kept = F.filter("_t", lambda t, i: (i < F.col("_c.start")) | (i > F.col("_c.last")))
    return out.withColumn("_t", F.when(F.col("_c").isNotNull(), kept).otherwise(F.col("_t"))) \
        .drop("_cols", "_c")


STEPS: dict[str, Step] = {
    "del": delete_span, "swap": swap_span, "drop_len": drop_length, "drop_sym": drop_symbols,
    "drop_same": drop_shared, "drop_token": drop_tokens, "ins": insert_symbol,
    "append_col": append_column, "drop_col": drop_column,
}


def augment(pairs: DataFrame, id_col: str, text: str, op: str = "all", seed: int = 42,
            flip: bool = True) -> DataFrame:
    """Rows with ``text`` changed by ``op``.  ``flip`` exchanges the sides of half the pairs first;
    ``all`` applies three drawn operations in a row."""
    out = pairs.withColumn("_id", F.col(id_col))
    halves = F.split(F.col(text), r" \[SEP\] ", 2)
    flipped = F.concat_ws(f" {SEPARATOR} ", F.get(halves, F.lit(1)), F.get(halves, F.lit(0)))
    turn = F.lit(flip) & F.col(text).contains(f" {SEPARATOR} ") & \
        (draw(F.col("_id"), seed, "flip", "f", 2) == 0)
    out = out.withColumn("_t", F.split(F.when(turn, flipped).otherwise(F.col(text)), " "))
    if op != "all":
        out = STEPS[op](out, seed, op)
    else:
        for turn_no in range(3):
            out = out.withColumn("_op", draw(F.col("_id"), seed, "all", turn_no, len(COMBINED)))
            original = out.withColumn("_before", F.col("_t"))
            variants = None
            for i, name in enumerate(COMBINED):
                # rows that drew another operation have no tokens here, so a row costs one operation a turn
                drawn = original.withColumn("_t", F.when(F.col("_op") == i, F.col("_before")))
                stepped = STEPS[name](drawn, seed + turn_no + 1, name)
                original = stepped.withColumn(f"_v{i}", F.col("_t"))
                chosen = F.when(F.col("_op") == i, F.col(f"_v{i}"))
                variants = chosen if variants is None else F.coalesce(variants, chosen)
            out = original.withColumn("_t", variants).drop(
                "_before", "_op", *[f"_v{i}" for i in range(len(COMBINED))])
    return out.withColumn(text, F.array_join("_t", " ")).drop("_t", "_id")


# --- synthetic pairs -------------------------------------------------------------------------
def mix_halves(a: Column, b: Column) -> Column:
    """Stand-in for a generative mixer: the first half of the words of ``a`` and the second half
    of the words of ``b``."""
    words_a, words_b = F.split(a, " "), F.split(b, " ")
    half_a, half_b = (F.ceil(F.size(w) / 2).cast("int") for w in (words_a, words_b))
    return F.array_join(F.concat(F.slice(words_a, 1, half_a),
                                 F.slice(words_b, half_b + 1, F.size(words_b))), " ")


def synthetic_pairs(parsed: DataFrame, id_col: str, generations: int = 1,
                    mix: Callable[[Column, Column], Column] = mix_halves) -> DataFrame:
    """Synthetic matches of parsed pairs (columns id_col and attrs of attr/v1/v2).

    A third record mixes both values of every attribute (or takes the only one); each pair gives
    the pairs (1,3) and (2,3) with label 1, so every generation has twice the rows of its parent.
    """
    current = parsed.select(F.col(id_col).cast("string").alias("id"), "attrs")
    made = None
    for g in range(1, generations + 1):
        third = F.transform("attrs", lambda a: F.struct(
            a["attr"].alias("attr"), F.trim(a["v1"]).alias("v1"), F.trim(a["v2"]).alias("v2"),
            F.when((F.trim(a["v1"]) != "") & (F.trim(a["v2"]) != ""), mix(F.trim(a["v1"]), F.trim(a["v2"])))
            .otherwise(F.concat(F.trim(a["v1"]), F.trim(a["v2"]))).alias("v3")))
        mixed = current.withColumn("_m", third)
        fanned = mixed.select("id", "_m", F.explode(F.array(F.lit(1), F.lit(2))).alias("side"))
        left = lambda a: F.when(F.col("side") == 1, a["v1"]).otherwise(a["v2"])
        current = fanned.select(
            F.concat_ws(".", "id", F.col("side").cast("string")).alias("id"),
            F.col("id").alias("parent"), F.lit(g).alias("generation"), F.lit(1).alias("label"),
            F.transform("_m", lambda a: F.struct(a["attr"].alias("attr"), left(a).alias("v1"),
                                                  a["v3"].alias("v2"))).alias("attrs"))
        made = current if made is None else made.unionByName(current)
    return made


def synthetic_dataset(parsed: DataFrame, id_col: str, ratio: float = 1.0, generations: int = 1,
                      augmented_label: int = 1, keep_unsampled: bool = True,
                      mix: Callable[[Column, Column], Column] = mix_halves, seed: int = 42) -> DataFrame:
    """Real and synthetic pairs in shuffled order: id, parent, generation (0 for real ones), label,
    attrs, position.

    ``ratio`` is the budget: floor(ratio * n) of the n pairs of the augmented label, in hash order,
    are mixed.  All real pairs stay; without ``keep_unsampled`` those of the augmented label that
    were not drawn go.
    """
    real = parsed.select(F.col(id_col).cast("string").alias("id"), F.lit(None).cast("string").alias("parent"),
                         F.lit(0).alias("generation"), "label", "attrs")
    own, n = real.filter(F.col("label") == augmented_label), F.count(F.lit(1))
    drawn = ordinals.first_n(own, ["id"], F.floor(F.lit(ratio) * own.agg(n).scalar()), seed)
    others = real.filter(~F.coalesce(F.col("label") == augmented_label, F.lit(False)))
    kept = real if keep_unsampled else drawn.unionByName(others)
    return ordinals.shuffle_rows(kept.unionByName(synthetic_pairs(drawn, "id", generations, mix)), ["id"], seed)
