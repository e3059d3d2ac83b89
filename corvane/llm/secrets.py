"""Secrets in texts: known forms, and tokens that a battery of randomness tests finds.  DataFrame functions only.

Known forms are three patterns.  Beside them every run of at least 16 letters, digits and signs of base64 is a
candidate.  Its encoding is the smallest alphabet that holds it, and three statistics are taken in it:

* chi-squared of the alphabet's uniformity, that is, how often two symbols of the token coincide;
* runs of symbol classes (digits, lower and upper case, signs; halves of the alphabet if it has one class);
* lag-1 serial correlation of the symbol values.

A token is found if it is unlike text and not unlike random symbols.  Unlike text: fewer coincidences, more
changes of class, or both together more than text of its length shows; short tokens and small alphabets leave much room for chance, so
their p-values stay large.  These p-values pass the step-up rule of Benjamini and Hochberg at ``RATE``, over all
candidates of the table whose lengths have the same power of two.  Not unlike random: none of the three statistics is far from what uniform, independent symbols give.

Positions come from the pieces between matches, so they count code points.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions.binding import let
from corvane.llm.common import empty_text, stored, table

# The known forms.
WORDS = ("password", "passwd", "secret", "token", "api_?key")
KINDS = ("assign", "access", "hex", "random")


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = f"({'|'.join(map(_any_case, WORDS))})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
CANDIDATE = "[A-Za-z0-9+/_-]{16,}"

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = DIGITS + LOWER + UPPER + "+/_-"
CLASSES = "0" * 10 + "a" * 26 + "A" * 26 + "x" * 4
# Smallest first: pattern, number of symbols, shares of its classes.
ENCODINGS = (
    ("[0-9]+", 10, (5, 5)),
    ("[0-9a-f]+", 16, (10, 6)),
    ("[0-9A-F]+", 16, (10, 6)),
    ("[a-z]+", 26, (13, 13)),
    ("[A-Z]+", 26, (13, 13)),
    ("[A-Z2-7]+", 32, (26, 6)),
    ("[a-z0-9]+", 36, (26, 10)),
    ("[A-Z0-9]+", 36, (26, 10)),
    ("[A-Za-z]+", 52, (26, 26)),
    ("[A-Za-z0-9]+", 62, (26, 26, 10)),
    ("[A-Za-z0-9+/]+", 64, (26, 26, 10, 2)),
    ("[A-Za-z0-9_-]+", 64, (26, 26, 10, 2)),
)
ONE_CLASS = "[0-9]+|[a-z]+|[A-Z]+"
"""Alphabets whose two halves stand for classes."""
HALVES = "0" * 5 + "1" * 5 + "0" * 13 + "1" * 13 + "0" * 13 + "1" * 13 + "x" * 4

TEXT_COINCIDENCE = 0.0667
"""Chance that two letters of a text are equal."""
TEXT_TRIPLE = 0.0011
"""What three letters that are equal add to the variance of coincidences: sum p ** 3 - (sum p ** 2) ** 2."""
TEXT_CHANGE = 0.2
"""Chance that the class changes from one symbol of an ordinary token to the next, at most."""
RATE = 0.05
FAR = 3.5
"""Standard deviations from uniform symbols beyond which a token isn't random."""
STEP = 100
"""Deviations from text are ranked in steps of 1 / STEP, rounded towards text."""
BLOCK = 128


def places(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """start, end (code points, end exclusive) and piece of the leftmost, non-overlapping matches, with ``keep`` only
    those whose piece passes.

    A start is the sum of the lengths before it, added up in blocks and over the blocks.
    """
    def offsets(steps: Column) -> Column:
        blocks = F.sequence(F.lit(0), whole(F.size(steps) - 1))
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("out"))
        return F.aggregate(blocks, start, lambda acc, b: F.struct(
            (acc["at"] + total(F.slice(steps, b * BLOCK + 1, BLOCK))).alias("at"),
            F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]

    def total(steps: Column) -> Column:
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, s: acc + s["gap"] + s["width"])

    def located(steps: Column) -> Column:
        return let(offsets(steps), lambda at: F.transform(steps, lambda s, i: let(
            F.get(at, whole(i)) + total(F.slice(steps, whole(i) * BLOCK + 1, i % BLOCK)) + s["gap"],
            lambda begin: F.struct(begin.alias("start"), (begin + s["width"]).alias("end"), s["piece"].alias("piece")))))

    def whole(i: Column) -> Column:
        return F.floor(i / BLOCK).cast("int")

    def stepped(pieces: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(pieces))
        return F.zip_with(gaps, pieces, lambda g, m: F.struct(
            F.char_length(g).cast("long").alias("gap"), F.char_length(m).cast("long").alias("width"), m.alias("piece")))

    none = F.array().cast("array<struct<start:bigint,end:bigint,piece:string>>")
    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda pieces: F.when(
        F.size(pieces) > 0, let(stepped(pieces), located)).otherwise(none))
    return found if keep is None else F.filter(found, lambda s: keep(s["piece"]))


def measured(piece: Column) -> Column:
    """Statistics of a candidate: n, from_text (deviation from text, towards random) and random (not far from uniform)."""
    def by_encoding(value: Callable[[int, tuple], float]) -> Column:
        out = None
        for pattern, size, shares in ENCODINGS:
            met, c = piece.rlike(f"^(?:{pattern})$"), F.lit(float(value(size, shares)))
            out = F.when(met, c) if out is None else out.when(met, c)
        return out

    n = F.char_length(piece).cast("double")
    symbols = F.array(*[F.lit(c) for c in SYMBOLS])

    def square(c: Column) -> Column:
        count = (F.char_length(piece) - F.char_length(F.replace(piece, c, F.lit("")))).cast("double")
        return count * count

    squares = F.aggregate(symbols, F.lit(0.0), lambda acc, c: acc + square(c))
    one_class = piece.rlike(f"^(?:{ONE_CLASS})$")
    classes = F.when(one_class, F.translate(piece, SYMBOLS, HALVES)).otherwise(F.translate(piece, SYMBOLS, CLASSES))
    runs = F.char_length(F.regexp_replace(classes, "0+|1+|a+|A+|x+", "r")).cast("double")
    values = F.transform(F.split(piece, ""), lambda c: F.instr(F.lit(SYMBOLS), c).cast("double"))
    size = by_encoding(lambda a, s: a)
    change = by_encoding(lambda a, s: 1 - sum((k / a) ** 2 for k in s))

    def serial(v: Column) -> Column:
        add = lambda acc, x: acc + x
        zero = F.lit(0.0)
        s, ss = F.aggregate(v, zero, add), F.aggregate(v, zero, lambda acc, x: acc + x * x)
        sxy = F.aggregate(F.zip_with(v, F.slice(v, F.lit(2), F.size(v)), lambda a, b: a * F.coalesce(b, F.lit(0.0))), zero, add)
        return F.struct(s.alias("s"), ss.alias("ss"), sxy.alias("sxy"), F.get(v, F.lit(0)).alias("first"),
                        F.element_at(v, -1).alias("last"))

    def judged(m: Column) -> Column:
        pairs = m["n"] * (m["n"] - 1) / 2
        equal = (m["squares"] - m["n"]) / 2
        spread = F.sqrt(pairs * (TEXT_COINCIDENCE * (1 - TEXT_COINCIDENCE)) + m["n"] * (m["n"] - 1) * (m["n"] - 2) * TEXT_TRIPLE)
        few = (pairs * TEXT_COINCIDENCE - equal) / spread
        steps = m["n"] - 1
        mixed = F.when(m["one_class"], F.lit(-99.0)).otherwise(
            (m["runs"] - 1 - steps * TEXT_CHANGE) / F.sqrt(steps * (TEXT_CHANGE * (1 - TEXT_CHANGE))))
        # chi-squared with size - 1 degrees of freedom, as a normal deviation (Wilson and Hilferty)
        free = m["size"] - 1
        chi = m["squares"] * m["size"] / m["n"] - m["n"]
        uneven = (F.cbrt(chi / free) - (1 - 2 / (free * 9))) / F.sqrt(2 / (free * 9))
        rough = (m["runs"] - 1 - steps * m["change"]) / F.sqrt(steps * m["change"] * (1 - m["change"]))
        # sums over neighbours of (a - mean) * (b - mean), over the sum of squares
        mean, v = m["v"]["s"] / m["n"], m["v"]
        around = v["ss"] - v["s"] * mean
        lag = v["sxy"] - mean * (2 * v["s"] - v["first"] - v["last"]) + steps * mean * mean
        tied = F.when(around > 0, (lag / around + 1 / m["n"]) * F.sqrt(m["n"])).otherwise(F.lit(99.0))
        return F.struct(
            m["n"].cast("long").alias("n"), F.greatest(few, mixed, (few + mixed) / math.sqrt(2)).alias("from_text"),
            ((uneven <= FAR) & (F.abs(rough) <= FAR) & (F.abs(tied) <= FAR)).alias("random"))

    known = F.struct(n.alias("n"), squares.alias("squares"), one_class.alias("one_class"), runs.alias("runs"),
                     size.alias("size"), change.alias("change"), let(values, serial).alias("v"))
    return F.when(size.isNotNull(), let(known, judged))


def tail(z: Column) -> Column:
    """Upper tail of the normal distribution, from above, within a few per cent for any z."""
    far = F.abs(z)
    above = F.exp(far * far / -2) * 0.7978845608028654 / (far + F.sqrt(far * far + 2.5464790894703255))
    return F.when(z >= 0, above).otherwise(1 - above)


def thresholds(candidates: DataFrame, rate: float = RATE) -> DataFrame:
    """band, least: the smallest deviation from text that the step-up rule lets pass in each band of lengths.

    ``candidates`` is band and step.  Counts per step are a few thousand rows per band at most, whatever the table.
    """
    counts = candidates.groupBy("band", "step").agg(F.count(F.lit(1)).alias("n"))
    band = Window.partitionBy("band")
    up = band.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("rank", F.sum("n").over(up)).withColumn("all", F.sum("n").over(band))
    # two statistics and their sum, of which the largest counts
    passes = 3 * tail(F.col("step") / STEP) * F.col("all") <= rate * F.col("rank")
    return ranked.filter(passes).groupBy("band").agg(F.min("step").alias("least"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """Spans of secrets per row: the id, base (array of start, kind, end) and found (likewise, kind 3).

    kind counts in ``KINDS``.  base holds the known forms, by start, then kind; found holds the random tokens that
    no base span touches.  Every row is searched, whole.  A null or empty text has no span; repeated rows each
    have theirs; an empty table gives no row; other columns are not read.
    """
    text = F.col("_text")
    value = lambda piece: F.char_length(F.regexp_extract(piece, ASSIGN, 2)) >= 6
    known = [places(text, ASSIGN, value), places(text, ACCESS), places(text, HEX)]
    base = F.array_sort(F.concat(*[_spans(found, kind) for kind, found in enumerate(known)]))

    def candidate(s: Column) -> Column:
        return let(measured(s["piece"]), lambda m: F.when(m.isNotNull(), F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.floor(F.log2(m["n"] + 0.5)).cast("int").alias("band"),
            F.floor(F.least(F.greatest(m["from_text"], F.lit(-9.0)), F.lit(60.0)) * STEP).cast("int").alias("step"), m["random"].alias("random"))))

    tokens = F.filter(F.transform(places(text, CANDIDATE), candidate), lambda c: c.isNotNull())
    rows = stored(docs.select(F.col(id_col), empty_text(text_col).alias("_text"))
                  .select(id_col, base.alias("base"), tokens.alias("tokens")), "secret-spans")
    least = thresholds(rows.select(F.explode("tokens").alias("t")).select("t.band", "t.step"), rate)
    # one entry for each power of two of a length
    cut = least.agg(F.map_from_entries(F.collect_list(F.struct("band", "least")))).scalar()

    def passes(t: Column) -> Column:
        clear = ~F.exists("base", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"]))
        return t["random"] & (t["step"] >= F.element_at("cut", t["band"])) & clear

    found = _spans(F.filter("tokens", passes), len(KINDS) - 1)
    return rows.withColumn("cut", cut).select(id_col, "base", found.alias("found"))


def _spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def written(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in range(3)]
    counts = [(F.size("base") - n).cast("long").alias(f"n_{kind}") for kind, n in zip(KINDS, counts)]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                        written(F.array_sort(F.concat("base", "found"))).alias("spans"))


def _sql() -> str:
    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def by_encoding(value: Callable[[int, tuple], float]) -> str:
        met = " ".join(f"when regexp_full_match(m, {quoted(p)}) then {float(value(a, s))!r}::double" for p, a, s in ENCODINGS)
        return f"case {met} end"

    def tail_sql(z: str) -> str:
        above = f"(exp(abs({z}) * abs({z}) / -2) * 0.7978845608028654::double / (abs({z}) + sqrt(abs({z}) * abs({z}) + 2.5464790894703255::double)))"
        return f"(case when {z} >= 0 then {above} else 1 - {above} end)"

    raw = " union all ".join(f"select k, {kind} as kind, string_split_regex(text, {quoted(p)}) as gaps, regexp_extract_all(text, {quoted(p)}) as ms from docs"
                             for kind, p in enumerate((ASSIGN, ACCESS, HEX, CANDIDATE)))
    c, change, triple = f"{TEXT_COINCIDENCE}::double", f"{TEXT_CHANGE}::double", f"{TEXT_TRIPLE}::double"
    coincide, mixing = f"{TEXT_COINCIDENCE * (1 - TEXT_COINCIDENCE)!r}::double", f"{TEXT_CHANGE * (1 - TEXT_CHANGE)!r}::double"
    symbols = "[" + ", ".join(f"'{s}'" for s in SYMBOLS) + "]"
    return f"""
with docs as (select row_number() over () as k, doc_id, coalesce(text, '') as text from documents),
raw as materialized ({raw}),
pieces as (select k, kind, unnest(ms) as m, unnest(gaps[1:len(ms)]) as g, generate_subscripts(ms, 1) as i from raw where len(ms) > 0),
placed as materialized (select k, kind, m, (sum(length(g) + length(m)) over (partition by k, kind order by i))::bigint as e from pieces),
base as (select k, kind, e - length(m) as s, e from placed
    where kind < 3 and (kind > 0 or length(regexp_extract(m, {quoted(ASSIGN)}, 2)) >= 6)),
tokens as (select k, e - length(m) as s, e, m, length(m)::double as n, {by_encoding(lambda a, s: a)} as size, {by_encoding(lambda a, s: 1 - sum((x / a) ** 2 for x in s))} as change,
    regexp_full_match(m, '{ONE_CLASS}') as one_class,
    list_sum(list_transform({symbols}, lambda x: (length(m) - length(replace(m, x, '')))::double * (length(m) - length(replace(m, x, '')))::double)) as squares,
    list_transform(string_split(m, ''), lambda x: instr('{SYMBOLS}', x)::double) as v from placed where kind = 3),
sums as (select *, length(regexp_replace(case when one_class then translate(m, '{SYMBOLS}', '{HALVES}') else translate(m, '{SYMBOLS}', '{CLASSES}') end, '0+|1+|a+|A+|x+', 'r', 'g'))::double as runs,
    list_sum(v) as vs, list_sum(list_transform(v, lambda x: x * x)) as vss, list_sum(list_transform(range(1, len(v)), lambda i: v[i] * v[i + 1])) as vxy, n - 1 as steps,
    n * (n - 1) / 2 as pairs, squares * size / n - n as chi, size - 1 as free from tokens where size is not null),
stats as (select *, (pairs * {c} - (squares - n) / 2) / sqrt(pairs * {coincide} + n * (n - 1) * (n - 2) * {triple}) as few,
    case when one_class then -99.0::double else (runs - 1 - steps * {change}) / sqrt(steps * {mixing}) end as mixed,
    (cbrt(chi / free) - (1 - 2 / (free * 9))) / sqrt(2 / (free * 9)) as uneven, (runs - 1 - steps * change) / sqrt(steps * change * (1 - change)) as rough,
    vss - vs * (vs / n) as around, vxy - (vs / n) * (2 * vs - v[1] - v[-1]) + steps * (vs / n) * (vs / n) as lag from sums),
judged as (select k, s, e, floor(log2(n + 0.5))::int as band, floor(least(greatest(greatest(few, mixed, (few + mixed) / {math.sqrt(2)!r}::double), -9.0::double), 60.0::double) * {STEP})::int as step,
    uneven <= {FAR} and abs(rough) <= {FAR} and case when around > 0 then abs((lag / around + 1 / n) * sqrt(n)) <= {FAR} else false end as random from stats),
counts as (select band, step, count(*) as n from judged group by band, step),
ranked as (select band, step, sum(n) over (partition by band order by step desc) as rank, sum(n) over (partition by band) as total from counts),
least_steps as (select band, min(step) as cut from ranked where 3 * {tail_sql(f'(step / {STEP}::double)')} * total <= {RATE} * rank group by band),
found as (select k, 3 as kind, s, e from judged j join least_steps using (band)
    where random and step >= cut and not exists (select 1 from base b where b.k = j.k and b.s < j.e and j.s < b.e)),
spans as (select k, kind, s, (case kind when 0 then 'assign' when 1 then 'access' when 2 then 'hex' else 'random' end) || ':' || s || ':' || e as span
    from (select k, kind, s, e from base union all select k, kind, s, e from found))
select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
    sha256(coalesce(string_agg(span, ',' order by s, kind) filter (kind < 3), '')) as base_sha256,
    coalesce(string_agg(span, ',' order by s, kind), '') as spans
from docs left join spans using (k) group by k, doc_id"""


OP11_SQL = _sql()
