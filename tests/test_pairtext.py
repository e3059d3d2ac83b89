import random
import re

import pytest
from pyspark.sql import functions as F

from corvane.operators import augment, pairtext, quality

LINE = "COL name VAL Red Ale COL abv VAL 5.6 %\tCOL name VAL red ale COL abv VAL 5.60 %\t1"


def lines(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, line string")


@pytest.mark.parametrize("line, reason, left", [
    (LINE, None, [("name", "Red Ale"), ("abv", "5.6 %")]),
    ("COL a VAL\tCOL a VAL x\t0", None, [("a", "")]),
    ("COL a VAL 1 COL b VAL 2 COL a VAL 3\t\t 0 ", None, [("a", "3"), ("b", "2")]),
    ("COL a VAL VAL x\tCOL a VAL x\t1", None, [("a", "VAL x")]),
    ("COL a x\tCOL a VAL x\t1", "bad_side", None),
    ("x COL a VAL x\tCOL a VAL x\t1", "bad_side", None),
    ("COL a VAL x\t1", "no_three_fields", None),
    ("COL a VAL x\tCOL a VAL x\tyes", "bad_label", [("a", "x")]),
])
def test_parse(spark, line, reason, left):
    row = pairtext.parse_lines(lines(spark, line)).first()
    assert row["reason"] == reason
    assert (row["left"] and [tuple(x) for x in row["left"]]) == left


def test_round_trip(spark):
    row = pairtext.parse_lines(lines(spark, LINE)).select(pairtext.join_attrs(F.col("attrs"), F.col("label"))).first()
    assert row[0] == LINE


def test_attribute_order(spark):
    parsed = pairtext.parse_lines(lines(spark, "COL b VAL 1\tCOL a VAL 1\t1", LINE))
    order = pairtext.attribute_order(parsed, "id").orderBy("first_seen").collect()
    assert [r["attr"] for r in order] == ["b", "a", "name", "abv"]


def test_serialise(spark):
    pair = spark.createDataFrame([("v", "A\tB*", None, "v", "x", "y", 1)], ", ".join(
        f"{c}_{s} string" for s in ("used_cars", "vehicles") for c in ("vin", "m", "n")) + ", match_label int")
    got = pair.select(pairtext.serialise_pairs(pair), pairtext.serialise_pairs(pair, "nan"), pairtext.json_pair(pair)).first()
    assert got[0] == "COL m VAL A B COL n VAL\tCOL m VAL x COL n VAL y\t1"
    assert got[1].startswith("COL m VAL A B COL n VAL nan\t")
    assert got[2] == '[{"m":"A B*","n":""},{"m":"x","n":"y"}]'
    with pytest.raises(ValueError):
        pairtext.serialise_pairs(pair.drop("n_vehicles"))


def test_knowledge(spark):
    got = lines(spark, "COL p VAL 5.0 7.256 1,000 abc12345 1234567 1/2 v1.2.3\tx\t1", "no tabs")
    rows = pairtext.inject_lines(got).collect()
    assert [r["line"] for r in rows] == ["COL p VAL 5 7.26 1,000 ID abc12345 1234567 1/2 v1.2.3\tx\t1"]


def test_summary_keeps_the_heaviest_tokens(spark):
    rows = [f"COL t VAL common word{i} the\tCOL t VAL common word{i} word{i}\t1" for i in range(5)]
    data = lines(spark, *rows)
    idf = pairtext.entry_idf(data)
    got = {r["id"]: r["summary"] for r in pairtext.summarise(data, "id", idf, max_len=3).collect()}
    assert got[0] == "COL VAL word0\tCOL VAL word0\t1"
    long = pairtext.summarise(data, "id", idf, max_len=9, token_length=F.length("token")).collect()
    assert {r["id"]: r["summary"] for r in long}[0] == "COL VAL word0\tCOL VAL word0\t1"


TEXT = "COL a VAL x1 y2 z COL b VAL q.r s [SEP] COL a VAL x1 t COL b VAL u v w"


@pytest.mark.parametrize("op", [*augment.STEPS, "all"])
def test_augment_is_stable_and_keeps_structure(spark, op):
    data = spark.range(60).select("id", F.lit(TEXT).alias("text"))
    run = lambda n: sorted(map(tuple, augment.augment(data.repartition(n), "id", "text", op).collect()))
    first = run(1)
    assert first == run(5)
    assert len(first) == 60 and any(t != TEXT for _, t in first)
    assert all(t.count("[SEP]") == 1 for _, t in first)
    other = augment.augment(data, "id", "text", op, seed=7).collect()
    assert sorted(map(tuple, other)) != first


@pytest.mark.parametrize("op, check", [
    ("del", lambda t: 0 < len(TEXT.split()) - len(t) <= 2),
    ("swap", lambda t: sorted(t) == sorted(TEXT.split())),
    ("ins", lambda t: len(t) == len(TEXT.split()) + 1),
    ("drop_col", lambda t: t.count("COL") == 3),
    ("append_col", lambda t: t.count("COL") == 3 and "q.r" in t and "z" in t),
    ("drop_same", lambda t: len(TEXT.split()) - len(t) == 2),
])
def test_augment_effects(spark, op, check):
    data = spark.range(30).select("id", F.lit(TEXT).alias("text"))
    for row in augment.augment(data, "id", "text", op, flip=False).collect():
        assert check(row["text"].split(" ")), row["text"]


@pytest.mark.parametrize("op", [*augment.STEPS])
def test_augment_without_candidates(spark, op):
    data = spark.createDataFrame([(1, "[SEP]")], "id long, text string")
    assert augment.augment(data, "id", "text", op).first()["text"] == "[SEP]"


def test_synthetic_pairs(spark):
    parsed = pairtext.parse_lines(lines(spark, "COL a VAL one two COL b VAL\tCOL a VAL three four COL b VAL only\t1"))
    made = augment.synthetic_pairs(parsed, "id", 2).collect()
    assert sorted((r["generation"], r["id"], r["parent"]) for r in made) == [
        (1, "0.1", "0"), (1, "0.2", "0"), (2, "0.1.1", "0.1"), (2, "0.1.2", "0.1"), (2, "0.2.1", "0.2"), (2, "0.2.2", "0.2")]
    first = next(r for r in made if r["id"] == "0.1")
    assert [tuple(a) for a in first["attrs"]] == [("a", "one two", "one four"), ("b", "", "only")]


def test_line_measures(spark):
    df = lines(spark, "COL a b VAL  x (y \tCOL c VAL zz COL d VAL w\t1")
    line = F.col("line")
    row = df.select(quality.value_lengths(line), quality.value_lengths(line, True),
                    quality.unbalanced_brackets(line)).first()
    assert tuple(row) == ([4, 14], [4, 2, 1], True)
    grams = lines(spark, "a b c a b c a b c", "a b", "").select("id", quality.repetition(line, 3).alias("n"))
    assert [r["n"] for r in grams.orderBy("id").collect()] == [3, 0, 0]
    rep = quality.repeats_ngram(lines(spark, "a b\ta b\t1", "a b\tb a\t1"), "id", F.lit(2)).orderBy("id").collect()
    assert [r["repeated"] for r in rep] == [True, False]


def test_quality_reasons(spark):
    clean = [f"COL a VAL good text number {w}\tCOL a VAL good text also {w}\t1" for w in ("one", "two", "six")]
    data = lines(spark, *clean, "COL a VAL good ( text\tCOL a VAL good\t1", "COL a VAL good [ text\tCOL a VAL good\t0",
                 "broken", "COL a VAL good { text\tCOL a VAL good\t1 ", "COL a VAL zzz qqq\tCOL a VAL zzz\t1")
    words = spark.createDataFrame([("col", 5.0), ("a", 6.0), ("val", 5.0), ("good", 5.0), ("text", 5.0)], "word string, zipf double")
    original = data.filter("id = 6").select(F.md5(F.lit("COL a VAL good { text\tCOL a VAL good\t1")).alias("line_md5"))
    options = quality.Thresholds(max_length=100, max_dup_ngrams=0, min_tfidf=0.0, min_dict_hit_rate=0.7, min_zipf=1.0)
    got = {r["id"]: r["reasons"] for r in quality.filter_lines(data, "id", words, original, options).collect()}
    assert got[3] == ["unbalanced_brackets"] and got[4] == [] and got[5] == ["bad_format"] and got[6] == []
    assert "low_dict_hit" in got[7]
    verdicts = quality.filter_lines(data, "id", words, original, options)
    routed = quality.route_lines(data, "id", verdicts)
    assert routed.count() == 8 and routed.filter("kept").count() == sum(not r for r in got.values())


def test_auto_thresholds_of_one_line(spark):
    words = spark.createDataFrame([("a", 1.0)], "word string, zipf double")
    options = quality.Thresholds()
    features = quality.line_features(lines(spark, "COL a VAL xyz\tCOL a VAL xy\t1"), "id", words, options)
    row = quality.auto_thresholds(features, options).first()
    assert (row["max_length"], row["max_dup_ngrams"]) == (3, 2)


@pytest.mark.parametrize("ratio, keep, real, made", [(0.5, True, 5, 4), (0.5, False, 3, 4), (0.0, True, 5, 0), (1.0, False, 5, 8)])
def test_synthetic_dataset(spark, ratio, keep, real, made):
    texts = ["COL a VAL x y\tCOL a VAL z\t1"] * 4 + ["COL a VAL x\tCOL a VAL z\t0"]
    parsed = pairtext.parse_lines(lines(spark, *texts))
    rows = augment.synthetic_dataset(parsed, "id", ratio, keep_unsampled=keep).collect()
    assert sorted(r["position"] for r in rows) == list(range(1, len(rows) + 1))
    assert [sum(r["generation"] == g for r in rows) for g in (0, 1)] == [real, made]
    assert all(r["label"] == 1 and r["parent"] for r in rows if r["generation"])


def test_a_line_is_parsed_once_below_a_filter(spark):
    made = spark.range(3).select("id", F.concat(F.lit("COL a VAL "), F.col("id"), F.lit("\tCOL a VAL 1\t"), F.col("id")).alias("line"))
    good = pairtext.parse_lines(made).filter("reason IS NULL").select("id", "attrs")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 2 * 2  # names and values of two sides
    assert [r["attrs"][0]["v1"] for r in good.orderBy("id").collect()] == ["0", "1", "2"]


def test_line_features_search_a_line_once(spark):
    """Measures and counts of words come from one kept pass over the lines."""
    lines = spark.createDataFrame([(1, "COL a VAL b c b\tCOL a VAL b d\t1"), (2, "COL a VAL b c\tCOL a VAL x\t0"), (3, None)], "id long, line string")
    frequencies = spark.createDataFrame([("b", 3.0), ("c", 2.0)], "word string, zipf double")
    found = quality.line_features(lines, "id", frequencies, quality.Thresholds())
    text = quality.full_text(quality.cleaning.canonical_line(F.col("line")))
    scores = quality.dictionary_scores(lines, "id", text, frequencies)
    columns = ["id", "n_words", "hit_rate", "mean_zipf"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, scores.select(columns).collect()))
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
    assert "InMemoryRelation" in found._jdf.queryExecution().optimizedPlan().toString() and "regexp_extract_all" not in plan


def test_all_runs_only_the_drawn_operation(spark, monkeypatch):
    """A step of ``all`` sees the tokens of the rows that drew it, and no others."""
    def spy(name):
        return lambda df, seed, op: df.withColumn("_t", F.when(F.col("_t").isNotNull(), F.array_append("_t", F.lit(name)))) \
            .withColumn("_seen", F.col("_seen") + F.col("_t").isNotNull().cast("int"))

    monkeypatch.setattr(augment, "STEPS", {name: spy(name) for name in augment.COMBINED})
    lines = spark.range(40).select("id", F.lit("COL a VAL b [SEP] COL a VAL c").alias("text"), F.lit(0).alias("_seen"))
    rows = augment.augment(lines, "id", "text").collect()
    assert {r["_seen"] for r in rows} == {3}
    assert all(len(r["text"].split()) == 9 + 3 for r in rows)


def test_line_features_keep_no_words(spark, monkeypatch):
    """What a pass keeps of a line are numbers and words outside the head of the dictionary; with a head of one word
    and counts handed on after every word the scores stay the same."""
    lines = spark.createDataFrame([(1, "COL a VAL b c b_1 \u00e9t\u00e9\tCOL a VAL b d2e\t1"), (2, "COL a VAL b c \U00010400x\tCOL a VAL \u00e9t\u00e9\t1"),
                                   (3, None), (4, "COL a VAL\tCOL\t0")], "id long, line string")
    words = spark.createDataFrame([("b", 3.0), ("c", 2.0), ("c", 1.5), ("e", 1.0), ("val", 0.0)], "word string, zipf double")
    options = quality.Thresholds()
    whole = quality.line_features(lines, "id", words, options)
    kept = whole._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"\b(cells|words)#", kept)
    columns = ["id", "repetition", "n_words", F.round("hit_rate", 9).alias("hit_rate"), F.round("mean_zipf", 9).alias("mean_zipf"),
               F.round("tfidf", 9).alias("tfidf")]
    expected = sorted(map(tuple, whole.select(columns).collect()))
    assert [row[3] for row in expected] == [round(6 / 13, 9), 0.3, 1.0, 0.0]
    monkeypatch.setattr(quality, "HEAD", 1)
    monkeypatch.setattr(quality, "TALLY", 1)
    assert sorted(map(tuple, quality.line_features(lines, "id", words, options).select(columns).collect())) == expected


def test_vocabulary_words_are_those_of_the_pattern(spark):
    texts = ["a bc d_e 1 23 \u00e9\u0301t x\u0301", "\U0001d400\U0001d401 \U0001f600 ab\u00a0cd \u2160\u2161 \u4e00\u4e8c", "_ __ 9_", ""]
    data = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    pattern = F.regexp_extract_all("text", F.lit(pairtext.VOCAB_PATTERN), F.lit(0))
    found = [r["w"] for r in data.select("id", pattern.alias("w")).orderBy("id").collect()]
    assert [quality._vocabulary_words(t, quality._word_class()) for t in texts] == found


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 7, 30])
def test_repeated_ngrams_equal_brute_force(spark, n):
    """Windows are compared by number; the text of every window of every line is not built."""
    draw = random.Random(n)
    rows = [" ".join(draw.choice("ab") for _ in range(draw.randrange(40))) for _ in range(30)] + ["x y " * 20]
    data = spark.createDataFrame([(i, f"{t}\t{t[:9]}\t1") for i, t in enumerate(rows)], "id long, line string")
    found = quality.repeats_ngram(data, "id", F.lit(n))
    assert "array_join(slice" not in found._jdf.queryExecution().optimizedPlan().toString()

    def brute(text):
        words = f"{text} {text[:9]}".split()
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)] if n else []
        return len(set(grams)) < len(grams)
    assert [r["repeated"] for r in found.orderBy("id").collect()] == [brute(t) for t in rows]


@pytest.mark.parametrize("line", ["a\tb\tc", "\ta\tb\tc\t", "a\tb", "", "\t\t", None, "x\ny\t z\t1\n"])
def test_a_line_is_cut_at_its_last_two_tabs(spark, line):
    row = spark.createDataFrame([(line,)], "line string").select(*[pairtext.split_line(F.col("line"), p) for p in (1, 2, 3)]).first()
    parts = line.rsplit("\t", 2) if line is not None and line.count("\t") > 1 else [None] * 3
    assert list(row) == parts
