import math

import pytest
from pyspark.sql import functions as F

from corvane.functions import analysis, cleaning, queries, similarity


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw, expected", [
    ("<html><body><h1>Title</h1><p>This is a <b>bold</b> paragraph.</p></body></html>",
     "TitleThis is a bold paragraph."),
    ("<div><a href='#'>Link</a></div>", "Link"),
    ("No HTML here!", "No HTML here!"),
    ("a <b\n>c", "a <b >c"),
    ("x &amp; y<script>f()</script>", "x &amp; yf()"),
])
def test_strip_tags(spark, raw, expected):
    assert one(spark, raw, cleaning.strip_tags) == expected


@pytest.mark.parametrize("text, title, abstract", [
    ("Title: A b \n\nAbstract: One\n\n two \nKeywords: k\nthree", "A b", "One two"),
    ("nothing", "Unknown title", "No abstract available"),
    ("TITLE:T\nABSTRACT:\nx\nIntroduction to y\nz", "T", "x"),
    ("title:\nabstract: a\nIntroductory y\n1. z", "", "a Introductory y"),
    ("abstract: a\r\nconclusions: z", "Unknown title", "a"),
])
def test_title_and_abstract(spark, text, title, abstract):
    row = cleaning.add_title_and_abstract(spark.createDataFrame([(text,)], "value string")).first()
    assert (row["title"], row["abstract"]) == (title, abstract)


@pytest.mark.parametrize("raw, expected", [("$ 1,200.50", 1200.5), ("n/a", None), ("1.2.3", None), (" ", None)])
def test_price(spark, raw, expected):
    assert one(spark, raw, cleaning.normalise_price) == expected


def test_small_cleaners(spark):
    assert one(spark, "  AbC\t", cleaning.normalise_text) == "abc"
    assert one(spark, " \t ", cleaning.normalise_text) is None
    assert one(spark, " \n ", cleaning.blank_to_null) is None
    assert one(spark, "a*b\n\tçé (x) [y]_-", cleaning.strict_clean) == "ab çé (x) y_-"
    assert one(spark, " a\t\nb  c ", cleaning.loose_clean) == "a b c"
    assert one(spark, "", cleaning.published_year) == "Unknown"
    assert one(spark, "2024-05", cleaning.published_year) == "2024"
    assert one(spark, " a \t b\t1 ", cleaning.canonical_line) == "a\tb\t1"
    assert one(spark, "A/B c", lambda c: cleaning.safe_file_name(F.lit(7), c)) == "007_A_B_c.txt"
    row = spark.range(1).select(
        cleaning.first_filled(F.lit(""), F.lit("0"), F.lit("x")).alias("a"),
        cleaning.duration_seconds(F.lit("Sun Feb 22 01:22:28 PM CET 2026"),
                                  F.lit("Sun Feb 22 01:23:09 PM CET 2026")).alias("d"),
        cleaning.full_names(F.array(F.lit("A"), F.lit(None), F.lit("")),
                            F.array(F.lit("B"), F.lit("C"), F.lit(None))).alias("n")).first()
    assert (row["a"], row["d"], row["n"]) == ("x", 41.0, ["A B", "C"])


@pytest.mark.parametrize("word, stem", [
    ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("feed", "feed"), ("agreed", "agre"),
    ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"),
    ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"),
    ("relational", "relat"), ("conditional", "condit"), ("vietnamization", "vietnam"),
    ("triplicate", "triplic"), ("hopefulness", "hope"), ("revival", "reviv"), ("adjustment", "adjust"),
    ("adoption", "adopt"), ("probate", "probat"), ("rate", "rate"), ("controll", "control"), ("roll", "roll"),
])
def test_porter(word, stem):
    assert analysis.porter_stem(word) == stem


def test_analyzers(spark):
    assert one(spark, "Don't e.g. U.S.A 3.14 a.1 x_y Naïve-é title:foo", analysis.standard_tokens) == [
        "don't", "e.g", "u.s.a", "3.14", "a", "1", "x_y", "naïve", "é", "title:foo"]
    assert one(spark, "GPT-4o2 model's x.y", analysis.title_query_tokens) == [
        "gpt", "4", "o", "2", "model", "x", "y"]
    assert one(spark, "The runner's running of cats", analysis.english_tokens) == ["runner", "run", "cat"]


@pytest.mark.parametrize("a, b, score", [
    ("MARTHA", "MARHTA", 0.9611), ("DIXON", "DICKSONX", 0.8133), ("DWAYNE", "DUANE", 0.84),
    ("abc", "", 0.0), ("abc", "xyz", 0.0), ("same", "same", 1.0),
])
def test_jaro_winkler(a, b, score):
    assert math.isclose(similarity.jaro_winkler_value(a, b), score, abs_tol=5e-5)


@pytest.mark.parametrize("word, code", [
    ("Robert", "R163"), ("Rupert", "R163"), ("Ashcraft", "A261"), ("Tymczak", "T522"), ("Pfister", "P236"),
    ("1500", "1000"), ("3 series", "3262"), ("nan", "N500"), ("", None),
])
def test_soundex(spark, word, code):
    assert one(spark, word, similarity.soundex) == code


def test_gauss_and_exact(spark):
    row = spark.range(1).select(
        similarity.gauss(F.lit(100), F.lit(150), 100, 1000).alias("in"),
        similarity.gauss(F.lit(0), F.lit(1100), 100, 1000).alias("half"),
        similarity.gauss(F.lit(None).cast("int"), F.lit(1), 100, 1000).alias("missing"),
        similarity.exact(F.lit(None).cast("string"), F.lit("x")).alias("e")).first()
    assert tuple(row) == (1.0, 0.5, 0.0, 0.0)


@pytest.mark.parametrize("text, kind, clauses, first, last", [
    ("published:>=2021-03", "date_range", [], "2021-03-01", None),
    ("published:=2020", "date_eq", [], "2020-01-01", "2021-01-01"),
    ("published:=2020-12", "date_eq", [], "2020-12-01", "2021-01-01"),
    ("published:=2020-12-31", "date_eq", [], "2020-12-31", "2020-12-31"),
    ('title:"a b" AND summary:"c"', "must", [("title", "a b"), ("summary", "c")], None, None),
    ('title:"a" OR summary:"c" AND x:"d"', "should", [("title", "a"), ("summary", "c"), ("x", "d")], None, None),
    ("cats OR dogs", "should", [], None, None),
    ('title:"a" summary:"b"', "match", [("title", "a")], None, None),
    ("free text", "multi_match", [], None, None),
    ("published:>=2024-13", "invalid_date", [], None, None),
])
def test_normalise_queries(spark, text, kind, clauses, first, last):
    row = queries.normalise_queries(spark.createDataFrame([(text,)], "query string")).first()
    day = lambda t: t and t.strftime("%Y-%m-%d")
    assert (row["kind"], [tuple(c) for c in row["clauses"]], day(row["date_from"]), day(row["date_to"])) == (
        kind, clauses, first, last)


@pytest.mark.parametrize("text, valid, n", [
    ("title:x,abstract:y", True, 2), ("title:x", True, 1), ("title:x,abstract:y,title:z", False, 3),
    ("author:x", False, 1), ("x", False, 1), ('abstract:"a b"', True, 1),
])
def test_field_queries(spark, text, valid, n):
    row = queries.field_query_clauses(spark.createDataFrame([(text,)], "query string")).first()
    assert (row["valid"], len(row["clauses"])) == (valid, n)


@pytest.mark.parametrize("value", ["2024-13", "2024-02-30", "2024-", "20", ""])
def test_invalid_dates_match_nothing(spark, value):
    days = spark.createDataFrame([("2024-02-28",)], "d string").select(F.col("d").cast("date").alias("d"))
    assert [days.filter(queries.date_matches(F.col("d"), op, value)).count() for op in ("=", ">=", "<")] == [0, 0, 0]


@pytest.mark.parametrize("op, value, expected", [
    ("=", "2020", [2, 3, 4]), ("=", "2020-12", [3, 4]), ("=", "2020-12-31", [4]), (">", "2020-12-31", [5]),
    (">=", "2020-12", [3, 4, 5]), ("<", "2020", [1]), ("<=", "2020-01-01", [1, 2]),
])
def test_date_matches_and_reaches_the_scan(spark, tmp_path, op, value, expected):
    days = ["2019-12-31", "2020-01-01", "2020-12-01", "2020-12-31", "2021-01-01"]
    rows = spark.createDataFrame(list(enumerate(days, start=1)), "id int, d string")
    for kind in ("timestamp", "timestamp_ntz", "date"):
        path = str(tmp_path / kind)
        rows.select("id", F.col("d").cast(kind).alias("published")).write.parquet(path)
        found = spark.read.parquet(path).filter(queries.date_matches(F.col("published"), op, value))
        assert sorted(r["id"] for r in found.collect()) == expected
        plan = found._jdf.queryExecution().toString()
        pushed = plan.split("PushedFilters: [")[1].split("]")[0]
        assert "published," in pushed.replace("IsNotNull(published)", "")


def test_plain_markup_is_read_as_by_the_reader(monkeypatch):
    """A tag or text of plain markup is one match; whatever else comes goes to the reader, with the same tree."""
    import random

    from corvane.functions import markup
    draw = random.Random(5)
    plain = ["<p>", "</p>", '<a class="x y" href="#F1">', "</a>", "text & more", "a &lt; b &amp;amp; &copy &nosuch; &#65;", "<br>", "<br/>", "<p/>", "</br>",
             '<img src="1.png"/>', "\n", "</q>", "<b>", "<div>", "</div>", '<p id="1" id="2">']
    odd = ["<P>", "<a href=x>", "<!-- c -->", "<script>if (a<b) x</script>", "<title>a<b></title>", "<", "< p>", "<a b='1'>", "<?x?>", "<!DOCTYPE html>", "</ p>",
           '<a b="&lt;">', "<p", "&", "<a\tb>", "\r\n", "\0", "<style>", "<textarea>", "</p x>"]

    def slow(text):
        tree = markup._HtmlTree()
        tree.feed(text)
        tree.close()
        return tree.root

    def shape(e):
        return e.name, e.attrs, e.short, "".join(markup._write(e.content)), [shape(c) for c in e.content if isinstance(c, markup.Element)]

    for i in range(3000):
        text = "".join(draw.choice(plain if draw.random() < 0.9 or i % 2 else odd) for _ in range(draw.randrange(12)))
        assert shape(markup.parse_html(text)) == shape(slow(text)), text
    monkeypatch.setattr(markup, "_HtmlTree", None)
    assert markup.parse_html('<p class="ltx_p">a &amp; b<br></p>').text() == "a & b"
