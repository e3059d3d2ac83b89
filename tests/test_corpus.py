import json

import pytest
from pyspark.sql import functions as F

from corvane.operators import extraction, joins
from corvane.sinks import writers
from corvane.sources import feeds, files
from corvane.streaming import ingest

HTML = """<html><body>
<p class="ltx_p" id="p1">See <a class="ltx_ref" href="#S1.T10">Table 10</a> &amp; <a class="ltx_ref" href="#">x</a><br></p>
<p class="other" id="p2">skip</p>
<p class="x ltx_p">No id <a href="#S1.T1" class="ltx_ref">T1</a> <a class="ltx_ref" href="#S1.T1">T1</a></p>
<p class="ltx_p" id="p3"> </p>
<figure class="ltx_figure" id="F1"><img src="a.png"><figcaption class="ltx_caption">Outer <b>one</b></figcaption>
  <figure class="ltx_figure" id="F2"><img src="b.png"><figcaption class="ltx_caption">Inner</figcaption></figure></figure>
<figure class="ltx_figure" id="F3"><img src="c.png"></figure>
<figure class="ltx_figure" id="F4"><figcaption class="ltx_caption">Holds table</figcaption><table><tr><td>1</td></tr></table></figure>
<figure class="ltx_table" id="S1.T1"><figcaption class="ltx_caption">T one</figcaption><table><tr><td>a &lt; b</td></tr></table></figure>
<figure class="ltx_table" id="S1.T10"><figcaption class="ltx_caption">T ten</figcaption><table></table></figure>
</body></html>"""

XML = """<r><article><front><article-title>A <i>title</i></article-title><abstract><p>Sum</p> mary</abstract>
<contrib contrib-type="author"><name><surname>Li</surname><given-names>An</given-names></name></contrib>
<contrib contrib-type="author"><collab>Group</collab></contrib>
<contrib contrib-type="editor"><name><surname>No</surname></name></contrib>
<pub-date><day>1</day><year>2020</year></pub-date><pub-date><year>2021</year></pub-date></front>
<p></p><p>Cites <xref ref-type="fig" rid="F1"/> and <xref rid="T1 T2">tables</xref></p>
<fig id="F1"><caption><p>Cap</p></caption></fig><table-wrap><table><tr/></table></table-wrap>
<table-wrap id="T1"><caption>Tab</caption></table-wrap></article></r>"""


@pytest.fixture
def html_objects(spark):
    papers = spark.createDataFrame([("2401.1", HTML), ("none", None)], "paper_id string, markup string")
    return extraction.extract_objects(papers, "html").cache()


def test_html_paragraphs(html_objects):
    rows = extraction.paragraphs(html_objects).orderBy("ordinal").collect()
    assert [r["paragraph_id"] for r in rows] == ["p1", "unknown_id", "p3"]
    assert rows[0]["text"] == ('See <a class="ltx_ref" href="#S1.T10">Table 10</a> &amp; '
                               '<a class="ltx_ref" href="#">x</a><br/>')
    assert rows[2]["text"] == ""


def test_html_figures_and_tables(html_objects):
    figures = extraction.figures(html_objects, "html").orderBy("ordinal").collect()
    assert [(f["figure_id"], f["caption"], f["image_url"]) for f in figures] == [
        ("F1", "Outer <b>one</b>", "https://arxiv.org/html/2401.1/a.png"),
        ("F2", "Inner", "https://arxiv.org/html/2401.1/b.png")]
    tables = extraction.tables(html_objects, "html").orderBy("ordinal").collect()
    assert [(t["table_id"], t["data"]) for t in tables] == [
        ("F4", "<table><tr><td>1</td></tr></table>"), ("S1.T1", "<table><tr><td>a &lt; b</td></tr></table>"),
        ("S1.T10", "<table></table>")]
    assert tables[1]["table_url"] == "https://arxiv.org/html/2401.1#S1.T1"


@pytest.mark.parametrize("exact, expected", [
    (False, [("S1.T1", "p1", 0), ("S1.T1", "unknown_id", 0), ("S1.T1", "unknown_id", 1), ("S1.T10", "p1", 0)]),
    (True, [("S1.T1", "unknown_id", 0), ("S1.T1", "unknown_id", 1), ("S1.T10", "p1", 0)]),
])
def test_substring_links(html_objects, exact, expected):
    refs = extraction.html_references(extraction.paragraphs(html_objects))
    links = extraction.link_objects(refs, html_objects.filter("kind <> 'paragraph'"), exact)
    assert sorted((r["object_id"], r["paragraph_id"], r["position"]) for r in links.collect()) == expected


def test_references_are_decoded(spark):
    text = """<a class="x ltx_ref" href="#S1&amp;x">1</a><a class='ltx_ref' href='#S2&lt;"'>2</a><a class="y" href="#no">3</a>"""
    paras = spark.createDataFrame([("p", "q", 1, text)], "paper_id string, paragraph_id string, ordinal int, text string")
    assert [r["reference"] for r in extraction.html_references(paras).orderBy("position").collect()] == ["S1&x", 'S2<"']


def test_referencing_text(html_objects):
    paras = extraction.paragraphs(html_objects)
    tables = html_objects.filter("kind = 'table'").select("paper_id", "object_id")
    links = extraction.link_objects(extraction.html_references(paras), tables)
    blobs = {r["object_id"]: r["blob_data"] for r in extraction.referencing_text(tables, links, paras).collect()}
    assert blobs == {"F4": "", "S1.T10": "See Table 10 &amp; x", "S1.T1": "See Table 10 &amp; x No id T1 T1"}
    maps = {r["paper_id"]: json.loads(r["links"]) for r in writers.link_maps(links).collect()}
    assert maps == {"2401.1": {"S1.T1": ["p1", "unknown_id", "unknown_id"], "S1.T10": ["p1"]}}


def test_links_against_brute_force(spark):
    """One paper with most rows: containment by parts equals the pairwise test."""
    refs = [("hot" if i % 3 else f"p{i % 4}", f"q{i}", i, 0, f"S{i % 7}.T{i % 23}-x") for i in range(300)]
    ids = [("hot" if i % 3 else f"p{i % 4}", f"T{i}" if i % 2 else f"S{i}.T") for i in range(40)] + [("hot", None)]
    got = extraction.link_objects(
        spark.createDataFrame(refs, "paper_id string, paragraph_id string, ordinal int, position int, reference string"),
        spark.createDataFrame(ids, "paper_id string, object_id string"))
    want = {(o, p) for pid, p, _, _, ref in refs for qid, o in ids if o and pid == qid and o in ref}
    assert {(r["object_id"], r["paragraph_id"]) for r in got.collect()} == want and want


def test_xml(spark):
    papers = spark.createDataFrame([("PMC1", XML), ("bad", "<a><b></a>")], "paper_id string, markup string")
    objects = extraction.extract_objects(papers, "xml").cache()
    paras = extraction.paragraphs(objects)
    assert [(r["paragraph_id"], r["text"]) for r in paras.orderBy("ordinal").collect()] == [
        ("PMC1_para_1", "Sum"),
        ("PMC1_para_3", 'Cites <xref ref-type="fig" rid="F1"/> and <xref rid="T1 T2">tables</xref>'),
        ("PMC1_para_4", "Cap")]
    assert extraction.figures(objects, "xml").collect()[0]["caption"] == "Cap"
    tables = extraction.tables(objects, "xml").orderBy("ordinal").collect()
    assert [(t["table_id"], t["caption"], t["data"]) for t in tables] == [
        (None, "", "<table><tr/></table>"), ("T1", "Tab", "")]
    links = extraction.link_objects(extraction.xml_references(paras), objects.filter("kind <> 'paragraph'"))
    assert sorted(r["object_id"] for r in links.collect()) == ["F1", "T1"]
    meta = feeds.article_metadata(papers).collect()
    assert [(m["title"], m["summary"], m["authors"], m["published"]) for m in meta] == [
        ("A title", "Sum mary", ["An Li"], "2020")]


def test_atom_feed(spark, tmp_path):
    (tmp_path / "feed.xml").write_text("""<feed xmlns="http://www.w3.org/2005/Atom">
<entry><id>http://arxiv.org/abs/1.2v3</id><title> T </title><summary>S</summary><published>2024-01-02T03:04:05Z</published>
<author><name>A</name></author><author><name>B</name></author><link rel="related" href="x"/>
<link rel="alternate" href="http://arxiv.org/abs/1.2v3"/></entry>
<entry><id>http://arxiv.org/abs/9</id><title>U</title><link rel="related" href="x"/><link rel="r" href="y"/></entry></feed>""")
    first, second = feeds.atom_entries(spark, str(tmp_path)).orderBy("paper_id").collect()
    assert (first["paper_id"], first["title"], first["authors"], first["html_link"]) == (
        "1.2v3", "T", ["A", "B"], "http://export.arxiv.org/html/1.2v3")
    assert (second["link"], second["html_link"], second["summary"]) == ("http://arxiv.org/abs/9", None, "")


def test_search_results(spark):
    page = """<ol><li class="arxiv-result"><p class="title is-5"> A <span>hit</span> B </p>
<span class="abstract-full has-text">Some <b>bold</b> text</span></li><li class="no"><p class="title">x</p></li></ol>"""
    rows = feeds.search_results(spark.createDataFrame([(1, page)], "page_id int, markup string")).collect()
    assert [(r["number"], r["title"], r["abstract"]) for r in rows] == [(1, "AB", "Someboldtext")]


def test_file_sources(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text, encoding="utf-8")

    put("a.txt", "Title: A\nAbstract: x")
    put("b.TXT", "none")
    put("p1.html", "<p>x</p>")
    put("p2.xml", "<p/>")
    put("p1.json", json.dumps({"title": "T", "authors": ["A"], "published": "2024"}, indent=2))
    put("p1_paragraphs.json", json.dumps([{"paper_id": "p1", "paragraph_id": "q", "text": "t"}], indent=1))
    put("p1_links.json", json.dumps({"F1": ["q", "q"], "F2": []}))
    folder = str(tmp_path)
    assert sorted((r["filename"], r["title"]) for r in files.text_papers(spark, folder).collect()) == [
        ("a.txt", "A"), ("b.TXT", "Unknown title")]
    assert files.text_papers(spark, folder + "/absent").count() == 0
    assert sorted(tuple(r)[:2] for r in files.markup_papers(spark, folder).collect()) == [("p1", "html"), ("p2", "xml")]
    meta = files.paper_metadata(spark, folder).collect()
    assert [(m["paper_id"], m["title"], m["summary"], m["authors"]) for m in meta] == [("p1", "T", "", ["A"])]
    assert files.paper_parts(spark, folder, "paragraphs").collect() == [("p1", "q", "t")]
    assert files.paper_links(spark, folder).collect() == [("p1", "F1", 0, "q"), ("p1", "F1", 1, "q")]


def test_line_sources(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text, encoding="utf-8")
        return str(tmp_path / name)

    notes = put("a.jsonl", '{"query_id": "", "id": "F1", "rank": 2, "relevance": 1}\n{"query": "q", "relevance": 0}\nbroken')
    assert sorted(tuple(r) for r in files.annotations(spark, notes).select("query_id", "rank", "relevance").collect()) == [
        ("F1", 2, 1), ("q", 0, 0)]
    grouped = put("g.json", '{"figures": [{"id": "F1", "query": "x"}], "tables": [{"query": "y", "index": "t"}]}')
    flat = put("f.json", '[{"query_id": "Q", "query": "z"}]')
    broken = put("b.json", '{"tables": [{"id": "T1"}],\n}')
    show = lambda p: [tuple(r) for r in files.query_sets(spark, p).select("query_id", "index", "query", "ok").collect()]
    assert show(grouped) == [("F1", "figures", "x", True), ("y", "t", "y", True)]
    assert show(flat) == [("Q", None, "z", True)]
    assert all(not r[3] or r[0] == "T1" for r in show(broken))
    pairs = put("p.txt", "COL a VAL x\tCOL a VAL y\t1\n\nbad line\n")
    assert [r["label"] for r in files.pair_lines(spark, pairs).collect()] == [1]
    log = put("log.txt", "run_a dk=False 17.068631\n")
    assert files.run_log(spark, log).collect() == [("run_a dk=False", 17.068631)]
    years = put("y.csv", "Year,Number of Papers\n1999,1\n2025,252\n")
    assert files.year_counts(spark, years).collect() == [("1999", 1), ("2025", 252)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "bad")], "id int, t string, reasons string")
    path = lambda n: str(tmp_path / n)
    writers.routed(df, F.col("reasons").isNull(), path("routed"), "reasons")
    assert {(r["route"], r["id"]) for r in spark.read.parquet(path("routed")).collect()} == {("kept", 1), ("rejected", 2)}
    writers.csv(df, path("csv"))
    assert files.csv(spark, path("csv"), df.schema.simpleString()[7:-1].replace(":", " ")).count() == 2
    writers.jsonl(df, path("json"))
    writers.jsonl(df, path("json"))
    assert spark.read.json(path("json")).count() == 4
    writers.lines(df, "t", path("lines"))
    assert sorted(r[0] for r in spark.read.text(path("lines")).collect()) == ["a", "b"]
    assert writers.load_checked(df, F.col("reasons").isNull(), path("load")) == (1, 1)
    writers.splits(df.withColumn("split", F.lit("train")), path("split"))
    assert (tmp_path / "split" / "split=train").is_dir()
    objects = spark.createDataFrame([("p", 2, "b"), ("p", 1, "a")], "paper_id string, ordinal int, v string")
    writers.json_lists(objects, path("lists"))
    got = spark.read.json(path("lists")).first()
    assert [o["v"] for o in json.loads(got["objects"])] == ["a", "b"]
    log = writers.run_entry(df, df.limit(1), df, "id", {"seed": "1"}).first()
    assert len(log["sizes"]) == 5 and log["params"] == {"seed": "1"}


def test_tables(spark):
    df = spark.range(3)
    writers.drop_table(spark, "corvane_test_t")
    writers.create_table(df, "corvane_test_t")
    writers.create_table(spark.range(9), "corvane_test_t")
    assert spark.table("corvane_test_t").count() == 3
    writers.create_table(spark.range(9), "corvane_test_t", replace=True)
    assert spark.table("corvane_test_t").count() == 9
    writers.drop_table(spark, "corvane_test_t")


def test_incremental_ingest(spark, tmp_path):
    landing, target, state = (str(tmp_path / n) for n in ("landing", "target", "state"))
    (tmp_path / "landing").mkdir()

    def land(**docs):
        for name, text in docs.items():
            (tmp_path / "landing" / name.replace("_", ".")).write_text(text)
        stream = ingest.new_papers(spark, landing)
        ingest.ingest(stream, "paper_id", "markup", target, state).awaitTermination()
        return sorted((r["paper_id"], r["markup"]) for r in spark.read.parquet(target).collect())

    assert land(a_html="1", b_xml="2", c_txt="no") == [("a", "1"), ("b", "2")]
    assert land(a_xml="other copy", d_html="3") == [("a", "1"), ("b", "2"), ("d", "3")]


def test_ingest_reads_touched_buckets_and_a_batch_can_run_twice(spark, tmp_path):
    target = str(tmp_path / "target")

    class Once:  # hands one batch to the function that a stream would call
        def __getattr__(self, name):
            return lambda *args, **_: setattr(self, "write", args[0]) or self if name == "foreachBatch" else self

    def batch(number, keys):
        source = Once()
        type("Stream", (), {})
        stream = type("Stream", (), {"writeStream": source})()
        ingest.ingest(stream, "k", "v", target, "none", buckets=64)
        source.write(spark.createDataFrame([(k, f"{number}") for k in keys], "k string, v string"), number)
        return {(r["k"], r["v"]) for r in spark.read.parquet(target).collect()}

    many = batch(0, [f"k{i}" for i in range(500)])
    assert len(many) == 500
    with_new = batch(1, ["k3", "new", "new", None])
    assert with_new == many | {("new", "1")}
    assert batch(1, ["k3", "new", None]) == with_new  # run again: its own rows are not in its way
    # buckets that the batch does not touch may be unreadable
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit("k7")), F.lit(64))).first()[0]
    for folder in (tmp_path / "target").glob("bucket=*"):
        if folder.name != f"bucket={bucket}":
            for file in folder.glob("*/part-*"):
                file.write_text("broken")
    source = Once()
    ingest.ingest(type("Stream", (), {"writeStream": source})(), "k", "v", target, "none", buckets=64)
    source.write(spark.createDataFrame([("k7", "2")], "k string, v string"), 2)


def test_existence_and_metadata_joins(spark):
    papers = spark.createDataFrame([("a",), ("b",)], "paper_id string")
    part = spark.createDataFrame([("a", 1), ("a", 2)], "paper_id string, x int")
    assert joins.complete_papers(papers, "paper_id", part, part).collect() == [("a",)]
    found = joins.attach_metadata(papers, part.limit(1), "paper_id")
    assert sorted((r["paper_id"], r["found"]) for r in found.collect()) == [("a", True), ("b", False)]
    assert [r[0] for r in joins.unseen(papers, part, "paper_id").collect()] == ["b"]


@pytest.mark.parametrize("n", [6, 60])
def test_context_paragraphs(spark, n):
    paras = spark.createDataFrame([("p", i, "common glyphosate dose") for i in range(n)]
                                  + [("p", n, "nothing shared here"), ("q", 0, "common table"), ("r", 0, "common")],
                                  "paper_id string, ordinal int, text string")
    objects = spark.createDataFrame([("p", "T1", "Glyphosate dose in common words")], "paper_id string, object_id string, text string")
    got = extraction.context_paragraphs(objects, paras).collect()
    assert sorted((r["ordinal"], r["n_shared"]) for r in got) == [(i, 2) for i in range(n)]


def test_rows_of_landed_texts_keep_other_columns(spark):
    def read(f, values, *how):
        return f(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, value string"), *how).orderBy("id").collect()

    assert read(files.run_log_rows, ["a b 1.5 ", " ", "a ?", None]) == [(0, "a b", 1.5), (2, "a", None)]
    assert [tuple(r) for r in read(files.csv_rows, ['1,"a, ""b"""', None, ""], "n int, t string")] == [
        (0, 1, 'a, "b"'), (1, None, None), (2, None, None)]
    assert [(r["id"], r["n"], r["_corrupt_record"]) for r in read(files.json_rows, ['{"n":1}', "{x"], "n int")] == [
        (0, 1, None), (1, None, "{x")]
    assert read(files.link_rows, ['{"f":["p","q"]}', "{}", None]) == [(0, "f", 0, "p"), (0, "f", 1, "q")]
    assert read(files.pair_rows, ["a\tb\tx", "a\tb", None, ""]) == [(0, "a\tb\tx", "a", "b", None)]
    assert [r["figure_id"] for r in read(files.part_rows, ['[{"figure_id":"f"}]', "no", "[]", None], "figures")] == ["f"]
    assert read(feeds.atom_rows, [None, "<feed/>"]) == []


def test_index_of_two_sources(spark):
    page = ('<p class="ltx_p" id="p1">see <a class="ltx_ref" href="#F1">it</a></p><figure class="ltx_figure" id="F1">'
            '<img src="a.png"/><figcaption class="ltx_caption">A <b>map</b></figcaption></figure>')
    article = '<root><p>no reference</p><fig id="F1"><caption>A plan</caption></fig></root>'
    found = {s: extraction.extract_objects(spark.createDataFrame([("x", m)], "paper_id string, markup string"), s)
             for s, m in (("html", page), ("xml", article))}
    rows = extraction.load_index("figure", **found).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["caption"], r["blob_data"]) for r in rows] == [
        ("html/x/F1", "A map", "see it"), ("xml/x/F1", "A plan", "")]


def test_article_rows_hold_one_tree_at_a_time(monkeypatch):
    from corvane.sources import feeds
    parsed = []
    real = feeds.parse_xml
    monkeypatch.setattr(feeds, "parse_xml", lambda m: parsed.append(m) or real(m))
    rows = feeds._article_rows(["1", "2", "3"], ["<r><article><article-title>x</article-title></article></r>", None, "<a/>"])
    assert next(rows)[:2] == ("1", "x") and len(parsed) == 1
    assert [r[0] for r in rows] == ["3"]


@pytest.mark.parametrize("source", ["html", "xml"])
def test_kinds_that_are_not_asked_are_not_read(spark, source):
    markup = ('<root><p class="ltx_p">t</p><figure class="ltx_figure" id="F1"><img src="a"/><figcaption class="ltx_caption">c</figcaption>'
              '</figure><fig id="F1"><caption>c</caption></fig></root>')
    papers = spark.createDataFrame([("x", markup)], "paper_id string, markup string")
    every = extraction.extract_objects(papers, source)
    some = extraction.extract_objects(papers, source, kinds=("paragraph", "table"))
    assert {r["kind"] for r in every.collect()} == {"paragraph", "figure"}
    assert sorted(map(str, some.collect())) == sorted(map(str, every.filter("kind <> 'figure'").collect()))


def test_objects_of_two_sources_are_stored_and_read_in_small_batches(spark):
    """A task holds a few MB of markup, and no executor keeps the texts of the objects."""
    from corvane import session
    from corvane.plans import corpus
    spark.conf.unset(session.BATCH)
    rows = corpus.index_tables(spark, "/root/testdata/sf0.001")
    assert spark.conf.get(session.BATCH) == f"{session.BATCH_BYTES}b"
    assert "InMemoryRelation" not in rows._jdf.queryExecution().optimizedPlan().toString()
