import math

import pytest
from pyspark.sql import functions as F

from corvane.functions.queries import explode_clauses
from corvane.operators import rank_metrics, search

DOCS = [(1, "deep learning", "learning deep nets"), (2, "sql engines", "deep deep sql"),
        (3, "maps", "climate maps of the deep sea"), (4, "", "")]
FIELDS = {"title": "standard", "abstract": "standard"}


@pytest.fixture
def index(spark):
    return search.Index(spark.createDataFrame(DOCS, "doc_id long, title string, abstract string"), FIELDS)


def ask(spark, *clauses):
    return spark.createDataFrame([(1, i, f, t) for i, (f, t) in enumerate(clauses)],
                                 "query_id int, clause int, field string, text string")


def test_bm25_by_hand(spark, index):
    clauses = ask(spark, ("abstract", "deep"))
    got = {r["doc_id"]: r["score"] for r in search.clause_scores(
        index, search.query_terms(clauses, FIELDS)).collect()}
    idf = math.log(1 + (3 - 3 + 0.5) / (3 + 0.5))
    want = {d: idf * tf / (tf + 1.2 * (0.25 + 0.75 * dl / 4)) for d, tf, dl in ((1, 1, 3), (2, 2, 3), (3, 1, 6))}
    assert got == pytest.approx(want)


def test_boolean_and_best_field(spark, index):
    clauses = ask(spark, ("title", "deep"), ("abstract", "deep"))
    scores = search.clause_scores(index, search.query_terms(clauses, FIELDS))
    assert [r["doc_id"] for r in search.top_hits(search.every_clause(scores, clauses)).collect()] == [1]
    assert {r["doc_id"] for r in search.any_clause(scores).collect()} == {1, 2, 3}
    best = {r["doc_id"]: r["score"] for r in search.best_field(scores).collect()}
    total = {r["doc_id"]: r["score"] for r in search.any_clause(scores).collect()}
    assert best[1] < total[1] and best[2] == total[2]


def test_large_query_set_gives_the_same_scores(spark, index):
    terms = search.query_terms(ask(spark, ("title", "deep maps"), ("abstract", "deep sql the")), FIELDS)
    rows = lambda limit: sorted((r["doc_id"], r["clause"], round(r["score"], 9))
                                for r in search.clause_scores(index, terms, limit).collect())
    assert rows(None) == rows(1 << 20)
    with pytest.raises(Exception, match="bytes to broadcast"):
        rows(10)


@pytest.mark.parametrize("query, found", [
    ('title:"deep" OR abstract:"sql"', {1, 2}), ('title:"deep" AND abstract:"nets"', {1}), ('title:"sql" maps', {2}),
    ("maps", {3}), ("cats OR dogs", set()), ('title:"deep" AND venue:"x"', set()),
    ("published:>=2020-02", {2, 3}), ("published:=2020", {1, 2}), ("published:=2020-02-01", {2}),
    ("published:>2020-02-01", {3}), ("published:<2020-02-01", {1}), ("published:<=2020-02-01", {1, 2}),
    ("published:=2020-13", set()), ("published:>=2020-13", set()), ("published:=1999", set()),
])
def test_run_by_kind(spark, query, found):
    days = ["2020-01-05", "2020-02-01", "2021-06-30", None]
    docs = spark.createDataFrame([(*d, day) for d, day in zip(DOCS, days)],
                                 "doc_id long, title string, abstract string, day string")
    asked = spark.createDataFrame([(1, query)], "query_id int, query string")
    index = search.Index(docs.withColumn("published", F.col("day").cast("date")), FIELDS)
    hits = search.run(index, asked, "published").collect()
    assert {r["doc_id"] for r in hits} == found and len(hits) == len(found)


@pytest.mark.parametrize("phrase, hits", [
    ("deep deep", {2: 1}), ("the deep sea", {3: 1}), ("deep sea the", {}), ("deep", {1: 1, 2: 2, 3: 1}),
    ("deep unknown", {}),
])
def test_phrases(spark, index, phrase, hits):
    got = search.phrase_matches(index, ask(spark, ("abstract", phrase)), FIELDS).collect()
    assert {r["doc_id"]: r["tf"] for r in got} == hits


def test_empty_clause_list_finds_nothing(spark):
    none = spark.createDataFrame([(1, [])], "query_id int, clauses array<struct<field:string,text:string>>")
    assert explode_clauses(none).count() == 0


def test_index_files(spark, index, tmp_path):
    search.write_postings(index.postings(), str(tmp_path / "ix"), 3)
    back = spark.read.parquet(str(tmp_path / "ix"))
    assert sorted(r["doc_id"] for r in back.filter("field = 'abstract' AND term = 'deep'").collect()) == [1, 2, 3]


# Stored judgements in rank order and the metrics they give.
JUDGEMENTS = {
    "papers": (["1111111111", "1111101111", "1110100111", "1001111110", "1010101100"], 0.76, 0.8365, 0.9288),
    "figures": (["0011111111", "1101010000", "0100100011", "1100111011", "1101110111"], 0.62, 0.7016, 0.8306),
    "tables": (["0001000101", "1110110101", "0100100000", "0110000001", "1101111111"], 0.48, 0.5906, 0.7366),
}


@pytest.mark.parametrize("name", JUDGEMENTS)
def test_stored_judgements(spark, name):
    lists, precision, mean_ap, ndcg = JUDGEMENTS[name]
    rows = [(f"q{i}", rank, int(rel)) for i, rels in enumerate(lists) for rank, rel in enumerate(rels, start=1)]
    got = rank_metrics.macro(rank_metrics.per_query(
        spark.createDataFrame(rows[::-1], "query_id string, rank int, relevance int"))).first()
    assert [round(got[c], 4) for c in ("precision", "map", "ndcg")] == [precision, mean_ap, ndcg]


def test_metrics_of_short_and_irrelevant_lists(spark):
    rows = [("a", 1, 1), ("a", 2, 0), ("b", 5, 0)]
    got = {r["query_id"]: r for r in rank_metrics.per_query(
        spark.createDataFrame(rows, "query_id string, rank int, relevance int")).collect()}
    assert (got["a"]["precision"], got["a"]["average_precision"], got["a"]["ndcg"]) == (0.5, 1.0, 1.0)
    assert (got["b"]["precision"], got["b"]["average_precision"], got["b"]["ndcg"]) == (0.0, 0.0, 0.0)


def test_annotate_counts_unjudged_as_zero(spark):
    hits = spark.createDataFrame([(1, 1, 7), (1, 2, 8)], "query_id int, rank int, doc_id int")
    judge = spark.createDataFrame([(1, 8, 1)], "query_id int, doc_id int, relevance int")
    assert {r["doc_id"]: r["relevance"] for r in rank_metrics.annotate(hits, judge).collect()} == {7: 0, 8: 1}
    assert rank_metrics.annotate(hits, judge).select(F.sum("relevance")).first()[0] == 1
