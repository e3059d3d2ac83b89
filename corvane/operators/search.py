"""Inverted index, BM25 and query evaluation over DataFrames.

An index is three tables: postings (field, term, doc_id, tf, positions), field lengths
(field, doc_id, dl) and field statistics (field, n_docs, avg_dl).  They can be written once and
read back, or stay lazy so that one search only touches the terms it asks for.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.functions.analysis import ANALYZERS
from corvane.functions.binding import token_counts, token_places
from corvane.functions.queries import explode_clauses, normalise_queries
from corvane.operators.joins import QUERY_BYTES, checked, salted_lookup

K1 = 1.2
B = 0.75
SCORE_DIGITS = 6  # scores are compared at this precision so that ranks do not depend on sum order


@dataclass
class Index:
    """Documents with one analyzer name per searched field."""

    docs: DataFrame
    fields: dict[str, str]
    id_col: str = "doc_id"

    def tokens(self) -> DataFrame:
        """One row per document and field: doc_id, field, tokens."""
        entries = F.array(*[
            F.struct(F.lit(name).alias("field"), ANALYZERS[analyzer](F.col(name)).alias("tokens"))
            for name, analyzer in self.fields.items()])
        return (self.docs.select(F.col(self.id_col).alias("doc_id"),
                                 F.explode_outer(entries).alias("e"))
                .select("doc_id", "e.field", "e.tokens"))

    def lengths(self) -> DataFrame:
        return self.tokens().select("field", "doc_id", F.size("tokens").cast("long").alias("dl"))

    def stats(self) -> DataFrame:
        return (self.lengths().filter(F.col("dl") > 0).groupBy("field")
                .agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avg_dl")))

    def occurrences(self) -> DataFrame:
        """One row per token occurrence: field, doc_id, dl, pos, term."""
        return (self.tokens()
                .select("field", "doc_id", F.size("tokens").cast("long").alias("dl"),
                        F.posexplode_outer("tokens").alias("pos", "term"))
                .filter(F.col("term").isNotNull()))

    def counts(self) -> DataFrame:
        """One row per distinct term of a document: field, doc_id, dl, term, tf.

        A document is one input row, so its terms are counted inside that row, without a shuffle.
        """
        return self._inlined(token_counts(F.col("tokens")))

    def postings(self) -> DataFrame:
        """Full inverted index with positions: field, doc_id, dl, term, tf, positions."""
        return self._inlined(token_places(F.col("tokens")))

    def _inlined(self, runs: Column) -> DataFrame:
        # the outer generator adds no size test that would compute the runs twice
        return (self.tokens()
                .select("field", "doc_id", F.size("tokens").cast("long").alias("dl"), F.inline_outer(runs))
                .filter(F.col("term").isNotNull()))


def write_postings(table: DataFrame, path: str, files: int, mode: str = "overwrite") -> None:
    """Index files sorted by term, so that a term lookup skips row groups.  The range also covers
    doc_id: a term found in every document is spread over several files."""
    (table.repartitionByRange(files, "field", "term", "doc_id")
          .sortWithinPartitions("field", "term", "doc_id")
          .write.mode(mode).parquet(path))


def term_frequencies(index: Index) -> DataFrame:
    """Document frequency and total occurrences of every term."""
    return index.counts().groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("doc_freq"), F.sum("tf").alias("total_freq"))


def idf(n_docs: Column, doc_freq: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - doc_freq + 0.5) / (doc_freq + 0.5))


def saturation(tf, dl, avg_dl):
    """Of columns or of arrays."""
    return tf / (tf + K1 * (B * dl / avg_dl + (1 - B)))


def analysed(field: Column, text: Column, analyzers: dict[str, str]) -> Column:
    """Tokens of a query text by the analyzer of its field; null for an unknown field."""
    tokens = None
    for name, analyzer in analyzers.items():
        done = ANALYZERS[analyzer](text)
        tokens = F.when(field == name, done) if tokens is None else tokens.when(field == name, done)
    return tokens


def query_terms(clauses: DataFrame, analyzers: dict[str, str]) -> DataFrame:
    """Analyse clause texts: query_id, clause, field, text -> query_id, clause, field, term, qtf."""
    tokens = analysed(F.col("field"), F.col("text"), analyzers)
    return (clauses.withColumn("term", F.explode_outer(tokens)).filter(F.col("term").isNotNull())
            .groupBy("query_id", "clause", "field", "term").agg(F.count(F.lit(1)).alias("qtf")))


def clause_scores(index: Index, terms: DataFrame, query_bytes: int | None = QUERY_BYTES) -> DataFrame:
    """Score of every clause in every document holding one of its terms:
    query_id, clause, field, doc_id, score.

    Only counts of asked terms leave the scan.  They are partitioned by document before the
    queries are joined in, so (query, document) rows are summed where they arise and are not
    shuffled.  Query terms are sent to every task; more than ``query_bytes`` of them are refused.
    None takes any number: they are joined with salted terms.
    """
    few = query_bytes is not None
    terms = checked(terms, query_bytes) if few else terms
    asked = terms.select("field", "term").distinct()
    if few:
        counts = index.counts().join(F.broadcast(asked), ["field", "term"], "left_semi")
    else:
        counts = salted_lookup(index.counts(), asked, ["field", "term"], ["doc_id"])
    counts = counts.repartition("doc_id")
    weights = (counts.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
               .join(index.stats(), "field")
               .join(terms, ["field", "term"])
               .select("field", "term", "query_id", "clause", "avg_dl",
                       (F.col("qtf") * idf(F.col("n_docs"), F.col("df"))).alias("w")))
    if few:  # one row per checked term
        matched = counts.join(F.broadcast(weights), ["field", "term"])
    else:
        matched = salted_lookup(counts, weights, ["field", "term"], ["doc_id"])
    part = F.col("w") * saturation(F.col("tf"), F.col("dl"), F.col("avg_dl"))
    return (matched.groupBy("doc_id", "query_id", "clause", "field")
            .agg(F.sum(part).alias("score")))


def any_clause(scores: DataFrame) -> DataFrame:
    """Boolean OR: a document's score is the sum over its matching clauses."""
    return scores.groupBy("doc_id", "query_id").agg(F.sum("score").alias("score"))


def every_clause(scores: DataFrame, clauses: DataFrame) -> DataFrame:
    """Boolean AND: all clauses of the query must match; scores add up."""
    wanted = clauses.groupBy("query_id").agg(F.count_distinct("clause").alias("n_clauses"))
    summed = scores.groupBy("doc_id", "query_id").agg(
        F.sum("score").alias("score"), F.count_distinct("clause").alias("n_hit"))
    return (summed.join(wanted, "query_id").filter(F.col("n_hit") == F.col("n_clauses"))
            .select("doc_id", "query_id", "score"))


def best_field(scores: DataFrame) -> DataFrame:
    """Multi-field match: the best field decides."""
    return scores.groupBy("doc_id", "query_id").agg(F.max("score").alias("score"))


def top_hits(scores: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, doc_id, score of the k best documents; equal scores go by doc_id.  Spark
    keeps k rows per query and task before the shuffle (WindowGroupLimit)."""
    rounded = scores.withColumn("score", F.round("score", SCORE_DIGITS))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return (rounded.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score"))


def run(index: Index, queries: DataFrame, published: str | None = None, k: int = 10) -> DataFrame:
    """query_id, rank, doc_id, score of a table of query strings (query_id, query), each by its kind.

    should: the sum over the clauses.  must: that sum where all clauses match.  match: the first
    clause.  multi_match: the best of all fields of the index.  date_eq, date_range: the documents
    whose ``published`` day lies in the period, with score 1; without that column none.  A clause on
    a field that the index lacks matches nothing, as does an invalid date.
    """
    asked = normalise_queries(queries)
    every = F.array(*[F.struct(F.lit(f).alias("field"), F.col("query").alias("text")) for f in index.fields])
    clauses = explode_clauses(asked.withColumn(
        "clauses", F.when(F.col("kind") == "multi_match", every).otherwise(F.col("clauses"))))
    wanted = (asked.select("query_id", "kind").join(
        clauses.groupBy("query_id").agg(F.count_distinct("clause").alias("n_clauses")), "query_id"))
    summed = (clause_scores(index, query_terms(clauses, index.fields)).groupBy("doc_id", "query_id")
              .agg(F.sum("score").alias("total"), F.max("score").alias("best"),
                   F.count_distinct("clause").alias("n_hit")).join(wanted, "query_id"))
    scores = (summed.filter((F.col("kind") != "must") | (F.col("n_hit") == F.col("n_clauses")))
              .select("query_id", "doc_id",
                      F.when(F.col("kind") == "multi_match", F.col("best")).otherwise(F.col("total")).alias("score")))
    if published is not None:
        scores = scores.unionByName(date_hits(index.docs, index.id_col, asked, published, k))
    return top_hits(scores, k)


def date_hits(docs: DataFrame, id_col: str, asked: DataFrame, published: str, k: int) -> DataFrame:
    """The k first documents of every day of a period.

    A period is spelt out in days, within those the documents have, so the join is by equality and
    meets at most k documents a day.
    """
    days = docs.select(F.col(id_col).alias("doc_id"), F.col(published).cast("date").alias("day")) \
        .filter(F.col("day").isNotNull())
    first = (days.withColumn("_rn", F.row_number().over(W.partitionBy("day").orderBy("doc_id")))
             .filter(F.col("_rn") <= k).drop("_rn"))
    span = days.agg(F.min("day").alias("low"), F.max("day").alias("high"))  # one row
    op, start, end = F.col("date_op"), F.col("date_from").cast("date"), F.col("date_to").cast("date")
    since = F.when(op == ">", F.date_add(start, 1)).otherwise(start)
    until = F.when((op == "<") | ((op == "=") & (end > start)), F.date_sub(end, 1)).otherwise(end)
    asked_days = (asked.filter(F.col("kind").isin("date_eq", "date_range")).join(F.broadcast(span))
                  .select("query_id", F.greatest("low", since).alias("since"), F.least("high", until).alias("until"))
                  .filter(F.col("since") <= F.col("until"))
                  .select("query_id", F.explode(F.sequence("since", "until")).alias("day")))
    return asked_days.join(first, "day").select("query_id", "doc_id", F.lit(1.0).alias("score"))


def hit_report(scores: DataFrame, queries: DataFrame) -> DataFrame:
    """Total hits per query, also for queries without any."""
    totals = scores.groupBy("query_id").agg(F.count(F.lit(1)).alias("total_hits"))
    return (queries.join(totals, "query_id", "left")
            .withColumn("total_hits", F.coalesce("total_hits", F.lit(0))))


def phrase_matches(index: Index, phrases: DataFrame, analyzers: dict[str, str],
                   query_bytes: int | None = QUERY_BYTES) -> DataFrame:
    """Exact phrases at consecutive positions: query_id, clause, field, doc_id, tf, dl, idf.

    ``phrases`` is query_id, clause, field, text.  The rarest term of a phrase proposes start
    positions; every other term must then be found at its place.  So the work follows the rarest
    term, also when the other terms stand in every document.  ``query_bytes`` as in clause_scores.
    """
    tokens = analysed(F.col("field"), F.col("text"), analyzers)
    places = (phrases.withColumn("tokens", tokens)
              .select("query_id", "clause", "field", F.size("tokens").alias("n"),
                      F.posexplode_outer("tokens").alias("offset", "term"))
              .filter(F.col("term").isNotNull()))
    sent = F.broadcast if query_bytes is not None else (lambda df: df)
    places = checked(places, query_bytes) if query_bytes is not None else places
    asked = sent(places.select("field", "term").distinct())
    known = (index.counts().join(asked, ["field", "term"], "left_semi")
             .groupBy("field", "term")
             .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("freq")))
    weights = (places.join(known, ["field", "term"]).join(index.stats(), "field")
               .groupBy("query_id", "clause", "field", "n", "avg_dl")
               .agg(F.count(F.lit(1)).alias("n_known"),
                    F.sum(idf(F.col("n_docs"), F.col("df"))).alias("idf"),
                    F.min(F.struct("freq", "offset", "term")).alias("anchor"))
               .filter(F.col("n_known") == F.col("n")))
    anchors = weights.select("query_id", "clause", "field", F.col("anchor.term").alias("term"),
                             F.col("anchor.offset").alias("anchor_offset"))
    starts = (index.occurrences().join(sent(anchors), ["field", "term"])
              .select("query_id", "clause", "field", "doc_id", "dl",
                      (F.col("pos") - F.col("anchor_offset")).alias("start"))
              .filter(F.col("start") >= 0))
    expected = (starts.join(places, ["query_id", "clause", "field"])
                .withColumn("pos", F.col("start") + F.col("offset")))
    holders = starts.select("field", "doc_id").distinct()
    seen = (index.occurrences().join(asked, ["field", "term"], "left_semi")
            .join(holders, ["field", "doc_id"], "left_semi")
            .select("field", "doc_id", "pos", "term"))
    found = expected.join(seen, ["field", "doc_id", "pos", "term"])
    whole = (found.groupBy("query_id", "clause", "field", "doc_id", "dl", "start", "n")
             .agg(F.count(F.lit(1)).alias("n_found"))
             .filter(F.col("n_found") == F.col("n")))
    return (whole.groupBy("query_id", "clause", "field", "doc_id", "dl")
            .agg(F.count(F.lit(1)).alias("tf"))
            .join(weights.select("query_id", "clause", "field", "idf", "avg_dl"),
                  ["query_id", "clause", "field"]))


def phrase_scores(matches: DataFrame) -> DataFrame:
    """BM25 of a phrase: the summed idf of its terms, the phrase count as term frequency."""
    return matches.select("query_id", "clause", "field", "doc_id",
                          (F.col("idf") * saturation(F.col("tf"), F.col("dl"), F.col("avg_dl")))
                          .alias("score"))


def keyword_hits(docs: DataFrame, column: str, queries: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Exact-match field: query_id and value -> query_id, doc_id."""
    return (docs.join(queries, docs[column] == queries["value"])
            .select("query_id", F.col(id_col).alias("doc_id")))


def load_report(lengths: DataFrame) -> DataFrame:
    """One row: documents indexed, documents without any term, tokens in total and per document."""
    ok = F.col("dl") > 0
    return lengths.agg(
        F.count_if(ok).alias("succeeded"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("failed"),
        F.sum("dl").alias("total_tokens"),
        F.round(F.sum("dl") / F.greatest(F.count_if(ok), F.lit(1)), 6).alias("mean_tokens"))


# The fields of each index that a query without a field asks.
DEFAULT_FIELDS = {
    "research_papers": ("title", "authors", "summary", "content"),
    "figures": ("figure_id", "caption", "paper_id", "url", "blob_data"),
    "tables": ("table_id", "description", "paper_id", "data", "table_url", "blob_data"),
}


def default_index(docs: DataFrame, kind: str, analyzer: str = "standard", id_col: str = "doc_id") -> Index:
    """An index over the default fields that ``docs`` has."""
    return Index(docs, {f: analyzer for f in DEFAULT_FIELDS[kind] if f in docs.columns}, id_col)


# What a result card shows per index, as (label, column).
CARDS = {
    "research_papers": (("title", "title"), ("authors", "authors"), ("published", "published"), ("link", "link")),
    "figures": (("figure_id", "figure_id"), ("caption", "caption"), ("link", "url")),
    "tables": (("table_id", "table_id"), ("caption", "caption"), ("link", "table_url")),
}
MISSING = "N/A"


def result_cards(hits: DataFrame, docs: DataFrame, kind: str, id_col: str = "doc_id") -> DataFrame:
    """Ranked hits with the columns shown for their index; absent values read ``N/A``."""
    def shown(column: str) -> Column:
        c = F.col(column)
        text = F.array_join(c, ", ") if dict(docs.dtypes)[column].startswith("array") else c.cast("string")
        return F.coalesce(text, F.lit(MISSING))

    cards = docs.select(id_col, *[shown(c).alias(name) for name, c in CARDS[kind] if c in docs.columns])
    return hits.join(cards, id_col)
