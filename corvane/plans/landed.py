"""Sources and sinks over the driver tables: rows are rendered in a landed form and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.plans.tables import table
from corvane.sinks import writers
from corvane.sources import feeds, files


def _id(spark, sf_dir, name="documents", key="doc_id"):
    return table(spark, sf_dir, name).withColumn("key", F.col(key).cast("string"))


def csv_lines(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return writers.csv_lines(c.select("c_custkey", F.concat("c_name", F.lit(', "x"')), "c_mktsegment"))


def csv_fields(spark, sf_dir):
    return files.csv_rows(csv_lines(spark, sf_dir), "c_custkey long, name string, segment string")


def stored_confusion(spark, sf_dir):
    """Confusion counts of label columns by source, written as CSV lines and read back."""
    flags = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    p, t = F.col("quality") == 1, F.col("toxic") == 1
    counts = flags.groupBy(F.col("source").alias("run")).agg(
        F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"), F.count_if(~p & t).alias("fn"),
        F.count_if(~p & ~t).alias("tn"))
    return files.csv_rows(writers.csv_lines(counts), files.CONFUSION)


def text_files(spark, sf_dir):
    path = F.concat(F.lit("/in/"), "key", F.lit("_a.TXT"))
    value = F.concat(F.lit("Title: "), "lang", F.lit("\nAbstract: "), "source", F.lit("\nReferences: none"))
    return files.text_rows(_id(spark, sf_dir).select(path.alias("path"), value.alias("value")))


def markup_files(spark, sf_dir):
    name = F.concat(F.lit("/in/p."), "key", F.when(F.col("page_id") % 3 == 0, ".xml").when(
        F.col("page_id") % 3 == 1, ".html").otherwise(".pdf"))
    pages = _id(spark, sf_dir, "pages", "page_id")
    return files.markup_rows(pages.select(name.alias("path"), F.col("html").alias("value")))


def metadata_files(spark, sf_dir):
    k = F.col("doc_id")
    path = F.concat(F.lit("/in/"), "key", F.when(k % 5 == 0, "_figures.json").otherwise(".json"))
    value = F.to_json(F.struct(F.when(k % 3 != 0, F.col("lang")).alias("title"),
                               F.when(k % 4 != 0, F.array("source", "lang")).alias("authors"),
                               F.lit("2024").alias("published")))
    found = files.metadata_rows(_id(spark, sf_dir).select(path.alias("path"), value.alias("value")))
    return found.withColumn("authors", F.array_join("authors", ", "))


def _figures(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_partkey").alias("part"))
    text = F.col("l_linenumber").cast("string")
    return lines.select(
        F.col("l_orderkey").cast("string").alias("paper_id"), F.col("l_linenumber").alias("ordinal"),
        F.concat(F.lit("f"), text).alias("figure_id"), F.concat(F.lit('part "'), "part", F.lit('"')).alias("caption"),
        F.concat(F.lit("u/"), text).alias("url"), F.concat(text, F.lit(".png")).alias("image_url"))


def object_lists(spark, sf_dir):
    return writers.object_lists(_figures(spark, sf_dir))


def object_list_rows(spark, sf_dir):
    return files.part_rows(object_lists(spark, sf_dir), "figures", "objects")


def link_map_rows(spark, sf_dir):
    ids = F.transform(F.sequence(F.lit(0), F.col("doc_id") % 4), lambda i: F.concat(F.lit("p"), i))
    maps = table(spark, sf_dir, "documents").select("doc_id", F.to_json(F.create_map(
        F.lit("f1"), ids, F.concat(F.lit("t"), "doc_id"), F.array(F.lit("q")))).alias("value"))
    return files.link_rows(maps).withColumn("position", F.col("position").cast("long"))


def json_lines(spark, sf_dir):
    return writers.json_lines(table(spark, sf_dir, "labels"))


def annotation_lines(spark, sf_dir):
    """Labels as annotations; every seventh line is broken, query ids stand in one of three keys."""
    k = F.col("doc_id")
    line = F.to_json(F.struct(
        F.when(k % 3 == 0, k.cast("string")).alias("query_id"), F.when(k % 3 == 1, F.concat(F.lit("i"), k)).alias("id"),
        F.concat(F.lit("q"), k).alias("query"), F.lit("papers").alias("index"), k.cast("string").alias("result_id"),
        F.when(k % 2 == 0, F.lit(3)).alias("rank"), F.col("quality").alias("relevance")))
    lines = table(spark, sf_dir, "labels").select(F.when(k % 7 == 0, F.concat(F.lit("{"), line)).otherwise(line).alias("value"))
    read = files.judgements(files.json_rows(lines, files.ANNOTATION))
    return read.withColumn("rank", F.col("rank").cast("long")).withColumn("relevance", F.col("relevance").cast("long"))


def query_set_files(spark, sf_dir):
    k, text = F.col("item_id"), F.col("text").alias("query")
    listed = F.to_json(F.array(F.struct(F.concat(F.lit("b"), k).alias("id"), text, F.lit("figures").alias("index"))))
    grouped = F.to_json(F.create_map(F.lit("papers"), F.array(
        F.struct(text, F.lit("body").alias("query_body")), F.struct(F.lit("second").alias("query"), F.lit(None).cast("string").alias("query_body")))))
    value = F.when(k % 3 == 0, listed).when(k % 3 == 1, grouped).otherwise("neither")
    return files.query_set_rows(table(spark, sf_dir, "benchmark").select("item_id", value.alias("value")))


def pair_lines(spark, sf_dir):
    k = F.col("doc_id")
    line = (F.when(k % 7 == 0, "  ").when(k % 7 == 1, F.concat("lang", F.lit("\t"), "source"))
            .otherwise(F.concat("lang", F.lit("\t"), "source", F.lit("\t "), F.when(k % 7 == 2, "x").otherwise("1"))))
    read = files.pair_rows(table(spark, sf_dir, "documents").select("doc_id", line.alias("value")))
    return read.withColumn("label", F.col("label").cast("long"))


def run_log_lines(spark, sf_dir):
    k = F.col("o_orderkey")
    line = F.concat("o_orderpriority", F.lit(" run "), F.when(k % 11 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")),
                    F.lit(" "))
    return files.run_log_rows(table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(k % 13 == 0, " ").otherwise(line).alias("value")))


def feed_entries(spark, sf_dir):
    """Documents as feeds of two entries, the second without a link."""
    def tag(name, *body):
        return F.concat(F.lit(f"<{name}>"), *body, F.lit(f"</{name}>"))

    author = tag("author", tag("name", F.col("source")))
    link = F.concat(F.lit('<link rel="alternate" href="https://arxiv.org/abs/'), "key", F.lit('"/><link rel="related" href="x"/>'))
    first = tag("entry", tag("id", F.lit("http://a/"), F.col("key")), tag("title", F.lit(" "), F.col("lang"), F.lit("\n")),
                tag("summary", F.lit("x &amp; y")), tag("published", F.lit("2024-01-01T00:00:00Z")), author, author, link)
    second = tag("entry", tag("id", F.lit("http://a/b"), F.col("key")), tag("title", F.col("source")))
    docs = _id(spark, sf_dir).select("doc_id", tag("feed", first, second).alias("value"))
    return feeds.atom_rows(docs).withColumn("authors", F.array_join("authors", ", "))


def result_pages(spark, sf_dir):
    def item(n):
        return F.concat(F.lit('<li class="arxiv-result"><p class="title is-5"> '), "lang", F.lit(f" {n}"),
                        F.lit('</p><p>no</p><span class="abstract-full"> '), "source", F.lit(" </span></li>"))

    markup = F.concat(F.lit("<html><ol>"), item(1), F.lit("<li>other</li>"), item(2), F.lit("</ol></html>"))
    found = feeds.search_results(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), markup.alias("markup")))
    return found.withColumn("number", F.col("number").cast("long"))


def routed_rows(spark, sf_dir):
    return writers.routes(table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("reason")),
                          F.col("doc_id") % 3 == 0, "reason")


def load_counts(spark, sf_dir):
    ok = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice") > 100000)
    return writers.load_counts(table(spark, sf_dir, "orders"), ok)


def run_entry(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    good = labels.filter("quality = 1")
    entry = writers.run_entry(labels, good, good.filter("toxic = 0"), "toxic", {"seed": "42", "budget": "2"})
    sizes = F.transform("sizes", lambda x: F.concat_ws(":", x["stage"], x["label"], x["n"].cast("string")))
    return entry.select(F.array_join(sizes, ",").alias("sizes"), F.to_json("params").alias("params"))


QUERIES = {f.__name__: f for f in (
    csv_lines, csv_fields, stored_confusion, text_files, markup_files, metadata_files, object_lists,
    object_list_rows, link_map_rows, json_lines, annotation_lines, query_set_files, pair_lines, run_log_lines,
    feed_entries, result_pages, routed_rows, load_counts, run_entry)}


# --- oracles ---------------------------------------------------------------------------------
_FIGURES = """fg AS (SELECT l_orderkey AS k, l_linenumber AS n, max(l_partkey) AS part FROM lineitem GROUP BY ALL)"""

ORACLES = {
    "csv_lines": """SELECT c_custkey || ',' || chr(34) || c_name || ', ' || repeat(chr(34), 2) || 'x'
        || repeat(chr(34), 3) || ',' || c_mktsegment AS value FROM customer""",
    "csv_fields": """SELECT c_custkey, c_name || ', "x"' AS name, c_mktsegment AS segment FROM customer""",
    "stored_confusion": """SELECT source AS run, count(*) FILTER (quality = 1 AND toxic = 1) AS tp,
        count(*) FILTER (quality = 1 AND toxic <> 1) AS fp, count(*) FILTER (quality <> 1 AND toxic = 1) AS fn,
        count(*) FILTER (quality <> 1 AND toxic <> 1) AS tn FROM labels JOIN documents USING (doc_id) GROUP BY source""",
    "text_files": """SELECT '/in/' || doc_id || '_a.TXT' AS path, doc_id || '_a.TXT' AS filename, lang AS title,
        source AS abstract FROM documents""",
    "markup_files": """SELECT 'p.' || page_id AS paper_id, CASE page_id % 3 WHEN 0 THEN 'xml' ELSE 'html' END AS source,
        html AS markup FROM pages WHERE page_id % 3 < 2""",
    "metadata_files": """SELECT CAST(doc_id AS VARCHAR) AS paper_id, CASE WHEN doc_id % 3 <> 0 THEN lang ELSE '' END AS title,
        CASE WHEN doc_id % 4 <> 0 THEN source || ', ' || lang ELSE '' END AS authors, '2024' AS published,
        '' AS summary, '' AS link FROM documents WHERE doc_id % 5 <> 0""",
    "object_lists": f"""WITH {_FIGURES} SELECT CAST(k AS VARCHAR) AS paper_id, '[' || string_agg('{{"paper_id":"' || k
        || '","figure_id":"f' || n || '","caption":"part \\"' || part || '\\"","url":"u/' || n || '","image_url":"' || n
        || '.png"}}', ',' ORDER BY n) || ']' AS objects FROM fg GROUP BY k""",
    "object_list_rows": f"""WITH {_FIGURES} SELECT CAST(k AS VARCHAR) AS paper_id, 'f' || n AS figure_id,
        'part "' || part || '"' AS caption, 'u/' || n AS url, n || '.png' AS image_url FROM fg""",
    "link_map_rows": """SELECT doc_id, 'f1' AS object_id, CAST(i AS BIGINT) AS position, 'p' || i AS paragraph_id
        FROM documents, range(4) r(i) WHERE i <= doc_id % 4
        UNION ALL SELECT doc_id, 't' || doc_id, 0, 'q' FROM documents""",
    "json_lines": """SELECT '{"doc_id":' || doc_id || ',"quality":' || quality || ',"toxic":' || toxic || '}' AS value
        FROM labels""",
    "annotation_lines": """SELECT CASE WHEN doc_id = 0 OR doc_id % 3 = 2 THEN 'q' WHEN doc_id % 3 = 1 THEN 'i' ELSE '' END
        || doc_id AS query_id, 'papers' AS index, CAST(doc_id AS VARCHAR) AS result_id,
        CAST(CASE WHEN doc_id % 2 = 0 THEN 3 ELSE 0 END AS BIGINT) AS rank, CAST(quality AS BIGINT) AS relevance
        FROM labels WHERE doc_id % 7 <> 0""",
    "query_set_files": """SELECT item_id, CASE WHEN item_id % 3 = 0 THEN 'b' || item_id WHEN item_id % 3 = 1 THEN text END
          AS query_id, CASE item_id % 3 WHEN 0 THEN 'figures' WHEN 1 THEN 'papers' END AS index,
          CASE WHEN item_id % 3 < 2 THEN text END AS query, CASE WHEN item_id % 3 = 1 THEN 'body' END AS query_body,
          item_id % 3 < 2 AS ok FROM benchmark
        UNION ALL SELECT item_id, 'second', 'papers', 'second', NULL, true FROM benchmark WHERE item_id % 3 = 1""",
    "pair_lines": """SELECT doc_id, lang || chr(9) || source || chr(9) || CASE doc_id % 7 WHEN 2 THEN ' x' ELSE ' 1' END
        AS line, lang AS left, source AS right, CAST(CASE WHEN doc_id % 7 <> 2 THEN 1 END AS BIGINT) AS label
        FROM documents WHERE doc_id % 7 >= 2""",
    "run_log_lines": """SELECT o_orderkey, o_orderpriority || ' run' AS tag,
        CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS seconds FROM orders
        WHERE o_orderkey % 13 <> 0""",
    "feed_entries": """SELECT doc_id, CAST(doc_id AS VARCHAR) AS paper_id, lang AS title, 'x & y' AS summary,
          '2024-01-01T00:00:00Z' AS published, source || ', ' || source AS authors,
          'https://arxiv.org/abs/' || doc_id AS link, 'https://export.arxiv.org/html/' || doc_id AS html_link FROM documents
        UNION ALL SELECT doc_id, 'b' || doc_id, source, '', '', '', 'http://a/b' || doc_id, NULL FROM documents""",
    "result_pages": """SELECT CAST(doc_id AS VARCHAR) AS page_id, CAST(n AS BIGINT) AS number,
        lang || ' ' || n AS title, source AS abstract FROM documents, range(1, 3) r(n)""",
    "routed_rows": """SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN lang END AS reason,
        CASE WHEN doc_id % 3 = 0 THEN 'kept' ELSE 'rejected' END AS route FROM documents""",
    "load_counts": """SELECT count(*) FILTER (o_orderkey % 5 <> 0 AND o_totalprice > 100000) AS written,
        count(*) FILTER (o_orderkey % 5 = 0 OR o_totalprice <= 100000) AS refused FROM orders""",
    "run_entry": """WITH s AS (SELECT 'initial' AS stage, toxic FROM labels
          UNION ALL SELECT 'post_budget', toxic FROM labels WHERE quality = 1
          UNION ALL SELECT 'final', toxic FROM labels WHERE quality = 1 AND toxic = 0),
        c AS (SELECT stage, toxic, count(*) AS n FROM s GROUP BY ALL)
        SELECT string_agg(stage || ':' || toxic || ':' || n, ',' ORDER BY stage, toxic) AS sizes,
               '{"budget":"2","seed":"42"}' AS params FROM c""",
}
