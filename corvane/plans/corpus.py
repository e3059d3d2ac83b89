"""Corpus queries: markup cleaning, extraction, citation links, paper metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import cleaning
from corvane.operators import extraction, joins
from corvane.plans import sqltext as sql
from corvane.plans.tables import papers, spread_table, table
from corvane.session import materialise, stored
from corvane.sinks import writers
from corvane.sources import feeds
from corvane.streaming import ingest


def tag_strip(spark, sf_dir):
    return spread_table(spark, sf_dir, "pages", "page_id").select("page_id", cleaning.strip_tags(F.col("html")).alias("text"))


def html_paragraphs(spark, sf_dir):
    return extraction.flat_elements(spread_table(spark, sf_dir, "pages", "page_id"), "p", "page_id", "html")


def page_title(spark, sf_dir):
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    return spread_table(spark, sf_dir, "pages", "page_id").select(
        "page_id", F.coalesce(F.nullif(cleaning.strip_tags(title), F.lit("")), F.lit("N/A")).alias("title"))


def html_links(spark, sf_dir):
    pages = spread_table(spark, sf_dir, "pages", "page_id").select(
        F.col("page_id").cast("string").alias("paper_id"), F.lit("page").alias("paragraph_id"),
        F.lit(1).alias("ordinal"), F.col("html").alias("text"))
    return extraction.html_references(pages, None).select(
        "paper_id", F.col("position").cast("long").alias("position"), "reference")


def _page_objects(spark, sf_dir):
    every_p = lambda root, paper: extraction.html_paragraphs(root, paper, None)
    pages = spread_table(spark, sf_dir, "pages", "page_id").select("page_id", F.col("html").alias("markup")) \
        .withColumnRenamed("page_id", "paper_id")
    return extraction.extract_objects(pages, "html", {"paragraph": every_p})


def html_tree_objects(spark, sf_dir):
    return _page_objects(spark, sf_dir).select(
        "paper_id", "kind", F.col("ordinal").cast("long").alias("ordinal"), "object_id",
        cleaning.strip_tags(F.col("body")).alias("text"))


def html_tree_counts(spark, sf_dir):
    return (_page_objects(spark, sf_dir).groupBy("paper_id", "kind", "object_id")
            .agg(F.count(F.lit(1)).alias("n")))


# Documents as article XML: each line is a paragraph citing a figure; 12 figures, two tables.
BAD_XML = r"[^\x09\x0A\x0D\x20-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]"


def _escape(text):
    clean = F.regexp_replace(text, BAD_XML, "")
    return F.replace(F.replace(F.replace(clean, F.lit("&"), F.lit("&amp;")),
                               F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def articles(spark, sf_dir):
    """paper_id, markup."""
    docs = papers(spark, sf_dir).select(
        "doc_id", "lang", "source", F.split(_escape(F.regexp_replace("text", "\r", " ")), "\n").alias("l"))
    title = F.get("l", F.lit(0))
    body = F.array_join(F.transform("l", lambda x, i: F.concat(
        F.lit("<p>"), x, F.lit('<xref rid="f'), (i % 13).cast("string"), F.lit('"/></p>'))), "")
    figures = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(12)), lambda j: F.concat(
        F.lit('<fig id="f'), j.cast("string"), F.lit('"><caption><title>Figure <b>'), j.cast("string"),
        F.lit("</b></title> "), title, F.lit('</caption><img src="'), j.cast("string"),
        F.lit('.png"/></fig>'))), "")
    cell = F.concat(F.lit("<table><tr><td>"), "lang", F.lit("</td></tr></table>"))
    tables = F.concat(F.lit('<table-wrap id="t1"><caption>Language</caption>'), cell,
                      F.lit("</table-wrap><table-wrap>"), cell, F.lit("</table-wrap>"))
    author = F.concat(
        F.lit('<contrib contrib-type="author"><name><surname>'), "source",
        F.lit('</surname><given-names>'), "lang", F.lit("</given-names></name></contrib>"
              '<contrib contrib-type="author"><name/></contrib><contrib contrib-type="editor"><name>'
              "<surname>Nobody</surname></name></contrib>"))
    year = (F.lit(2000) + F.col("doc_id") % 25).cast("string")
    markup = F.concat(
        F.lit("<root><article><article-title>"), title, F.lit("<sup>*</sup></article-title>"), author,
        F.lit("<pub-date><year>"), year, F.lit("</year></pub-date><pub-date><year>1900</year></pub-date>"
              "<abstract><title>Summary:</title> "), F.coalesce(F.get("l", F.lit(1)), F.lit("")),
        F.lit("</abstract>"), body, figures, tables, F.lit("</article></root>"))

    return docs.select(F.col("doc_id").cast("string").alias("paper_id"), markup.alias("markup"))


def _objects(spark, sf_dir):
    return materialise(extraction.extract_objects(articles(spark, sf_dir), "xml"))


def xml_paragraphs(spark, sf_dir):
    return extraction.paragraphs(extraction.extract_objects(articles(spark, sf_dir), "xml")).select(
        "paper_id", "paragraph_id", "text")


def xml_figures(spark, sf_dir):
    found = extraction.extract_objects(articles(spark, sf_dir), "xml")
    return extraction.figures(found, "xml").drop("ordinal")


def xml_tables(spark, sf_dir):
    found = extraction.extract_objects(articles(spark, sf_dir), "xml")
    return extraction.tables(found, "xml").drop("ordinal")


def article_metadata(spark, sf_dir):
    return feeds.article_metadata(articles(spark, sf_dir)).withColumn(
        "authors", cleaning.display_names(F.col("authors")))


def two_sources(spark, sf_dir, kind):
    """Paragraphs and objects of a kind, of documents with an even id as HTML papers, of the others as
    article XML.  Every line is a paragraph, the caption of a figure and of a table, and cites both."""
    docs = papers(spark, sf_dir).select("doc_id", F.col("doc_id").cast("string").alias("paper_id"), "lang", F.split(
        _escape(F.regexp_replace("text", "\r", " ")), "\n").alias("l"))

    def each(*parts):
        def one(x, i):
            n = (i + 1).cast("string")
            return F.concat(*[{"#": n, "@": x, "~": F.col("lang")}.get(p, F.lit(p)) for p in parts])
        return F.array_join(F.transform("l", one), "")

    cell = ("<table><tr><td>", "~", "</td></tr></table>")
    html = each('<p class="ltx_p" id="p', "#", '">', "@", ' <a class="ltx_ref" href="#F', "#", 'x">F</a> '
                '<a class="ltx_ref" href="#T', "#", 'x">T</a></p><figure class="ltx_figure" id="F', "#", 'x"><img src="', "#",
                '.png"/><figcaption class="ltx_caption">Figure <b>', "#", "</b> ", "@",
                '</figcaption></figure><figure class="ltx_table" id="T', "#", 'x"><figcaption class="ltx_caption">', "@",
                "</figcaption>", *cell, "</figure>")
    xml = each("<p>", "@", ' <xref rid="F', "#", 'x"/><xref rid="T', "#", 'x"/></p><fig id="F', "#",
               'x"><caption>Figure <b>', "#", "</b> ", "@", '</caption><img src="', "#", '.png"/></fig><table-wrap id="T', "#",
               'x"><caption>', "@", "</caption>", *cell, "</table-wrap>")
    even = F.col("doc_id") % 2 == 0
    pages = docs.filter(even).select("paper_id", F.concat(F.lit("<html><body>"), html, F.lit("</body></html>")).alias("markup"))
    articles = docs.filter(~even).select("paper_id", F.concat(F.lit("<root>"), xml, F.lit("</root>")).alias("markup"))
    # the texts of all objects are larger than the documents: they are stored, compressed, and read by each step
    return {source: stored(extraction.extract_objects(docs, source, kinds=("paragraph", kind)), f"objects-{source}")
            for source, docs in (("html", pages), ("xml", articles))}


def index_figures(spark, sf_dir):
    return extraction.load_index("figure", **two_sources(spark, sf_dir, "figure")).drop("ordinal")


def index_tables(spark, sf_dir):
    return extraction.load_index("table", **two_sources(spark, sf_dir, "table")).drop("ordinal")


def _links(objects):
    refs = extraction.xml_references(extraction.paragraphs(objects))
    return extraction.link_objects(refs, objects.filter("kind <> 'paragraph'"))


def substring_link(spark, sf_dir):
    return _links(_objects(spark, sf_dir)).select("paper_id", "object_id", "paragraph_id")


def link_text_blob(spark, sf_dir):
    objects = _objects(spark, sf_dir)
    figures = extraction.figures(objects, "xml").select("paper_id", F.col("figure_id").alias("object_id"))
    return extraction.referencing_text(figures, _links(objects), extraction.paragraphs(objects))


def link_maps(spark, sf_dir):
    return writers.link_maps(_links(_objects(spark, sf_dir)))


def context_paragraphs(spark, sf_dir):
    docs = papers(spark, sf_dir)
    paras = docs.select(F.col("doc_id").alias("paper_id"),
                        F.posexplode(F.split("abstract", "\n")).alias("ordinal", "text"))
    captions = docs.select(F.col("doc_id").alias("paper_id"), F.lit("title").alias("object_id"),
                           F.col("title").alias("text"))
    return extraction.context_paragraphs(captions, paras).select(
        "paper_id", "object_id", F.col("ordinal").cast("long").alias("ordinal"), "n_shared")


def title_section_extract(spark, sf_dir):
    text = F.concat(F.lit("\n  TITLE: "), "title", F.lit("\n\nAbstract: "), "abstract",
                    F.lit("\nKeywords: search\nnot part of it"))
    docs = papers(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 7 != 0, text)
                                        .otherwise(F.col("text")).alias("value"))
    return cleaning.add_title_and_abstract(docs).drop("value")


def clean_text_strict(spark, sf_dir):
    return spread_table(spark, sf_dir, "documents", "doc_id").select("doc_id", cleaning.strict_clean(F.col("text")).alias("text"))


def clean_text_loose(spark, sf_dir):
    return spread_table(spark, sf_dir, "documents", "doc_id").select("doc_id", cleaning.loose_clean(F.col("text")).alias("text"))


def count_by_year(spark, sf_dir):
    day = F.when(F.col("o_orderkey") % 9 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("")
    return (table(spark, sf_dir, "orders").groupBy(cleaning.published_year(day).alias("year"))
            .agg(F.count(F.lit(1)).alias("papers")).orderBy("year"))


def author_names(spark, sf_dir):
    given = F.array(F.col("c_name"), F.lit(""), F.lit(None))
    surname = F.array(F.col("c_mktsegment"), F.lit(""), F.lit("Li"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", cleaning.display_names(cleaning.full_names(given, surname)).alias("authors"))


def derived_urls(spark, sf_dir):
    paper, link = F.col("doc_id").cast("string"), F.concat(F.lit("https://arxiv.org/abs/"), "source")
    return papers(spark, sf_dir).select(
        "doc_id", cleaning.html_object_url(paper, F.col("lang")).alias("object_url"),
        cleaning.html_image_url(paper, F.lit("x1.png")).alias("image_url"),
        cleaning.xml_object_url(paper, F.col("lang")).alias("xml_url"),
        cleaning.xml_landing_url(paper).alias("landing_url"), cleaning.mirror_url(link).alias("mirror_url"),
        cleaning.safe_file_name(F.col("doc_id"), F.col("title")).alias("file_name"))


def first_filled_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey").cast("string")).otherwise("")
    b = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus"))
    return o.select("o_orderkey", cleaning.first_filled(a, b, F.lit("none")).alias("query_id"))


def metadata_join(spark, sf_dir):
    docs = papers(spark, sf_dir).select("doc_id", "title")
    meta = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("quality"))
    return joins.attach_metadata(docs, meta, "doc_id")


def complete_papers(spark, sf_dir):
    docs = papers(spark, sf_dir).select("doc_id", "lang")
    judged = table(spark, sf_dir, "labels")
    talked = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"))
    return joins.complete_papers(docs, "doc_id", judged, talked)


def incremental_ingest(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    seen = events.filter("event_type = 'error' AND value >= 150").select("user_id")
    first = ingest.first_of_batch(events.select("user_id", "event_id", "event_type"), "user_id", "event_id")
    return joins.unseen(first, seen, "user_id")


def stage_durations(spark, sf_dir):
    """Ship dates as shell ``date`` output, one hour and a bit apart per line number."""
    stamp = lambda c: F.concat(F.date_format(c, "EEE MMM dd hh:mm:ss a"), F.lit(" CET "),
                               F.date_format(c, "yyyy"))
    end = F.timestamp_seconds(F.col("l_shipdate").cast("timestamp").cast("double") + F.col("l_linenumber") * 3661)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", stamp(F.col("l_shipdate")).alias("a"), stamp(end).alias("b"))
    return lines.groupBy(F.col("l_linenumber").cast("long").alias("stage")).agg(
        F.sum(cleaning.duration_seconds(F.col("a"), F.col("b"))).cast("long").alias("seconds"))


def canonical_lines(spark, sf_dir):
    line = F.concat(F.lit("  "), "title", F.lit(" \t "), "lang", F.lit("\t 1 "))
    return papers(spark, sf_dir).select("doc_id", cleaning.canonical_line(line).alias("line"))


QUERIES = {f.__name__: f for f in (
    tag_strip, html_paragraphs, page_title, html_links, html_tree_objects, html_tree_counts,
    xml_paragraphs, xml_figures, xml_tables, article_metadata, substring_link, link_text_blob,
    link_maps, context_paragraphs, title_section_extract, clean_text_strict, clean_text_loose,
    count_by_year, author_names, derived_urls, first_filled_key, metadata_join, complete_papers,
    incremental_ingest, stage_durations, canonical_lines, index_figures, index_tables)}


# --- oracles ---------------------------------------------------------------------------------
def _strip(x):
    return rf"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _bare(x):
    return _strip(rf"translate(regexp_replace({x}, '<[^\n]*?>', '', 'g'), chr(10) || chr(13), '  ')")


def _esc(x):
    clean = (rf"regexp_replace({x}, '[^\x09\x0A\x0D\x20-\x{{D7FF}}\x{{E000}}-\x{{FFFD}}"
             rf"\x{{10000}}-\x{{10FFFF}}]', '', 'g')")
    return f"replace(replace(replace({clean}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


_LINES = f"""ln AS (SELECT doc_id, lang, source,
  string_split({_esc("replace(text, chr(13), ' ')")}, chr(10)) AS l,
  string_split(regexp_replace(replace(text, chr(13), ' '),
    '[^\\x09\\x0A\\x0D\\x20-\\x{{D7FF}}\\x{{E000}}-\\x{{FFFD}}\\x{{10000}}-\\x{{10FFFF}}]', '', 'g'),
    chr(10)) AS raw FROM documents)"""
_PARAS = f"""{_LINES}, pr AS (SELECT CAST(doc_id AS VARCHAR) AS paper_id, i,
  doc_id || '_para_' || i AS paragraph_id, 'f' || ((i - 1) % 13) AS ref,
  {_strip("x || '<xref rid=\"f' || ((i - 1) % 13) || '\"/>'")} AS text
  FROM (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM ln) y)"""
_FIGS = "fg AS (SELECT DISTINCT paper_id, 'f' || unnest(range(1, 13)) AS object_id FROM pr)"
_LINKS = f"""{_PARAS}, {_FIGS}, lk AS (SELECT paper_id, object_id, paragraph_id, i, text
  FROM pr JOIN fg USING (paper_id) WHERE contains(ref, object_id)
  UNION ALL SELECT paper_id, 't1', paragraph_id, i, text FROM pr WHERE contains(ref, 't1'))"""
_HEADING = (r"(?i)^(introduction|1\.|i\.|references|keywords|acknowledgments|conclusion|conclusions)"
            r"[:\s].*")


def _control_trim(x):
    return rf"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


_OBJECTS = f"""{_LINES}, ob AS (SELECT CAST(doc_id AS VARCHAR) AS paper_id, lang, i, x, r,
    CASE WHEN doc_id % 2 = 0 THEN 'html' ELSE 'xml' END AS source FROM (SELECT doc_id, lang, unnest(l) AS x, unnest(raw) AS r,
    generate_subscripts(l, 1) AS i FROM ln) y),
  figs AS (SELECT source || '/' || paper_id || '/F' || i || 'x' AS doc_id, source, paper_id, 'F' || i || 'x' AS figure_id,
    {_bare("'Figure ' || i || ' ' || CASE source WHEN 'html' THEN x ELSE r END")} AS caption,
    CASE source WHEN 'html' THEN 'https://arxiv.org/html/' || paper_id || '#F' || i || 'x'
      ELSE 'https://pmc.ncbi.nlm.nih.gov/articles/' || paper_id || '/#F' || i || 'x' END AS url,
    CASE source WHEN 'html' THEN 'https://arxiv.org/html/' || paper_id || '/' ELSE '' END || i || '.png' AS image_url,
    {_bare("CASE source WHEN 'html' THEN x || ' F T' ELSE x END")} AS blob_data FROM ob),
  tabs AS (SELECT source || '/' || paper_id || '/T' || i || 'x' AS doc_id, source, paper_id, 'T' || i || 'x' AS table_id,
    {_bare("CASE source WHEN 'html' THEN x ELSE r END")} AS caption,
    CASE source WHEN 'html' THEN 'https://arxiv.org/html/' || paper_id || '#T' || i || 'x'
      ELSE 'https://pmc.ncbi.nlm.nih.gov/articles/' || paper_id || '/#T' || i || 'x' END AS table_url,
    '<table><tr><td>' || lang || '</td></tr></table>' AS data,
    {_bare("CASE source WHEN 'html' THEN x || ' F T' ELSE x END")} AS blob_data FROM ob)"""

ORACLES = {
    "index_figures": f"WITH {_OBJECTS} SELECT * FROM figs",
    "index_tables": f"WITH {_OBJECTS} SELECT * FROM tabs",
    "tag_strip": f"SELECT page_id, {_bare('html')} AS text FROM pages",
    "html_paragraphs": r"""SELECT page_id, CAST(generate_subscripts(p, 1) AS BIGINT) AS ordinal,
        unnest(p) AS inner FROM (SELECT page_id,
        regexp_extract_all(html, '(?s)<p(?:\s[^>]*)?>(.*?)</p>', 1) AS p FROM pages) x""",
    "page_title": f"""SELECT page_id, coalesce(nullif({_bare(
        "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}, ''), 'N/A') AS title FROM pages""",
    "html_links": r"""WITH a AS (SELECT page_id, list_filter(list_transform(
          regexp_extract_all(html, '<a\s[^>]*>'), lambda x: trim(regexp_extract(x, '\shref="([^"]*)"', 1), '#')),
          lambda x: x <> '') AS r FROM pages)
        SELECT CAST(page_id AS VARCHAR) AS paper_id, CAST(generate_subscripts(r, 1) - 1 AS BIGINT)
        AS position, unnest(r) AS reference FROM a""",
    "html_tree_counts": r"""SELECT CAST(page_id AS VARCHAR) AS paper_id, 'paragraph' AS kind,
        'unknown_id' AS object_id, CAST(len(regexp_extract_all(html, '<p[\s>]')) AS BIGINT) AS n FROM pages
        WHERE regexp_matches(html, '<p[\s>]')""",
    "xml_paragraphs": f"WITH {_PARAS} SELECT paper_id, paragraph_id, text FROM pr",
    "xml_figures": f"""WITH {_LINES}, j AS (SELECT doc_id, raw, unnest(range(1, 13)) AS j FROM ln)
        SELECT CAST(doc_id AS VARCHAR) AS paper_id, 'f' || j AS figure_id,
               {_strip("'Figure ' || j || ' ' || raw[1]")} AS caption,
               'https://pmc.ncbi.nlm.nih.gov/articles/' || doc_id || '/#f' || j AS url,
               j || '.png' AS image_url FROM j""",
    "xml_tables": """SELECT CAST(doc_id AS VARCHAR) AS paper_id, t AS table_id,
          CASE WHEN t IS NULL THEN '' ELSE 'Language' END AS caption,
          'https://pmc.ncbi.nlm.nih.gov/articles/' || doc_id || '/#' || coalesce(t, 'None') AS table_url,
          '<table><tr><td>' || lang || '</td></tr></table>' AS data
        FROM documents, (VALUES ('t1'), (NULL)) v(t)""",
    "article_metadata": f"""WITH {_LINES} SELECT CAST(doc_id AS VARCHAR) AS paper_id,
          {_strip("raw[1] || '*'")} AS title,
          {_strip("'Summary: ' || coalesce(raw[2], '')")} AS summary,
          lang || ' ' || source AS authors, CAST(2000 + doc_id % 25 AS VARCHAR) AS published,
          'https://www.ncbi.nlm.nih.gov/pmc/articles/PMC' || doc_id || '/' AS link FROM ln""",
    "substring_link": f"WITH {_LINKS} SELECT paper_id, object_id, paragraph_id FROM lk",
    "link_text_blob": f"""WITH {_LINKS}, b AS (SELECT paper_id, object_id,
          string_agg({_bare('text')}, chr(10) ORDER BY i) AS blob FROM lk GROUP BY ALL)
        SELECT paper_id, object_id, {_bare("coalesce(blob, '')")} AS blob_data
        FROM fg LEFT JOIN b USING (paper_id, object_id)""",
    "link_maps": f"""WITH {_LINKS}, b AS (SELECT paper_id, object_id, string_agg('"' || paragraph_id || '"',
          ',' ORDER BY i) AS ids FROM lk GROUP BY ALL)
        SELECT paper_id, '{{' || string_agg('"' || object_id || '":[' || ids || ']', ',' ORDER BY object_id)
        || '}}' AS links FROM b GROUP BY paper_id""",
    "context_paragraphs": f"""WITH p AS (SELECT doc_id AS paper_id, unnest(s) AS text,
          generate_subscripts(s, 1) - 1 AS ordinal FROM (SELECT doc_id,
          string_split({sql.ABSTRACT}, chr(10)) AS s FROM documents) x),
        pt AS (SELECT DISTINCT paper_id, ordinal, unnest({sql.tokens('text')}) AS term FROM p),
        rare AS (SELECT term FROM pt GROUP BY term HAVING count(DISTINCT paper_id)
                 <= 0.5 * (SELECT count(DISTINCT paper_id) FROM pt)),
        ct AS (SELECT DISTINCT doc_id AS paper_id, unnest({sql.tokens(sql.TITLE)}) AS term FROM documents)
        SELECT paper_id, 'title' AS object_id, ordinal, CAST(count(*) AS BIGINT) AS n_shared
        FROM pt JOIN rare USING (term) JOIN ct USING (paper_id, term)
        WHERE term NOT IN ('a','an','and','are','as','at','be','but','by','for','if','in','into','is','it',
          'no','not','of','on','or','such','that','the','their','then','there','these','they','this','to',
          'was','will','with')
        GROUP BY ALL""",
    "title_section_extract": f"""WITH v AS (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN
            chr(10) || '  TITLE: ' || {sql.TITLE} || chr(10) || chr(10) || 'Abstract: ' || {sql.ABSTRACT}
            || chr(10) || 'Keywords: search' || chr(10) || 'not part of it' ELSE text END AS v FROM documents),
        l AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(v, '\\r\\n|\\n|\\r'),
            lambda x: {_control_trim('x')}), lambda x: x <> '') AS l FROM v),
        m AS (SELECT *, list_position(list_transform(l, lambda x: lower(left(x, 9)) = 'abstract:'), true) AS b
              FROM l),
        t AS (SELECT *, CASE WHEN b > 0 THEN l[b + 1:] END AS tail FROM m),
        s AS (SELECT *, list_position(list_transform(tail,
              lambda x: regexp_matches(x, '{_HEADING}')), true) AS stop FROM t)
        SELECT doc_id, coalesce({_strip("substr(list_filter(l, lambda x: lower(left(x, 6)) = 'title:')[1], 7)")},
                 'Unknown title') AS title,
               coalesce(CASE WHEN b > 0 THEN nullif(array_to_string(list_filter(list_concat(
                 [{_strip('substr(l[b], 10)')}], CASE WHEN stop > 0 THEN tail[:stop - 1] ELSE tail END),
                 lambda x: x <> ''), ' '), '') END, 'No abstract available') AS abstract FROM s""",
    "clean_text_strict": rf"""SELECT doc_id, {_strip(
        r"regexp_replace(regexp_replace(text, '[^\p{L}\p{N}_\s\p{Z}.,;:!?()\-]', '', 'g'), '[\s\p{Z}]+', ' ', 'g')")}
        AS text FROM documents""",
    "clean_text_loose": rf"""SELECT doc_id, {_strip(r"regexp_replace(text, '[\s\p{Z}]+', ' ', 'g')")}
        AS text FROM documents""",
    "count_by_year": """SELECT CASE WHEN o_orderkey % 9 <> 0 THEN CAST(year(o_orderdate) AS VARCHAR)
        ELSE 'Unknown' END AS year, CAST(count(*) AS BIGINT) AS papers FROM orders GROUP BY 1""",
    "author_names": "SELECT c_custkey, trim(c_name || ' ' || c_mktsegment) || ', Li' AS authors FROM customer",
    "derived_urls": f"""SELECT doc_id, 'https://arxiv.org/html/' || doc_id || '#' || lang AS object_url,
        'https://arxiv.org/html/' || doc_id || '/x1.png' AS image_url,
        'https://pmc.ncbi.nlm.nih.gov/articles/' || doc_id || '/#' || lang AS xml_url,
        'https://www.ncbi.nlm.nih.gov/pmc/articles/PMC' || doc_id || '/' AS landing_url,
        'https://export.arxiv.org/html/' || source AS mirror_url,
        lpad(CAST(doc_id AS VARCHAR), CAST(greatest(3, length(CAST(doc_id AS VARCHAR))) AS INT), '0') || '_' ||
        left(translate({sql.TITLE}, ' /', '__'), 50) || '.txt' AS file_name FROM documents""",
    "first_filled_key": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 AND o_custkey <> 0
        THEN CAST(o_custkey AS VARCHAR) WHEN o_orderkey % 5 <> 0 THEN o_orderstatus ELSE 'none' END AS query_id
        FROM orders""",
    "metadata_join": f"""SELECT doc_id, {sql.TITLE} AS title, CAST(quality AS BIGINT) AS quality,
        quality IS NOT NULL AS found FROM documents LEFT JOIN labels USING (doc_id)""",
    "complete_papers": """SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
        AND doc_id IN (SELECT conv_id FROM conversations)""",
    "incremental_ingest": """SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id)
        AS event_type FROM events WHERE user_id NOT IN (SELECT user_id FROM events
        WHERE event_type = 'error' AND value >= 150) GROUP BY user_id""",
    "stage_durations": """SELECT CAST(l_linenumber AS BIGINT) AS stage,
        CAST(sum(l_linenumber * 3661) AS BIGINT) AS seconds FROM lineitem GROUP BY 1""",
    "canonical_lines": f"""SELECT doc_id, {_strip(sql.TITLE)} || chr(9) || lang || chr(9) || '1' AS line
        FROM documents""",
}
