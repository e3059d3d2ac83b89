"""Landed feeds: Atom entries, article XML, search-result pages."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import cleaning
from corvane.functions.markup import Element, parse_html, parse_xml

ATOM = ("id string, title string, summary string, published string, "
        "author array<struct<name:string>>, link array<struct<_rel:string,_href:string>>")
ARTICLE = "paper_id string, title string, summary string, authors array<string>, published string"
RESULT = "page_id string, number int, title string, abstract string"


def atom_entries(spark: SparkSession, path: str) -> DataFrame:
    """paper_id, title, summary, published, authors, link, html_link of every feed entry."""
    return _entry_columns(spark.read.format("xml").option("rowTag", "entry").schema(ATOM).load(path), [])


def atom_rows(feeds: DataFrame, column: str = "value") -> DataFrame:
    """As atom_entries, from a column of whole feeds."""
    entries = F.regexp_extract_all(F.col(column), F.lit(r"(?s)<entry\b.*?</entry>"), F.lit(0))
    rest = [c for c in feeds.columns if c != column]
    raw = feeds.select(*rest, F.explode(entries).alias("_e"))
    return _entry_columns(raw.select(*rest, F.from_xml("_e", ATOM).alias("_x")), rest, "_x.")


def _entry_columns(raw: DataFrame, rest: list[str], prefix: str = "") -> DataFrame:
    alternate = F.get(F.filter(prefix + "link", lambda x: x["_rel"] == "alternate"), F.lit(0))["_href"]
    text = lambda c: F.coalesce(cleaning.strip(F.col(prefix + c)), F.lit(""))
    link = F.coalesce(alternate, F.lit(""))
    return raw.select(
        *rest, F.element_at(F.split(text("id"), "/"), -1).alias("paper_id"),
        text("title").alias("title"), text("summary").alias("summary"),
        text("published").alias("published"),
        F.coalesce(F.transform(prefix + "author", lambda a: a["name"]), F.array().cast("array<string>"))
        .alias("authors"),
        cleaning.first_filled(link, text("id")).alias("link"),
        cleaning.mirror_url(link).alias("html_link"))


def _article_row(paper_id: str, root: Element) -> tuple:
    article = root.first("article")
    title = summary = published = ""
    authors: list[str] = []
    if article is not None:
        found = {n: article.first(n) for n in ("article-title", "abstract", "pub-date")}
        title = found["article-title"].text().strip() if found["article-title"] else ""
        summary = found["abstract"].text().strip() if found["abstract"] else ""
        year = _child(found["pub-date"], "year")
        published = year.text() if year is not None else ""
        for contrib in article.all("contrib"):
            name = _child(contrib, "name") if contrib.attrs.get("contrib-type") == "author" else None
            if name is not None:
                parts = [_child(name, n) for n in ("given-names", "surname")]
                full = " ".join(p.text() if p is not None else "" for p in parts).strip()
                if full:
                    authors.append(full)
    return paper_id, title, summary, authors, published


def _article_rows(ids: Iterable[str], markups: Iterable[str | None]) -> Iterator[tuple]:
    """One tree at a time: those of a whole batch take many times its bytes."""
    for paper_id, markup in zip(ids, markups):
        root = parse_xml(markup) if markup else None
        if root is not None:
            yield _article_row(paper_id, root)


def _child(element: Element | None, name: str) -> Element | None:
    if element is None:
        return None
    return next((c for c in element.content if isinstance(c, Element) and c.name == name), None)


def article_metadata(papers: DataFrame) -> DataFrame:
    """Metadata of article XML (paper_id, markup): title and abstract are all inner text, authors
    are the named contributors, published is the year of the first date."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(_article_rows(batch["paper_id"], batch["markup"]),
                               columns=["paper_id", "title", "summary", "authors", "published"])

    rows = papers.select(F.col("paper_id").cast("string"), "markup").mapInPandas(run, ARTICLE)
    return rows.withColumn("link", cleaning.xml_landing_url(F.col("paper_id")))


def _has(element: Element, part: str) -> bool:
    return part in (element.attrs.get("class") or "")


def search_results(pages: DataFrame) -> DataFrame:
    """page_id, number, title, abstract of the result items of landed search pages."""
    def items(root: Element) -> Iterator[tuple[str, str]]:
        for item in (x for x in root.all("li") if _has(x, "arxiv-result")):
            title = "".join(t.strip() for p in item.all("p") if _has(p, "title")
                            for t in p.content if isinstance(t, str))
            spans = [s for s in item.all("span") if _has(s, "abstract-full")]
            abstract = "".join(t.strip() for s in spans for t in s.texts())
            yield title.strip(), abstract.strip()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for page_id, markup in zip(batch["page_id"], batch["markup"]):
                found = list(items(parse_html(markup))) if markup else []
                yield pd.DataFrame([(page_id, i, t, a) for i, (t, a) in enumerate(found, start=1)],
                                   columns=["page_id", "number", "title", "abstract"])

    return pages.select(F.col("page_id").cast("string"), "markup").mapInPandas(run, RESULT)
