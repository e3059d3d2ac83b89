"""Column expressions for cleaning, projection and formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\s\p{Z}]"
SPACES = "\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"  # SPACE, spelt out


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(text, F.lit(SPACES))  # reads the ends, where a pattern would try every character


def blank_to_null(text: Column) -> Column:
    return F.when(~text.rlike(rf"^{SPACE}*$"), text)


def normalise_text(text: Column) -> Column:
    """Trimmed lower case; missing or blank is null."""
    return F.nullif(F.lower(strip(text.cast("string"))), F.lit(""))


def normalise_price(text: Column) -> Column:
    """Digits and dots of a price as a double; anything unreadable is null."""
    return F.regexp_replace(text.cast("string"), r"[^\d.]", "").try_cast("double")


def loose_clean(text: Column) -> Column:
    """Line breaks and tabs to blanks, runs of white space to one blank, trimmed."""
    return strip(F.regexp_replace(text.cast("string"), rf"{SPACE}+", " "))


def strict_clean(text: Column) -> Column:
    """As loose_clean, and only word characters and ``.,;:!?()-`` survive."""
    kept = F.regexp_replace(text.cast("string"), rf"[^\p{{L}}\p{{N}}_\s\p{{Z}}.,;:!?()\-]", "")
    return loose_clean(kept)


def strip_tags(markup: Column) -> Column:
    """Drop tags that do not span lines, put the rest on one line; entities stay as they are."""
    bare = F.regexp_replace(markup, r"<[^\n]*?>", "")
    return strip(F.translate(bare, "\n\r", "  "))


def _text_lines(text: Column) -> Column:
    lines = F.transform(F.split(text, "\r\n|\n|\r"),
                        lambda x: F.regexp_replace(x, r"^[\x00-\x20]+|[\x00-\x20]+$", ""))
    return F.filter(lines, lambda x: x != "")


# Markers and headings of the text papers.
TITLE_MARK = "title:"
ABSTRACT_MARK = "abstract:"
NEXT_SECTION = (r"(?i)^(introduction|1\.|i\.|references|keywords|acknowledgments|conclusion|"
                r"conclusions)[:\s].*")
NO_TITLE = "Unknown title"
NO_ABSTRACT = "No abstract available"


def add_title_and_abstract(df: DataFrame, text: str = "value") -> DataFrame:
    """Add title and abstract of whole-file text papers.

    The title is the rest of the first ``title:`` line.  The abstract runs from the ``abstract:``
    line to the first heading after it; blank lines do not end it.
    """
    def marked(mark: str):
        return lambda x: F.lower(F.substring(x, 1, len(mark))) == mark

    def after(line: Column, mark: str) -> Column:
        return strip(F.substring(line, len(mark) + 1, 2 ** 30))

    with_lines = df.withColumn("_lines", _text_lines(F.col(text)))
    begin = F.array_position(F.transform("_lines", marked(ABSTRACT_MARK)), True)
    tail = F.slice("_lines", F.col("_begin") + 1, F.size("_lines"))
    stop = F.array_position(F.transform("_tail", lambda x: x.rlike(NEXT_SECTION)), True)
    body = F.when(F.col("_stop") > 0, F.slice("_tail", 1, F.col("_stop") - 1)).otherwise(F.col("_tail"))
    first = after(F.get("_lines", F.col("_begin") - 1), ABSTRACT_MARK)
    abstract = F.array_join(F.filter(F.concat(F.array(first), body), lambda x: x != ""), " ")
    title = after(F.get(F.filter("_lines", marked(TITLE_MARK)), F.lit(0)), TITLE_MARK)
    return (with_lines
            .withColumn("_begin", begin.cast("int"))
            .withColumn("_tail", F.when(F.col("_begin") > 0, tail))
            .withColumn("_stop", stop.cast("int"))
            .withColumn("title", F.coalesce(title, F.lit(NO_TITLE)))
            .withColumn("abstract", F.coalesce(
                F.when(F.col("_begin") > 0, F.nullif(strip(abstract), F.lit(""))),
                F.lit(NO_ABSTRACT)))
            .drop("_lines", "_begin", "_tail", "_stop"))


def published_year(published: Column) -> Column:
    return F.coalesce(F.nullif(F.substring(published, 1, 4), F.lit("")), F.lit("Unknown"))


def full_names(given: Column, surname: Column) -> Column:
    """Arrays of given names and surnames as ``given surname``, empty names dropped."""
    joined = F.zip_with(given, surname, lambda g, s: F.trim(
        F.concat_ws(" ", F.coalesce(g, F.lit("")), F.coalesce(s, F.lit("")))))
    return F.filter(joined, lambda x: x != "")


def display_names(names: Column) -> Column:
    return F.array_join(names, ", ")


# Address forms of the two paper sources.
HTML_PAPER = "https://arxiv.org/html/"
XML_PAPER = "https://pmc.ncbi.nlm.nih.gov/articles/"
XML_LANDING = "https://www.ncbi.nlm.nih.gov/pmc/articles/PMC"


def html_object_url(paper_id: Column, object_id: Column) -> Column:
    return F.concat(F.lit(HTML_PAPER), paper_id, F.lit("#"), object_id)


def html_image_url(paper_id: Column, src: Column) -> Column:
    return F.concat(F.lit(HTML_PAPER), paper_id, F.lit("/"), F.coalesce(src, F.lit("")))


def xml_object_url(paper_id: Column, object_id: Column) -> Column:
    return F.concat(F.lit(XML_PAPER), paper_id, F.lit("/#"), object_id)


def xml_landing_url(paper_id: Column) -> Column:
    return F.concat(F.lit(XML_LANDING), paper_id, F.lit("/"))


def mirror_url(link: Column) -> Column:
    """Download address of the HTML version; no link, no address."""
    mirrored = F.replace(F.replace(link, F.lit("abs"), F.lit("html")),
                         F.lit("arxiv"), F.lit("export.arxiv"))
    return F.when(link != "", mirrored)


def safe_file_name(number: Column, title: Column) -> Column:
    return F.format_string("%03d_%s.txt", number, F.substring(F.translate(title, " /", "__"), 1, 50))


def first_filled(*values: Column) -> Column:
    """First value that is neither null, empty nor zero."""
    return F.coalesce(*[F.when((v.cast("string") != "") & (v.cast("string") != "0"), v)
                        for v in values])


def canonical_line(line: Column) -> Column:
    """Tab-separated line with every field trimmed."""
    return F.array_join(F.transform(F.split(line, "\t"), strip), "\t")


def shell_timestamp(text: Column) -> Column:
    """Output of the ``date`` command as a timestamp; weekday and zone are dropped."""
    p = F.split(strip(text), r"\s+")
    clean = F.concat_ws(" ", F.get(p, F.lit(1)), F.get(p, F.lit(2)), F.get(p, F.lit(3)),
                        F.get(p, F.lit(4)), F.element_at(p, -1))
    return F.to_timestamp(clean, "MMM d hh:mm:ss a yyyy")


def duration_seconds(start: Column, end: Column) -> Column:
    return (shell_timestamp(end).cast("double") - shell_timestamp(start).cast("double"))


def snippet(text: Column, length: int = 200) -> Column:
    """The first ``length`` characters of a text, for display next to a hit."""
    return F.substring(text, 1, length)
