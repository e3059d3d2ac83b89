"""Text, markup, CSV, JSON and line-based sources.  Schemas are declared, never inferred.

Every source has two halves: a reader of files, and a ``*_rows`` function that turns a text column
into rows.  The second half works on any table and keeps the other columns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import cleaning

METADATA = "title string, authors array<string>, published string, summary string, link string"
PARAGRAPH = "paper_id string, paragraph_id string, text string"
FIGURE = "paper_id string, figure_id string, caption string, url string, image_url string"
TABLE = "paper_id string, table_id string, caption string, table_url string, data string"
LINKS = "map<string,array<string>>"
QUERY = "struct<id:string,query_id:string,index:string,query:string,query_body:string>"
ANNOTATION = ("query_id string, id string, query string, index string, result_id string, "
              "rank int, relevance int")
PREDICTION = "left string, right string, match int, match_confidence double"
NO_PARTS = r"_(figures|paragraphs|links|tables)\.json$"


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, multiLine=True, escape='"')


def _missing(error: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def _whole_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path, value per file; a missing folder is an empty set."""
    try:
        files = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True)
    except Exception as error:  # noqa: BLE001 - the reader has no narrower type
        if not _missing(error):
            raise
        return spark.createDataFrame([], "path string, value string")
    return files.select(F.col("_metadata.file_path").alias("path"), "value")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def csv_rows(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Fields of one CSV line per row."""
    parsed = F.from_csv(F.col(column), schema, {"escape": '"'})
    return lines.withColumn("_r", parsed).select(*_rest(lines, column), "_r.*")


def _rest(df: DataFrame, *used: str) -> list[str]:
    return [c for c in df.columns if c not in used]


def text_papers(spark: SparkSession, path: str) -> DataFrame:
    """path, filename, title, abstract of ``.txt`` files, extension in any case."""
    return text_rows(_whole_files(spark, path, "*.[tT][xX][tT]"))


def text_rows(files: DataFrame) -> DataFrame:
    """path, filename, title, abstract of landed texts (path, value)."""
    named = files.withColumn("filename", file_name(F.col("path")))
    return cleaning.add_title_and_abstract(named, "value").drop("value")


def markup_papers(spark: SparkSession, path: str) -> DataFrame:
    """paper_id, source (html or xml), markup."""
    return markup_rows(_whole_files(spark, path, "*.{html,xml}"))


def markup_rows(files: DataFrame) -> DataFrame:
    """paper_id, source (html or xml), markup of landed pages (path, value)."""
    name = file_name(F.col("path"))
    return files.filter(name.rlike(r"\.(html|xml)$")).select(
        *_rest(files, "path", "value"), F.regexp_replace(name, r"\.(html|xml)$", "").alias("paper_id"),
        F.element_at(F.split(name, r"\."), -1).alias("source"), F.col("value").alias("markup"))


def paper_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per file; missing keys get their defaults, part files are left out."""
    return metadata_rows(_whole_files(spark, path, "*.json"))


def metadata_rows(files: DataFrame) -> DataFrame:
    """paper_id and metadata of landed objects (path, value), without part files."""
    name, empty = file_name(F.col("path")), F.array().cast("array<string>")
    parsed = (files.filter(~name.rlike(NO_PARTS))
              .withColumn("paper_id", F.regexp_extract(name, r"^(.+?)\.json$", 1))
              .withColumn("_m", F.from_json("value", METADATA)))
    return parsed.select(*_rest(files, "path", "value"), "paper_id", *[
        F.coalesce(F.col("_m")[c], empty if c == "authors" else F.lit("")).alias(c)
        for c in ("title", "authors", "published", "summary", "link")])


PARTS = {"paragraphs": PARAGRAPH, "figures": FIGURE, "tables": TABLE}


def paper_parts(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows of the ``_paragraphs``, ``_figures`` or ``_tables`` files (a JSON array per file)."""
    return spark.read.schema(PARTS[kind]).json(path, multiLine=True, pathGlobFilter=f"*_{kind}.json")


def part_rows(files: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """One row per object of a JSON array; an unreadable array gives none."""
    listed = F.from_json(F.col(column), f"array<struct<{re.sub(r'(\w+) string', r'\1:string', PARTS[kind])}>>")
    return (files.withColumn("_o", F.explode_outer(listed)).filter(F.col("_o").isNotNull())
            .select(*_rest(files, column, "paper_id"), "_o.*"))


def paper_links(spark: SparkSession, path: str) -> DataFrame:
    """paper_id, object_id, paragraph_id, position from the ``_links`` maps."""
    files = _whole_files(spark, path, "*_links.json")
    stem = F.regexp_extract(file_name(F.col("path")), r"^(.+)_links\.json$", 1)
    return link_rows(files.select(stem.alias("paper_id"), "value")).select(
        "paper_id", "object_id", "position", "paragraph_id")


def link_rows(maps: DataFrame, column: str = "value") -> DataFrame:
    """object_id, position, paragraph_id of maps from object ids to lists of paragraph ids."""
    rest = _rest(maps, column)
    return (maps.select(*rest, F.explode(F.from_json(column, LINKS)).alias("object_id", "ids"))
            .select(*rest, "object_id", F.posexplode("ids").alias("position", "paragraph_id")))


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object per line; unreadable lines are kept in ``_corrupt_record``."""
    return spark.read.schema(schema + ", _corrupt_record string").json(path)


def json_rows(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Fields of one JSON object per row; an unreadable one is kept in ``_corrupt_record``."""
    parsed = F.from_json(F.col(column), schema + ", _corrupt_record string")
    return lines.withColumn("_r", parsed).select(*_rest(lines, column), "_r.*")


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """query_id, index, result_id, rank, relevance; the query id falls back to id, then query."""
    return judgements(jsonl(spark, path, ANNOTATION))


def judgements(raw: DataFrame) -> DataFrame:
    """Readable annotations with their query id and rank."""
    return raw.filter(F.col("_corrupt_record").isNull()).select(
        cleaning.first_filled(F.col("query_id"), F.col("id"), F.col("query")).alias("query_id"),
        "index", "result_id", F.coalesce("rank", F.lit(0)).alias("rank"), "relevance")


def query_sets(spark: SparkSession, path: str) -> DataFrame:
    """query_id, index, query, query_body, ok from files that hold a list of queries or lists per
    section; a file that is neither gives one row with ok = false."""
    return query_set_rows(spark.read.text(path, wholetext=True))


def query_set_rows(files: DataFrame, column: str = "value") -> DataFrame:
    """As query_sets, from a column of whole files."""
    grouped = F.from_json(column, f"map<string,array<{QUERY}>>")
    listed = F.from_json(column, f"array<{QUERY}>")
    is_list = F.ltrim(column).startswith("[")
    flat = F.transform(listed, lambda q: F.struct(F.lit(None).cast("string").alias("section"), q.alias("q")))
    sections = F.flatten(F.transform(F.map_entries(grouped), lambda e: F.transform(
        e["value"], lambda q: F.struct(e["key"].alias("section"), q.alias("q")))))
    rows = files.select(*_rest(files, column), F.explode_outer(F.when(is_list, flat).otherwise(sections)).alias("_r"))
    q = F.col("_r.q")
    return rows.select(
        *_rest(files, column), cleaning.first_filled(q["id"], q["query_id"], q["query"]).alias("query_id"),
        cleaning.first_filled(q["index"], F.col("_r.section")).alias("index"),
        q["query"].alias("query"), q["query_body"].alias("query_body"),
        F.col("_r").isNotNull().alias("ok"))


def pair_lines(spark: SparkSession, path: str) -> DataFrame:
    """line, left, right, label of serialised pairs; blank lines and lines without three fields
    are skipped."""
    return pair_rows(spark.read.text(path))


def pair_rows(lines: DataFrame, column: str = "value") -> DataFrame:
    parts = F.split(column, "\t")
    return (lines.filter(F.trim(column) != "").filter(F.size(parts) == 3)
            .select(*_rest(lines, column), F.col(column).alias("line"), parts[0].alias("left"),
                    parts[1].alias("right"), F.trim(parts[2]).try_cast("int").alias("label")))


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """tag, seconds of ``tag seconds`` lines."""
    return run_log_rows(spark.read.text(path))


def run_log_rows(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.filter(F.trim(column) != "").select(
        *_rest(lines, column), F.regexp_extract(column, r"^\s*(.*\S)\s+\S+\s*$", 1).alias("tag"),
        F.regexp_extract(column, r"(\S+)\s*$", 1).try_cast("double").alias("seconds"))


YEARS = "year string, papers long"
CONFUSION = "run string, tp long, fp long, fn long, tn long"


def year_counts(spark: SparkSession, path: str) -> DataFrame:
    return csv(spark, path, YEARS)


def confusion_counts(spark: SparkSession, path: str) -> DataFrame:
    """Stored confusion counts, one row per run."""
    return csv(spark, path, CONFUSION)
