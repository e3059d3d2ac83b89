"""Lines that recur across documents, found over a sorted range partitioning of line hashes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import empty_text, lean, stored, table, unused

_SPACE = "\\\\x20\\\\x09-\\\\x0D"


def lines(text: str | Column) -> Column:
    """The lines of a text.  A null or empty text has one empty line."""
    return F.split(empty_text(text), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    trimmed = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.translate(trimmed, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _scan(min_docs: int):
    """Streams rows sorted by key, then id from the largest, then position.

    The first document of a key keeps its lines.  Later ones lose theirs once ``min_docs`` documents
    are known.  Rows that wait for that number are held: those of at most ``min_docs`` - 2 documents
    of one key.  The first key of a partition may have begun in an earlier one, and the last may go
    on in a later one: rows these leave undecided come out as open, with the key's totals.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = last = None  # of the row before
        first_key = True
        seen, top = 0, None  # documents of this key so far, and the first
        waiting: list[tuple] = []

        def out(rows, kind):
            return [(kind, k[0], k[1], doc, th, pos, 0) for k, doc, th, pos in rows]

        for batch in batches:
            made: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("h1", "h2", "id", "th", "pos")]
            for h1, h2, doc, th, pos in zip(*columns):
                if key is None or h1 != key[0] or h2 != key[1]:
                    if key is not None and first_key:
                        made += out(waiting, "open") + [("key", *key, top, None, None, seen)]
                        first_key = False
                    waiting = []
                    key, seen, top, last = (h1, h2), 1, doc, doc
                elif doc != last:
                    seen, last = seen + 1, doc
                if first_key:
                    made.append(("open", h1, h2, doc, th, pos, 0))
                elif seen >= min_docs and seen > 1:
                    made += out(waiting, "drop") + [("drop", h1, h2, doc, th, pos, 0)]
                    waiting = []
                elif seen > 1:
                    waiting.append((key, doc, th, pos))
            if made:
                yield _batch(made)
        if key is not None:
            yield _batch(out(waiting, "open") + [("key", *key, top, None, None, seen)])

    return run


_FIELDS = {"kind": pa.string(), "h1": pa.int64(), "h2": pa.int64(), "id": pa.int64(), "th": pa.int64(),
           "pos": pa.int32(), "n": pa.int64()}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _FIELDS.values())],
                                      names=list(_FIELDS))


@F.pandas_udf(T.BinaryType())
def _bitmap(dropped, n):
    """Compressed bits, one per line, set for lines that stay."""
    def one(positions, size):
        bits = np.ones(size, bool)
        bits[positions] = False
        return zlib.compress(np.packbits(bits).tobytes())

    return pd.Series([one(p, s) for p, s in zip(dropped, n)], dtype=object)


@F.pandas_udf(T.StringType())
def _kept_text(text, bitmap):
    """The text's lines whose bit is set; without a bitmap, the text."""
    def one(t, b):
        if b is None:
            return t
        parts = t.split("\n")
        bits = np.unpackbits(np.frombuffer(zlib.decompress(b), np.uint8), count=len(parts))
        return "\n".join(p for p, keep in zip(parts, bits) if keep)

    return pd.Series([one(t, b) for t, b in zip(text, bitmap)], dtype=object)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                 min_docs: int = 3) -> DataFrame:
    """(id, th, positions) of documents that lose lines: the places of those lines.

    Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents keep their
    lines in the document with the largest id only.  ``th`` is a hash of the text, so rows that
    repeat an id with another text have bitmaps of their own; they count as one document.  A null id
    is one document, smaller than all others.  Only hashes, ids and positions are shuffled.

    The range partitioning is over (key, id): a key that a third of all documents hold lies in as
    many partitions as it needs.  What partitions know of the keys they cut is at most two rows each
    and is joined as a broadcast of that size.
    """
    if min_docs < 2:
        raise ValueError("min_docs below 2 would leave no line")
    exploded = (docs.select(F.col(id_col).cast("long").alias("id"),
                            F.xxhash64(empty_text(text_col)).alias("th"),
                            F.posexplode(F.transform(lines(text_col), line_key)).alias("pos", "key"))
                .filter(F.char_length("key") >= min_chars)
                .select("id", "th", "pos", F.xxhash64("key").alias("h1"),
                        F.xxhash64(F.lit(1), "key").alias("h2")))
    ordered = (exploded.repartitionByRange(F.col("h1"), F.col("h2"), F.col("id").desc_nulls_last())
               .sortWithinPartitions("h1", "h2", F.col("id").desc_nulls_last(), "th", "pos"))
    schema = "kind string, h1 long, h2 long, id long, th long, pos int, n long"
    scanned = stored(ordered.mapInArrow(lean(_scan(min_docs)), schema), "line-decisions")
    cut = (scanned.filter("kind = 'key'").groupBy("h1", "h2")
           .agg(F.sum("n").alias("docs"), F.max("id").alias("top"))
           .filter(F.col("docs") >= min_docs))
    settled = (scanned.filter("kind = 'open'").join(F.broadcast(cut), ["h1", "h2"])
               .filter(~F.col("id").eqNullSafe(F.col("top"))).select("id", "th", "pos"))
    dropped = scanned.filter("kind = 'drop'").select("id", "th", "pos").unionByName(settled)
    return (dropped.groupBy("id", "th").agg(F.array_sort(F.collect_set("pos")).alias("positions")))


def with_bitmaps(docs: DataFrame, dropped: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with n_lines, n_dropped and the bitmap (null: every line stays), under the names returned."""
    own = [unused(docs, f"_{name}") for name in ("n_lines", "n_dropped", "bitmap", "drop_id", "drop_th", "places")]
    n_lines, n_dropped, bitmap, drop_id, drop_th, places = own
    n = F.size(lines(text_col))
    right = dropped.select(F.col("id").alias(drop_id), F.col("th").alias(drop_th), F.col("positions").alias(places))
    met = (F.col(id_col).cast("long").eqNullSafe(F.col(drop_id))
           & (F.xxhash64(empty_text(text_col)) == F.col(drop_th)))
    bits = _bitmap(F.coalesce(places, F.array().cast("array<int>")), n)
    marked = docs.join(right, met, "left").withColumns({
        n_lines: n.cast("long"),
        n_dropped: F.when(F.col(places).isNull(), 0).otherwise(F.size(places)).cast("long"),
        bitmap: F.when(F.col(places).isNotNull(), bits)})
    return marked, own[:3]


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
               min_docs: int = 3) -> DataFrame:
    """Per document: id, n_lines, n_dropped and the compressed bitmap of lines that stay, no text.

    A null bitmap: all lines stay.  A null or empty text has one empty line; an empty table gives no
    row; other columns are not read.
    """
    narrow = docs.select(id_col, text_col)
    marked, names = with_bitmaps(narrow, dropped_lines(narrow, id_col, text_col, min_chars, min_docs), id_col, text_col)
    return marked.select(id_col, *[F.col(c).alias(c.strip("_")) for c in names])


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
               min_docs: int = 3) -> DataFrame:
    """``docs`` with the lines that stay as text; all other columns as they were.  A null text stays null."""
    marked, (_, _, bitmap) = with_bitmaps(docs, dropped_lines(docs, id_col, text_col, min_chars, min_docs), id_col,
                                          text_col)
    text = F.when(F.col(bitmap).isNull(), F.col(text_col)).otherwise(_rest(text_col, bitmap))
    return marked.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])


def _rest(text_col: str, bitmap: str) -> Column:
    """Only texts that lose lines go to Python."""
    return _kept_text(F.when(F.col(bitmap).isNotNull(), empty_text(text_col)), F.col(bitmap))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked, (n_lines, n_dropped, bitmap) = with_bitmaps(docs, dropped_lines(docs), "doc_id", "text")
    kept = F.when(F.col(bitmap).isNull(), empty_text("text")).otherwise(_rest("text", bitmap))
    return marked.select("doc_id", F.col(n_lines).alias("n_lines"), F.col(n_dropped).alias("n_dropped"),
                         F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = """
WITH l AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), common AS (
  SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.top AS gone FROM k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
