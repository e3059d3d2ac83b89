"""WARC archives: written as whole-file gzip streams, normalised to one member per record, read back."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.common import empty_text, scratch, table

CHUNK = 1 << 18
END = "\r\n\r\n"


def payload_classes(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """(page_id, digest, first): the smallest page_id among equal payloads of ``min_bytes`` and more.

    Copies are combined before the shuffle by digest; the join that meets their rows again carries
    ids only and is one whose large partitions Spark splits.
    """
    rows = pages.select("page_id", "digest", "payload_bytes").distinct()
    first = (rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("first")))
    return rows.drop("payload_bytes").join(first.hint("merge"), "digest")


def records(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """One WARC record per page, as text without the blank line that ends it.

    ``pages``: page_id, url, html.  A revisit names the response's page and the payload's digest and
    length and carries no payload.
    """
    html = empty_text("html")
    own = pages.select("page_id", "url", html.alias("html"),
                       F.octet_length(html).cast("long").alias("payload_bytes"),
                       F.sha2(html.cast("binary"), 256).alias("digest"))
    classes = payload_classes(own, min_bytes).select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"),
                                                     "first")
    met = own.join(classes, own.page_id.eqNullSafe(classes._id) & (own.digest == classes._digest), "left")
    revisit = F.coalesce(F.col("first") < F.col("page_id"), F.lit(False)) | (
        F.col("first").isNotNull() & F.col("page_id").isNull())

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")
    return met.select(F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
                                 line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))))
        .otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"), body).alias("record"))


def write_monolithic(records: DataFrame, path: str) -> None:
    """Archives of one gzip stream per file: Spark's text writer, with the end of a record as line end."""
    records.write.option("compression", "gzip").option("lineSep", END).text(path)


def _open(path: str):
    """File system and path in it, for any store that Arrow reaches."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path) if ":" in path else f"file://{path}")


class RecordReader:
    """Cuts a stream of bytes into records, holding a chunk and a record's head at a time.

    ``feed`` yields ("head", bytes), ("body", bytes) as often as needed, and ("end", bytes).
    """

    def __init__(self):
        self.buffer = bytearray()
        self.left: int | None = None  # bytes of the body still to come

    def feed(self, data: bytes) -> Iterator[tuple[str, bytes]]:
        self.buffer += data
        while True:
            if self.left is None:
                end = self.buffer.find(b"\r\n\r\n")
                if end < 0:
                    return
                head = bytes(self.buffer[:end + 4])
                found = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r$", head)
                if not head.startswith(b"WARC/") or not found:
                    raise ValueError(f"not a WARC record: {head[:60]!r}")
                del self.buffer[:end + 4]
                self.left = int(found[1])
                yield "head", head
            elif self.left:
                if not self.buffer:
                    return
                part = bytes(self.buffer[:self.left])
                del self.buffer[:self.left]
                self.left -= len(part)
                yield "body", part
            else:
                if len(self.buffer) < 4:
                    return
                del self.buffer[:4]
                self.left = None
                yield "end", END.encode()

    def close(self) -> None:
        if self.left is not None or self.buffer.strip(b"\r\n"):
            raise ValueError("the archive ends inside a record")


def _inflate(file) -> Iterator[bytes]:
    """Chunks of a gzip file of one or several members, decompressed once from front to end."""
    zip_ = zlib.decompressobj(31)
    while data := file.read(CHUNK):
        while data:
            yield zip_.decompress(data, 4 * CHUNK)
            while zip_.unconsumed_tail:
                yield zip_.decompress(zip_.unconsumed_tail, 4 * CHUNK)
            data = zip_.unused_data
            if zip_.eof and data:
                zip_ = zlib.decompressobj(31)
    if not zip_.eof:
        raise ValueError("the gzip stream is cut off")


def normalise(spark: SparkSession, source: str, target: str, level: int = 6) -> None:
    """Rewrites every archive of ``source`` in ``target`` with one gzip member per record.

    Each file is one stream: inflated once, a chunk at a time, so neither the file's nor a record's
    size bounds memory.  Beside ``name.warc.gz`` lies ``name.cdxj``, a line of JSON per record with
    its offset and length.  Both are written under the task attempt's name and then renamed, so a
    retried or repeated task leaves one whole copy.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name = re.sub(r"(\.\w+)?\.gz$", "", path.rsplit("/", 1)[1])
                yield pa.RecordBatch.from_pydict({"records": [_rewrite(path, target, name, attempt, level)]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    done = files.mapInArrow(run, "records long").agg(F.sum("records")).first()[0]
    if done is None:  # no archive: the target is an empty folder
        files.select(F.lit("").alias("value")).limit(0).write.mode("append").text(target)


def _rewrite(path: str, target: str, name: str, attempt: int, level: int) -> int:
    fs_in, place = _open(path)
    fs_out, folder = _open(target)
    fs_out.create_dir(folder, recursive=True)
    temp = f"{folder}/_{name}.{attempt}"
    count = offset = start = 0
    reader = RecordReader()
    with fs_in.open_input_stream(place, compression=None, buffer_size=CHUNK) as file, \
            fs_out.open_output_stream(f"{temp}.gz", compression=None) as out, \
            fs_out.open_output_stream(f"{temp}.idx", compression=None) as index:
        member = None
        for chunk in _inflate(file):
            for kind, data in reader.feed(chunk):
                if kind == "head":
                    member, start = zlib.compressobj(level, zlib.DEFLATED, 31), offset
                packed = member.compress(data) + (member.flush() if kind == "end" else b"")
                out.write(packed)
                offset += len(packed)
                if kind == "end":
                    line = {"file": f"{name}.warc.gz", "offset": start, "length": offset - start, "record": count}
                    index.write((json.dumps(line) + "\n").encode())
                    count += 1
        reader.close()
    for end, final in (("gz", "warc.gz"), ("idx", "cdxj")):
        if fs_out.get_file_info(f"{folder}/{name}.{final}").type.name == "NotFound":
            fs_out.move(f"{temp}.{end}", f"{folder}/{name}.{final}")
        else:
            fs_out.delete_file(f"{temp}.{end}")
    return count


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The sidecar indexes of normalised archives: file, offset, length, record."""
    return (spark.read.schema("file string, offset long, length long, record long")
            .option("pathGlobFilter", "*.cdxj").json(path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Reads every indexed record at its offset and checks it.

    page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = name = None
        for batch in batches:
            rows, held = [], 0
            for row in batch.to_pylist():
                if row["file"] != name:
                    name = row["file"]
                    system, folder = _open(path)
                    opened = system.open_input_file(f"{folder}/{name}")
                opened.seek(row["offset"])
                rows.append(_parse(zlib.decompress(opened.read(row["length"]), 31)))
                held += len(rows[-1]["payload"] or b"")
                if held > 16 * CHUNK:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    return read_index(spark, path).mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
             "refers_to long, payload binary")


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                     ("payload", pa.binary())])


def _parse(data: bytes) -> dict:
    head, _, body = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    payload = body[:-4]
    if len(payload) != int(fields["Content-Length"]) or body[-4:] != b"\r\n\r\n":
        raise ValueError("a record's length differs from its head")

    def page(name: str) -> int | None:
        found = re.search(r"-?\d+", fields.get(name, ""))
        return int(found[0]) if found else None

    response = fields["WARC-Type"] == "response"
    digest = hashlib.sha256(payload).hexdigest() if response else fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if response and fields["WARC-Payload-Digest"] != f"sha256:{digest}":
        raise ValueError("a payload differs from its digest")
    return {"page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"),
            "payload_bytes": len(payload) if response else int(fields["WARC-Payload-Length"]),
            "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To"),
            "payload": payload if response else None}


def archive(pages: DataFrame, min_bytes: int = 100, level: int = 6) -> DataFrame:
    """Writes pages as monolithic archives, normalises them, and reads the records back.

    One row per row of ``pages`` (page_id, url, html).  Of equal payloads of at least ``min_bytes``
    the smallest page_id is the response and the others are revisits of it; a null page_id is a
    revisit where the payload has an id at all.  Rows with the same id and payload are alike.  A
    null html is an empty payload, a null url an empty one.  Other columns are not read.  An empty
    table gives no row.
    """
    spark = pages.sparkSession
    raw, normal = scratch(spark, "warc-raw"), scratch(spark, "warc")
    write_monolithic(records(pages, min_bytes), raw)
    normalise(spark, raw, normal, level)
    return read_records(spark, normal)


def op1_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages")).drop("payload", "url")


OP1_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM f
"""
