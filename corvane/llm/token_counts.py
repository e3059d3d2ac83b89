"""Token counts that follow edits: a segment tree of pre-tokens per document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.binding import let
from corvane.llm import tokens
from corvane.llm.common import empty_text, lean, table, text_blocks
from corvane.llm.secrets import places

LEAF = 64
"""Pre-tokens in a leaf when a tree is built."""
LOOKAHEAD = 2
"""A pre-token's end depends on so many code points after it at most."""

_PRE_TOKEN = regex.compile(tokens.PATTERN)
Edit = tuple[int, int, str]


class CountTree:
    """Sums of code points and tokens over a document's leaves, each a run of whole pre-tokens.

    ``chars[1]`` and ``tokens[1]`` are the root; node i has the children 2i and 2i + 1.
    """

    def __init__(self, chars: list[int], counts: list[int]):
        self.size = 1 << max(0, len(chars) - 1).bit_length()
        self.leaves = len(chars)
        self.chars = [0] * self.size + chars + [0] * (self.size - len(chars))
        self.tokens = [0] * self.size + counts + [0] * (self.size - len(counts))
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a code point, and where that leaf begins; the last one for the end."""
        node, begin = 1, 0
        place = min(place, max(0, self.chars[1] - 1))
        while node < self.size:
            node *= 2
            if place - begin >= self.chars[node]:
                begin += self.chars[node]
                node += 1
        return node - self.size, begin

    def put(self, leaf: int, chars: int, count: int) -> None:
        node = leaf + self.size
        more, extra = chars - self.chars[node], count - self.tokens[node]
        while node:
            self.chars[node] += more
            self.tokens[node] += extra
            node >>= 1

    def edit(self, text: str, edit: Edit, count) -> tuple[str, int]:
        """Applies one edit: the new text, and how many pre-tokens were encoded again.

        Encodes from the last leaf start that the edit cannot move to the first leaf end where
        pre-tokens meet again.  All others stand.
        """
        start, end, new = edit
        a, begin = self.find(start)
        while a > 0 and start - begin < LOOKAHEAD:  # the leaf before may end elsewhere now
            a -= 1
            begin -= self.chars[a + self.size]
        b, stop = self.find(max(start, end - 1))
        stop += self.chars[b + self.size]
        changed = text[:start] + new + text[end:]
        shift = len(new) - (end - start)
        while True:
            after = b + 1
            context = 0
            while after < self.leaves and context < LOOKAHEAD + 1:
                context += self.chars[after + self.size]
                after += 1
            length, made = 0, []
            whole = stop + shift - begin
            for found in _PRE_TOKEN.findall(changed[begin:stop + shift + context]):
                if length >= whole:
                    break
                length += len(found)
                made.append((len(found), count(found)))
            if length == whole or b + 1 >= self.leaves:
                break
            b += 1
            stop += self.chars[b + self.size]
        # The leaves met share the new pre-tokens, so that none grows with the number of edits.
        share = max(1, -(-len(made) // (b - a + 1)))
        for leaf in range(a, b + 1):
            mine = made[(leaf - a) * share:(leaf - a + 1) * share]
            self.put(leaf, sum(m[0] for m in mine), sum(m[1] for m in mine))
        return changed, len(made)

    def dump(self) -> bytes:
        return np.array([self.chars[self.size:self.size + self.leaves],
                         self.tokens[self.size:self.size + self.leaves]], "<i4").tobytes()

    @classmethod
    def load(cls, data: bytes) -> CountTree:
        chars, counts = np.frombuffer(data, "<i4").reshape(2, -1).tolist()
        return cls(chars, counts)


def trees(texts: list[str], encode: tokens.Encoder) -> Iterator[tuple[int, int, np.ndarray]]:
    """Tokens, pre-tokens and leaves (code points, tokens) of every text."""
    points, firsts = tokens.code_points(texts)
    cuts = encode.cuts(points, firsts[firsts < len(points)])
    slots = encode.slots(points, cuts)
    lengths = encode.lengths[slots]
    bounds = np.append(cuts, len(points))
    of = np.searchsorted(cuts, np.append(firsts, len(points)))
    for i, (a, b) in enumerate(zip(of[:-1].tolist(), of[1:].tolist())):
        if a == b:
            yield 0, 0, np.zeros((2, 1), "<i4")
            continue
        at = np.arange(a, b, LEAF)
        chars = np.diff(bounds[np.append(at, b)])
        counts = np.add.reduceat(lengths[a:b], at - a)
        yield int(counts.sum()), b - a, np.array([chars, counts], "<i4")


def with_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: Column | None = None,
               tokenizer: str | None = None) -> DataFrame:
    """(id, text, edits, n_tokens, n_pretokens, tree) of every document.

    The tree is a binary column; a table of this form is what later edits need.  A null text counts
    as empty and has no token.  Null ids and repeated rows are rows like others; other columns are
    not read; an empty table gives no row.
    """
    path = tokenizer or tokens.default_path()
    kind = "array<struct<start:int,stop:int,text:string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        for batch, texts in text_blocks(batches, "text"):
            found = list(trees(texts, encode))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text"), batch.column("edits"),
                 pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([f[2].tobytes() for f in found], pa.binary())],
                names=["id", "text", "edits", "n_tokens", "n_pretokens", "tree"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), empty_text(text_col).alias("text"),
                       (F.lit(None) if edits is None else edits).cast(kind).alias("edits"))
    return rows.mapInArrow(lean(run), f"id long, text string, edits {kind}, n_tokens long, n_pretokens long, tree binary")


def apply_edits(rows: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``rows`` of ``with_trees`` after their edits, as that form again, with what it cost.

    An edit replaces the code points from start to stop by its text.  Edits of a row refer to its
    text as it is and do not overlap; they are applied from the last to the first.  Null edits are
    none.  Returns id, text, n_tokens (now), tree, n_before, n_edits, reencoded (pre-tokens).
    """
    path = tokenizer or tokens.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        known: dict[str, int] = {}

        def count(word: str) -> int:
            n = known.get(word)
            if n is None:
                if len(known) > 200_000:
                    known.clear()
                n = len(encode.bpe.encode_ordinary(word))
                if len(word) <= tokens.LONG:
                    known[word] = n
            return n

        for batch, texts in text_blocks(batches, "text"):
            out = []
            columns = [batch.column(c).to_pylist() for c in ("id", "edits", "n_tokens", "tree")]
            for text, doc, edits, old, data in zip(texts, *columns):
                made = 0
                if edits:
                    tree = CountTree.load(data)
                    for e in sorted(edits, key=lambda e: (e["start"], e["stop"]), reverse=True):
                        text, n = tree.edit(text, (e["start"], e["stop"], e["text"] or ""), count)
                        made += n
                    data, total = tree.dump(), tree.total
                else:
                    total = old
                out.append((doc, text, total, data, old, len(edits or ()), made))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.int64(), pa.binary(),
                                                           pa.int64(), pa.int64(), pa.int64()))],
                names=["id", "text", "n_tokens", "tree", "n_before", "n_edits", "reencoded"])

    return rows.select("id", "text", "edits", "n_tokens", "tree").mapInArrow(
        lean(run), "id long, text string, n_tokens long, tree binary, n_before long, n_edits long, reencoded long")


REDACTED = r"(?:\G|(?<![\w.+-]))[\w.+-]++@[\w-]+\.[\w.-]+|\d{6,}"
"""E-mail addresses and long numbers.  An address begins where its run does, so no run is read twice."""


def redactions(text: Column, pattern: str = REDACTED, mask: str = "[REDACTED]") -> Column:
    """Edits that mask e-mail addresses and long numbers, and one that takes off the last line."""
    t = empty_text(text)
    masks = F.transform(places(t, pattern), lambda s: F.struct(
        s["start"].cast("int").alias("start"), s["end"].cast("int").alias("stop"), F.lit(mask).alias("text")))
    total = F.char_length(t)
    kept = total - F.when(F.contains(t, F.lit("\n")),
                          F.char_length(F.substring_index(t, "\n", -1)) + 1).otherwise(0)

    def chosen(ends: Column) -> Column:
        last = F.struct(ends["kept"].alias("start"), ends["total"].alias("stop"), F.lit("").alias("text"))
        return F.concat(F.filter(masks, lambda e: e["stop"] <= ends["kept"]),
                        F.filter(F.array(last), lambda e: e["start"] < e["stop"]))

    return let(F.struct(kept.alias("kept"), total.alias("total")), chosen)


def op10_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after its redactions."""
    docs = table(spark, sf_dir, "documents")
    edited = apply_edits(with_trees(docs, edits=redactions(F.col("text"))))
    return edited.select(F.col("id").alias("doc_id"), F.col("n_before").alias("n_tokens"), "n_edits",
                         F.col("n_tokens").alias("n_tokens_edited"), "reencoded",
                         F.sha2(F.col("text").cast("binary"), 256).alias("edited_sha256"))
