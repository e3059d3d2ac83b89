"""Merkle manifest of a dataset: a store of digest -> children records, and proofs by descent.

Every row is a leaf.  The leaves of a group (here: a language) are hashed in pairs up to a subroot, the
subroots in pairs up to the root.  Nodes are kept by content: a record says which children a
digest has.  A proof is found from the root downwards: the binary digits of a leaf's rank choose the
child at each record, the child not chosen is collected, and the list is turned round at the end.

The tree is stored in pages of ``bits`` levels, so that a descent reads one page for each ``bits``
digits: a page and its requests meet in one task, and no task holds more than one page of
2 ** bits leaves, however large a group is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.common import stored, table
from corvane.llm.spans import crc32_sql, ranked

BITS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_digest(*values: Column | str) -> Column:
    """SHA-256 of the values, each ``-`` if null, else UTF-8 byte count, colon and value."""
    def framed(value: Column | str) -> Column:
        text = (F.col(value) if isinstance(value, str) else value).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[framed(v) for v in values]), 256)


@dataclass
class Forest:
    """Trees over the rows of each group.

    nodes: one table per storey of pages, from the leaves up: grp, rank, levels (still above a node),
    digest and, for leaves, what was kept.  records: one per storey: grp, page, digest, children.
    tops: grp, digest, the root of each group.
    """

    nodes: list[DataFrame]
    records: list[DataFrame]
    tops: DataFrame
    bits: int


_BUILT = "kind int, grp string, page long, levels int, digest string, children array<string>"


def _pages(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, page and rank -> the records of each page and a row for its root."""
    names = ["kind", "grp", "page", "levels", "digest", "children"]
    types = [pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.string())]
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def close(key: tuple, row: list[str]) -> None:
        grp, page, levels = key
        records: dict[str, list[str]] = {}
        for _ in range(min(levels, bits)):
            runs = [row[i:i + 2] for i in range(0, len(row), 2)]
            row = [digest("".join(run)) for run in runs]
            records.update(zip(row, runs))
        out.extend((0, grp, page, levels, d, run) for d, run in records.items())
        out.append((1, grp, page, max(levels - bits, 0), row[0], None))

    current, row = None, []
    for batch in batches:
        keys = zip(*[batch.column(c).to_pylist() for c in ("grp", "page", "levels")])
        for key, value in zip(keys, batch.column("digest").to_pylist()):
            if key != current:
                if row:
                    close(current, row)
                current, row = key, []
                if len(out) > 20_000:
                    yield flush()
                    out.clear()
            row.append(value)
    if row:
        close(current, row)
    if out:
        yield flush()


def plant(leaves: DataFrame, order: list[Column], keep: list[str], name: str, bits: int = BITS) -> Forest:
    """The trees over ``leaves`` (grp, digest, order columns): those of a group in the given order."""
    rows, sizes = ranked(leaves, "grp", order, ["grp", "digest", *keep], f"{name}-ranks")
    # ceil(log2 n) levels: the binary digits of n - 1
    levels = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0).cast("int")
    sizes = stored(sizes.select("grp", levels.alias("levels")), f"{name}-sizes")
    tallest = sizes.agg(F.max("levels")).first()[0] or 0
    nodes = [rows.join(sizes.withColumnRenamed("grp", "_grp"), F.col("grp") == F.col("_grp")).drop("_grp")]
    records = []
    for storey in range(max(1, -(-tallest // bits))):
        dealt = (nodes[-1].select("grp", F.shiftright("rank", bits).alias("page"), "levels", "rank", "digest")
                 .repartition("grp", "page").sortWithinPartitions("grp", "page", "rank"))
        built = stored(dealt.mapInArrow(lambda batches: _pages(batches, bits), _BUILT), f"{name}-records")
        records.append(built.filter("kind = 0").select("grp", "page", "digest", "children"))
        nodes.append(built.filter("kind = 1").select("grp", F.col("page").alias("rank"), "levels", "digest"))
    return Forest(nodes, records, nodes[-1].select("grp", "digest"), bits)


def follow(top: str, records: dict[str, list[str]], place: int, levels: int, wanted: str) -> list[str]:
    """Descent from ``top`` by the binary digits of ``place``: the chosen side and the sibling of each
    level, from the leaf up.  A child without sibling gives the side alone."""
    steps, at = [], top
    for level in range(levels - 1, -1, -1):
        side = place >> level & 1
        run = records[at]
        at = run[side]
        steps.append(f"{side}{run[1 - side]}" if len(run) == 2 else "0")
    if at != wanted:
        raise ValueError(f"the descent ends at {at}, not at {wanted}")
    steps.reverse()
    return steps


def fold(start: str, path: list[str]) -> str:
    """The root that a leaf and its path give."""
    for step in path:
        sibling = step[1:]
        start = digest(sibling + start if step[0] == "1" else start + sibling)
    return start


_PATH = "grp string, rank long, digest string, path string, subroot string, root string"
_PROOF = "doc_id {0}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _descend(batches: Iterator[pa.RecordBatch], bits: int, final: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, page and kind: 0 the way from the root to the page, 1 its records, 2 requests."""
    records: dict[str, list[str]] = {}
    top, upper, above, beyond = "", [], (None, None), None
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in
                   ("kind", "rank", "levels", "digest", "children", "path", "subroot", "root")}
        picked, out = [], []
        for i, kind in enumerate(columns["kind"]):
            value = columns["digest"][i]
            if kind == 0:
                records, top, beyond = {}, value, None
                upper = columns["path"][i].split(",") if columns["path"][i] else []
                above = (columns["subroot"][i], columns["root"][i])
                continue
            if kind == 1:
                records[value] = columns["children"][i]
                continue
            depth = min(columns["levels"][i], bits)
            inner = follow(top, records, columns["rank"][i] & ((1 << bits) - 1), depth, value)
            picked.append(i)
            if not final:
                out.append((",".join(inner + upper), *above))
                continue
            # An altered leaf is judged by the original siblings.
            reached = fold(columns["path"][i] or value, inner)
            if reached == top:
                beyond = beyond or fold(top, upper)  # the same for all leaves of the page
                reached = beyond
            else:
                reached = fold(reached, upper)
            out.append((value, *above, digest("".join(s[1:] for s in inner + upper)), reached, reached == above[1]))
        if not picked:
            continue
        taken = batch.take(pa.array(picked, pa.int64()))
        types = [*[pa.string()] * 5, pa.bool_()] if final else [pa.string()] * 3
        values = [pa.array(c, t) for c, t in zip(zip(*out), types)]
        if final:
            yield pa.RecordBatch.from_arrays(
                [taken.column("doc_id"), *values],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
        else:
            yield pa.RecordBatch.from_arrays(
                [taken.column("grp"), taken.column("rank"), taken.column("digest"), *values],
                ["grp", "rank", "digest", "path", "subroot", "root"])


def _ask(forest: Forest, storey: int, ways: DataFrame, final: bool) -> DataFrame:
    """One page of descent for every node of a storey; ``ways`` has the path of every page (grp, rank, ...)."""
    requests, records, bits = forest.nodes[storey], forest.records[storey], forest.bits
    null = F.lit(None)
    extra = [c for c in ("doc_id",) if final]
    page = F.shiftright("rank", bits)
    altered = F.col("altered") if final else null.cast("string")
    rows = (requests.select(
        F.lit(2).alias("kind"), "grp", page.alias("page"), "rank", "levels", "digest",
        null.cast("array<string>").alias("children"), altered.alias("path"), null.cast("string").alias("subroot"),
        null.cast("string").alias("root"), *extra)
        .unionByName(records.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        .unionByName(ways.select(F.lit(0).alias("kind"), "grp", F.col("rank").alias("page"), "digest", "path",
                                 "subroot", "root"), allowMissingColumns=True))
    dealt = rows.repartition("grp", "page").sortWithinPartitions("grp", "page", "kind", "rank")
    schema = _PROOF.format(dict(requests.dtypes)["doc_id"]) if final else _PATH
    return dealt.mapInArrow(lambda batches: _descend(batches, bits, final), schema)


def _paths(forest: Forest, ways: DataFrame, lowest: int) -> DataFrame:
    """Paths of the nodes of storey ``lowest``, from those of the tops down."""
    for storey in range(len(forest.records) - 1, lowest - 1, -1):
        ways = _ask(forest, storey, ways, False)
    return ways


@dataclass
class Manifest:
    """trees: the forest of the groups; crown: the tree over their subroots (one group, none if no rows)."""

    trees: Forest
    crown: Forest


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", id_col: str = "doc_id",
             altered: Column | None = None, bits: int = BITS) -> Manifest:
    """The stored Merkle tree of a table.

    ``altered`` may give another digest per row, which is kept beside the leaf for ``proofs``.

    A null value counts as ``-`` in its leaf; a null group is a group of its own, before the others; rows with a
    null id come first in their group.  Rows equal in group and id go by their digests; equal rows are
    equal leaves with records in common, and each has its own rank and path.  An empty table has no root.  Other columns are not read.
    """
    own = leaf_digest(*fields)
    leaves = docs.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("grp"),
                         F.col(id_col).alias("doc_id"), own.alias("digest"),
                         (F.lit(None).cast("string") if altered is None else altered).alias("altered"))
    trees = plant(leaves, [F.col("doc_id").asc_nulls_first(), F.col("digest")], ["doc_id", "altered"], "merkle", bits)
    subroots = trees.tops.select(F.lit("").alias("grp"), F.col("grp").alias("lang"), "digest")
    return Manifest(trees, plant(subroots, [F.col("lang")], ["lang"], "merkle-crown", bits))


def proofs(tree: Manifest) -> DataFrame:
    """Every leaf's proof: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``proof_sha256`` is the digest of the siblings from the leaf to the root, left to right (none: of
    the empty string).  ``folded_root`` is recomputed from the altered digest where there is one, else from
    the leaf, with the siblings found; ``verified`` tells whether it is the root.
    """
    top = tree.crown.tops.select("grp", F.lit(0).cast("long").alias("rank"), "digest", F.lit("").alias("path"),
                                 F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    langs = tree.crown.nodes[0].select(F.col("rank").alias("_rank"), F.col("lang").alias("_lang"))
    ways = _paths(tree.crown, top, 0).join(langs, F.col("rank") == F.col("_rank")).select(
        F.col("_lang").alias("grp"), F.lit(0).cast("long").alias("rank"), "digest", "path",
        F.col("digest").alias("subroot"), "root")
    ways = stored(_paths(tree.trees, ways, 1), "merkle-ways")
    return _ask(tree.trees, 0, ways, True)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = F.coalesce(F.try_add("n_chars", F.lit(1)), F.col("n_chars"))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0,
                      leaf_digest(*[more if f == "n_chars" else f for f in FIELDS]))
    return proofs(manifest(table(spark, sf_dir, "documents"), altered=tampered))


def _sql(levels: int = 20, crown: int = 10) -> str:
    """Level by level, for up to 2 ** levels rows in a language and 2 ** crown languages."""
    def framed(c: str) -> str:
        return f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(framed(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"

    steps = [f"""l0 as (select *, row_number() over (partition by lang order by doc_id nulls first, d) - 1 as r,
        count(*) over (partition by lang) as n from (select doc_id, lang, {leaf('n_chars')} as d,
        {leaf('(n_chars + 1)')} as changed, {crc32_sql('doc_id::varchar')} % 7 = 0 as hit from documents))""",
        "p0 as (select lang, r, n, d from l0)"]
    for k in range(levels):
        steps.append(f"""p{k + 1} as (select lang, r // 2 as r, any_value((n + 1) // 2) as n, case when any_value(n) = 1 then any_value(d)
            else sha256(string_agg(d, '' order by r)) end as d from p{k} group by lang, r // 2)""")
    steps.append(f"""c0 as (select lang, d, row_number() over (order by lang nulls first) - 1 as r, count(*) over () as n
        from p{levels})""")
    for k in range(crown):
        steps.append(f"""c{k + 1} as (select r // 2 as r, any_value((n + 1) // 2) as n, case when any_value(n) = 1 then any_value(d)
            else sha256(string_agg(d, '' order by r)) end as d from c{k} group by r // 2)""")
    path = [(f"p{k}", f"s{k}.lang is not distinct from f{k}.lang and s{k}.r = xor(f{k}.r >> {k}, 1)", f"f{k}.r >> {k}",
             f"(f{k}.n - 1) >> {k} > 0") for k in range(levels)]
    path += [(f"c{k}", f"s{levels + k}.r = xor(f{levels + k}.lr >> {k}, 1)", f"f{levels + k}.lr >> {k}",
              f"(f{levels + k}.ln - 1) >> {k} > 0") for k in range(crown)]
    steps.append("""f0 as (select l0.*, c0.d as subroot, c0.r as lr, c0.n as ln, '' as proof,
        case when hit and changed is not null then changed else l0.d end as cur from l0 join c0 on l0.lang is not distinct from c0.lang)""")
    for k, (side, met, digit, inside) in enumerate(path):
        steps.append(f"""f{k + 1} as (select f{k}.* exclude (proof, cur), proof || case when {inside} then coalesce(s{k}.d, '') else '' end as proof,
            case when not ({inside}) then cur when ({digit}) % 2 = 1 then sha256(s{k}.d || cur)
            else sha256(cur || coalesce(s{k}.d, '')) end as cur
            from f{k} left join {side} s{k} on {inside} and {met})""")
    last = f"f{len(path)}"
    return (f"with {', '.join(s.replace(' as (', ' as materialized (', 1) for s in steps)} select doc_id, {last}.d as leaf, subroot, c{crown}.d as root, "
            f"sha256(proof) as proof_sha256, cur as folded_root, cur = c{crown}.d as verified "
            f"from {last} cross join c{crown}")


OP13_SQL = _sql()
