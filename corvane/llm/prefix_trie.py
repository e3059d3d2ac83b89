"""Trie of shared conversation beginnings, summed from the leaves up by time-forward processing.

A node is a distinct sequence of first turns.  Its key is the XOR of a hash per (place, turn), so keys are
prefix sums: a conversation of any length is cut into blocks that are keyed apart and then shifted.

Totals go from the leaves to the root:

* Nodes are dealt into shards, each a set of whole subtrees or bands of them.  A task sorts its nodes by
  reverse level order (Spark's external sort) and sends every total forward to the parent through a
  priority queue that spills to disk; a node finds its children's messages at the head of the queue.
* What reaches the root of a shard leaves it as a message.  Messages of bands below other bands are
  brought together in a small tree of bands, those to the few nodes above all shards are summed per
  node, and the same pass runs over these.

The nodes above all shards ("heavy") are those that more than 1/4096 of all turns run through, so they
are 4096 at most, with the root 4097.
"""

from __future__ import annotations

import heapq
import struct
import tempfile
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.llm.common import empty_text, stored, table
from corvane.llm.spans import crc32_sql, ranked

HEAVY = 4096
"""A node is heavy if it is passed by more than this fraction of all turns, and by ``LEAST`` at least."""
LEAST = 256
BAND = 4096
"""Levels of a shard."""
QUEUE = 200_000
"""Messages of the priority queue in memory."""
KEY = ["depth", "x", "y"]


class SpillingQueue:
    """Priority queue of (level, x, y, leaves, saved), least first; beyond ``limit`` it writes sorted runs."""

    RECORD = struct.Struct("<5q")

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.heads, self.runs = limit, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            file = tempfile.TemporaryFile()  # has no name: gone with the task
            for spilled in sorted(self.heap):
                file.write(self.RECORD.pack(*spilled))
            file.seek(0)
            self.heap = []
            run = self._read(file)
            self.runs += 1
            heapq.heappush(self.heads, (next(run), self.runs, run))

    def _read(self, file) -> Iterator[tuple]:
        while chunk := file.read(self.RECORD.size * 4096):
            yield from self.RECORD.iter_unpack(chunk)

    def pop_at(self, key: tuple) -> Iterator[tuple]:
        """Messages addressed to ``key``, which are the least ones left."""
        while self.heap and self.heap[0][:3] == key:
            yield heapq.heappop(self.heap)
        while self.heads and self.heads[0][0][:3] == key:
            item, number, run = self.heads[0]
            yield item
            after = next(run, None)
            if after is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (after, number, run))

    def __len__(self) -> int:
        return len(self.heap) + len(self.heads)


def turns_in_order(turns: DataFrame) -> DataFrame:
    """conv_id, idx (from 1), turn hash, bytes of the text; by turn (null first), then role and text."""
    role, text = empty_text(F.col("role").cast("string")), empty_text("text")
    framed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.sha2(framed, 256).alias("hash"),
        F.octet_length(text).cast("long").alias("bytes"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    numbered, _ = ranked(rows, "conv_id", order, ["hash", "bytes"], "trie-turns")
    return numbered.select("conv_id", (F.col("rank") + 1).alias("idx"), "hash", "bytes")


def rebuilt(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations as (conv_id, pos, hash, bytes, last), and the ids of those without a turn.

    ``turns`` is conv_id, idx, hash, bytes.  With h = crc32(conv_id) % most, conversation c begins with the
    first h turns of c - c % family and goes on with its own turns after its first h.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    base = F.col("conv_id") - F.col("conv_id") % family
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    heads = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = own.withColumn("h", h).withColumn("base", base).join(heads, "base", "left").select(
        F.col("conv_id").alias("id"), "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("shared"), "n")
    plan = stored(plan.withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-plan")
    rest = turns.join(plan, F.col("conv_id") == F.col("id")).filter("idx > h").select(
        "conv_id", (F.col("idx") - F.col("h") + F.col("shared")).alias("pos"), "hash", "bytes", "length")
    # the ids of a family on either side of zero have one base
    wanted = F.explode(F.sequence(F.lit(1 - family), F.lit(family - 1))).alias("step")
    lent = (turns.filter((F.col("idx") < most) & (F.col("conv_id") % family == 0))
            .select("*", wanted).withColumn("target", F.col("conv_id") + F.col("step"))
            .filter(F.col("target") - F.col("target") % family == F.col("conv_id"))
            .join(plan, F.col("target") == F.col("id")).filter("idx <= h")
            .select(F.col("target").alias("conv_id"), F.col("idx").alias("pos"), "hash", "bytes", "length"))
    whole = rest.unionByName(lent).select("conv_id", "pos", "hash", "bytes", (F.col("pos") == F.col("length")).alias("last"))
    return whole, plan.select(F.col("id").alias("conv_id"), "length")


def keyed(whole: DataFrame, band: int) -> DataFrame:
    """Every turn with the key (x, y) of the prefix that ends there, that of the prefix before it, and that of
    the prefix before its band of ``band`` levels."""
    placed = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("hash")), 256)
    # 60 bits of the hash each
    lane = lambda at: F.conv(F.substring("_placed", at, 15), 16, 10).cast("long")
    rows = (whole.withColumn("_placed", placed).withColumn("_x", lane(1)).withColumn("_y", lane(16))
            .withColumn("band", F.floor((F.col("pos") - 1) / band)).drop("_placed", "hash"))
    totals = rows.groupBy("conv_id", "band").agg(F.bit_xor("_x").alias("tx"), F.bit_xor("_y").alias("ty"))
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("conv_id", "band", *[F.coalesce(F.bit_xor(t).over(before), F.lit(0)).alias(a)
                                               for t, a in (("tx", "ax"), ("ty", "ay"))])
    inside = Window.partitionBy("conv_id", "band").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    x, y = (F.col(a).bitwiseXOR(F.bit_xor(c).over(inside)) for a, c in (("ax", "_x"), ("ay", "_y")))
    return (rows.join(starts, ["conv_id", "band"]).withColumn("x", x).withColumn("y", y)
            .select("conv_id", F.col("pos").alias("depth"), "x", "y", F.col("x").bitwiseXOR(F.col("_x")).alias("px"),
                    F.col("y").bitwiseXOR(F.col("_y")).alias("py"), "band", "ax", "ay", "bytes", "last"))


def _id_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and conversation -> pieces of the comma-joined ids of a node."""
    for batch in batches:
        out: list[list] = []
        for *node, conv in zip(*[batch.column(c).to_pylist() for c in (*KEY, "conv_id")]):
            if out and out[-1][:3] == node:
                out[-1][4].append(str(conv))
            else:
                out.append([*node, conv, [str(conv)]])
        if out:
            columns = [list(c) for c in zip(*out)]
            columns[4] = [",".join(ids) for ids in columns[4]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [*[pa.int64()] * 4, pa.string()])],
                                             [*KEY, "first", "ids"])


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by node and first id -> one digest per node."""
    node, state = None, None

    def closed(rows: list[tuple]) -> pa.RecordBatch:
        types = [*[pa.int64()] * 3, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [*KEY, "ends_sha256"])

    for batch in batches:
        done = []
        for *key, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")]):
            if key == node:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                done.append((*node, state.hexdigest()))
            node, state = key, sha256(ids.encode())
        if done:
            yield closed(done)
    if state is not None:
        yield closed([(*node, state.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids of each node: depth, x, y, ends_sha256.

    A node may end a third of all conversations: ranges of (node, id) are joined to pieces of text by
    many tasks, and only the pieces, a batch of ids each, meet in the task that hashes them in turn.
    """
    pieces = (ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").select(*KEY, "conv_id")
              .mapInArrow(_id_chunks, "depth long, x long, y long, first long, ids string"))
    return (pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "ids")
            .mapInArrow(_id_digests, "depth long, x long, y long, ends_sha256 string"))


_FLOW = "kind int, depth long, x long, y long, n_leaves long, saved_tokens long"


def _forward(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Time-forward pass over one shard, sorted by level from the deepest up, key and kind.

    Rows of kind 0 are messages from other shards to a node, kind 1 are nodes with their own leaf and
    saving.  Gives every node's total (kind 1) and what leaves the shard (kind 0), addressed to a node.
    """
    names = ["kind", *KEY, "n_leaves", "saved_tokens"]
    queue, outside, leaves, saved = SpillingQueue(limit), {}, 0, 0
    for batch in batches:
        out = []
        columns = [batch.column(c).to_pylist() for c in ("kind", *KEY, "px", "py", "is_root", "n_leaves", "saved_tokens")]
        for kind, depth, x, y, px, py, is_root, own_leaves, own_saved in zip(*columns):
            leaves += own_leaves
            saved += own_saved
            if kind == 0:
                continue  # the node follows at once
            for message in queue.pop_at((-depth, x, y)):
                leaves += message[3]
                saved += message[4]
            out.append((1, depth, x, y, leaves, saved))
            if is_root:
                outside[depth - 1, px, py] = [a + b for a, b in zip(outside.get((depth - 1, px, py), (0, 0)), (leaves, saved))]
            elif depth:
                queue.push((1 - depth, px, py, leaves, saved))
            leaves = saved = 0
            if len(outside) > limit:
                out += [(0, *to, *total) for to, total in outside.items()]
                outside = {}
        if out:
            yield _rows(out, names)
    if outside:
        yield _rows([(0, *to, *total) for to, total in outside.items()], names)
    if len(queue) or leaves or saved:
        raise RuntimeError("messages without a node: the shard is not closed")


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int32(), *[pa.int64()] * (len(names) - 1)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def forward(nodes: DataFrame, shard: list[str], messages: DataFrame | None, limit: int) -> DataFrame:
    """``_forward`` over shards: nodes have depth, x, y, px, py, is_root, n_leaves, saved_tokens and the shard
    columns; messages have depth, x, y, n_leaves, saved_tokens and the shard of the node addressed."""
    rows = nodes.select(F.lit(1).alias("kind"), *KEY, "px", "py", "is_root", "n_leaves", "saved_tokens", *shard)
    if messages is not None:
        rows = rows.unionByName(messages.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    order = [F.desc("depth"), "x", "y", "kind"]
    dealt = rows.repartition(*shard).sortWithinPartitions(*order) if shard else rows.coalesce(1).sortWithinPartitions(*order)
    return dealt.drop(*shard).mapInArrow(lambda batches: _forward(batches, limit), _FLOW)


def _summed(messages: DataFrame) -> DataFrame:
    return messages.groupBy(*KEY).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def trie(turns: DataFrame, heavy: int = HEAVY, least: int = LEAST, band: int = BAND, queue: int = QUEUE) -> DataFrame:
    """The nodes of the trie over the rebuilt conversations (see ``rebuilt``), one row each.

    conv_id (the smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.  Turns go by turn (null first), then role and text; repeated rows are turns of
    their own.  A null role or text is empty.  Rows without a conv_id belong to no conversation.  An empty
    table has no node.  Other columns are not read.  The limits change the work, not the result.
    """
    whole, lengths = rebuilt(turns_in_order(turns))
    paths = stored(keyed(whole, band), "trie-paths")
    n_convs, smallest, n_turns = lengths.agg(F.count(F.lit(1)), F.min("conv_id"), F.sum("length")).first()
    if not n_convs:
        return turns.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, "
                                                  "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    bound = max(least, n_turns // heavy)
    grouped = paths.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("bytes").alias("bytes"),
        *[F.min(c).alias(c) for c in ("px", "py", "band", "ax", "ay")])
    root = turns.sparkSession.createDataFrame(
        [(0, 0, 0, n_convs, smallest, 0, 0, 0, 0, 0, 0)],
        "depth long, x long, y long, n_convs long, conv_id long, bytes long, px long, py long, band long, ax long, ay long")
    nodes = stored(grouped.unionByName(root), "trie-nodes")
    children = nodes.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count(F.lit(1)).alias("n_children"))
    own = (nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
           .withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
           .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("bytes")))
    own = stored(own, "trie-own")
    is_heavy = (F.col("depth") == 0) | (F.col("n_convs") > bound)
    # At most 4097 rows: each heavy node is passed by more than 1/4096 of the turns.
    crown = own.filter(is_heavy)
    above = F.broadcast(crown.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"),
                                     F.col("conv_id").alias("heavy_parent")))
    light = own.filter(~is_heavy)
    # A conversation passes one light node below a heavy one at most: the root of its shard.
    tops = (light.select(*KEY, "px", "py").join(above, ["depth", "px", "py"]).select(*KEY))
    entered = (paths.join(above, ["depth", "px", "py"]).join(F.broadcast(crown.select(*KEY)), KEY, "left_anti")
               .select(F.col("conv_id").alias("_conv"), F.col("depth").alias("top_depth"), F.col("x").alias("top_x"), F.col("y").alias("top_y")))
    # Below its first band a shard goes on in bands of its own, named by the node above the band.
    anchored = F.col("band") * band >= F.col("top_depth")
    shard = ["unit_depth", "unit_x", "unit_y"]
    dealt = (light.join(entered, F.col("conv_id") == F.col("_conv"))
             .withColumn("unit_depth", F.when(anchored, F.col("band") * band).otherwise(F.col("top_depth")))
             .withColumn("unit_x", F.when(anchored, F.col("ax")).otherwise(F.col("top_x")))
             .withColumn("unit_y", F.when(anchored, F.col("ay")).otherwise(F.col("top_y")))
             .withColumn("deep", anchored)
             .withColumn("is_root", F.when(anchored, F.col("depth") == F.col("unit_depth") + 1).otherwise(F.col("depth") == F.col("top_depth")))
             .drop("_conv", "top_depth", "top_x", "top_y"))
    dealt = stored(dealt, "trie-shards")
    messages = _between_bands(dealt, shard, band, queue) if paths.agg(F.max("band")).first()[0] else None
    passed = stored(forward(dealt, shard, messages, queue), "trie-totals")
    # To heavy nodes; what a band sends to a light node came with ``messages``.
    to_crown = passed.filter("kind = 0").join(F.broadcast(crown.select(*KEY)), KEY, "left_semi").drop("kind")
    top = forward(crown.withColumn("is_root", F.lit(False)), [], _summed(to_crown), queue)
    totals = passed.filter("kind = 1").unionByName(top.filter("kind = 1")).drop("kind")
    plain = own.drop("n_leaves", "saved_tokens", "bytes", "band", "ax", "ay")
    below_heavy = plain.join(above, ["depth", "px", "py"]).withColumnRenamed("heavy_parent", "parent_conv_id")
    parents = light.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"),
                           F.col("conv_id").alias("parent_conv_id"))
    named = (below_heavy.unionByName(plain.join(parents, ["depth", "px", "py"]))
             .unionByName(plain.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))))
    turnless = lengths.filter("length = 0").select("conv_id", *[F.lit(0).cast("long").alias(k) for k in KEY])
    ends = end_digests(paths.filter("last").select("conv_id", *KEY).unionByName(turnless))
    return named.join(totals, KEY).join(ends, KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def _between_bands(dealt: DataFrame, shard: list[str], band: int, queue: int) -> DataFrame:
    """Messages to the light nodes above deep bands.

    A pass inside the shards gives what each band holds by itself.  The bands form a tree, with about a
    band's length of turns for each, whose totals are found by one more pass.
    """
    local = forward(dealt, shard, None, queue).filter("kind = 0").drop("kind")
    deep = dealt.filter("deep").select(*[F.col(s).alias(k) for s, k in zip(shard, KEY)]).distinct()
    held = _summed(local).join(deep, KEY)  # one row per deep band, by the node that it hangs on
    hung = held.join(dealt.select(*KEY, *shard, "deep"), KEY)  # and the shard of that node
    hung = stored(hung, "trie-bands")
    # A band is named by the node above it, so its parent is the shard of that node where that is a deep band.
    tree = hung.select(*KEY, F.col("unit_x").alias("px"), F.col("unit_y").alias("py"), F.col("deep").alias("up"),
                       "n_leaves", "saved_tokens")
    by_level = tree.select(F.expr(f"depth div {band}").alias("depth"), "x", "y", "px", "py", (~F.col("up")).alias("is_root"),
                           "n_leaves", "saved_tokens")
    totals = forward(by_level, [], None, queue).filter("kind = 1").drop("kind")
    return (totals.withColumn("depth", F.col("depth") * band).join(hung.select(*KEY, *shard), KEY)
            .select(*KEY, *shard, "n_leaves", "saved_tokens"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


OP12_SQL = f"""
with turns as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as idx
    from conversations where conv_id is not null),
convs as (select conv_id, {crc32_sql('conv_id::varchar')} % 9 as h, count(*) as n from turns group by conv_id),
plan as (select c.conv_id, c.h, least(c.h, coalesce(b.n, 0)) as shared
    from convs c left join convs b on b.conv_id = c.conv_id - c.conv_id % 5),
rebuilt as (select p.conv_id, t.idx as pos, role, text from plan p join turns t on t.conv_id = p.conv_id - p.conv_id % 5 and idx <= h
    union all select p.conv_id, t.idx - h + shared, role, text from plan p join turns t on t.conv_id = p.conv_id and idx > h),
paths as (select conv_id, pos, strlen(text) as bytes, count(*) over (partition by conv_id) as length,
        string_agg(sha256(strlen(role) || ':' || role || text), '') over (partition by conv_id order by pos) as path
    from rebuilt
    union all select conv_id, 0, 0, (select count(*) from rebuilt r where r.conv_id = convs.conv_id), '' from convs),
nodes as (select path, pos as depth, min(conv_id) as conv_id, count(*) as n_convs, min(bytes) as bytes,
        sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (length = pos), '')) as ends_sha256
    from paths group by path, pos),
own as (select n.*, p.conv_id as parent_conv_id, (select count(*) from nodes c where c.depth = n.depth + 1 and substr(c.path, 1, 64 * n.depth) = n.path) as n_children
    from nodes n left join nodes p on p.depth = n.depth - 1 and p.path = substr(n.path, 1, 64 * (n.depth - 1))),
sums as (select a.path, sum((o.n_children = 0)::bigint)::bigint as n_leaves, sum((o.n_convs - 1) * o.bytes)::bigint as saved_tokens
    from own o join paths a on a.conv_id = o.conv_id and a.pos <= o.depth group by a.path)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
from own join sums using (path)"""
