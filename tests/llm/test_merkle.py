"""The Merkle manifest against a tree built in plain Python."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from corvane.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp string, rank string, digest long, kind string"


def h(text):
    return sha256(text.encode()).hexdigest()


def brute(rows, altered=lambda row: None):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row."""
    def leaf(values):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tree(digests):
        paths, level, at = [[] for _ in digests], digests, list(range(len(digests)))
        while len(level) > 1:
            for path, i in zip(paths, at):
                path.append((i % 2, level[i ^ 1] if i ^ 1 < len(level) else ""))
            level = [h("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
            at = [i // 2 for i in at]
        return level[0], paths

    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    held, tops = [], []
    for lang in langs:
        mine = sorted(((r[0] is not None, r[0] or 0, leaf((r[0], r[3], r[2], r[4], r[1]))), r) for r in rows if r[2] == lang)
        top, paths = tree([key[2] for key, _ in mine])
        tops.append(top)
        held.append((mine, paths))
    root, crown = tree(tops) if tops else (None, [])
    out = []
    for (mine, paths), top, above in zip(held, tops, crown):
        for (key, row), path in zip(mine, paths):
            whole = path + above
            now = altered(row)
            now = key[2] if now is None else leaf((now[0], now[3], now[2], now[4], now[1]))
            for side, sibling in whole:
                now = h(sibling + now if side else now + sibling)
            out.append((row[0], key[2], top, root, h("".join(s for _, s in whole)), now, now == root))
    return sorted(out, key=repr)


def proofs(spark, rows, bits, hit=None):
    docs = spark.createDataFrame(rows, DOCS)
    changed = None if hit is None else F.when(F.col("doc_id") % 7 == hit, merkle.leaf_digest(
        "doc_id", "source", "lang", F.col("n_chars") + 1, "text"))
    got = merkle.proofs(merkle.manifest(docs, altered=changed, bits=bits))
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("bits, sizes", [(2, (1, 2, 5, 16, 17, 70)), (3, (8, 9, 1)), (12, (33, 4))])
def test_pages_of_several_storeys(spark, bits, sizes):
    rows = [(i * 3 + 100 * g, f"text {i % 4}", f"l{g}", "s", 5, None, None, 0, None) for g, n in enumerate(sizes) for i in range(n)]
    want = brute(rows, lambda r: (*r[:4], r[4] + 1) if r[0] % 7 == 3 else None)
    assert proofs(spark, rows, bits, 3) == want
    assert {w[6] for w in want} == {True, False}


def test_odd_rows(spark):
    rows = [(None, None, None, None, None, "g", "r", 1, "k"), (None, "", "", "s", 0, "g", "r", 1, "k"), (4, "é" * 50_000, "fr", "ß", 1, None, None, 1, None),
            (4, "other text, same id", "fr", "ß", 1, None, None, 1, None), (4, "other text, same id", "fr", "ß", 1, None, None, 1, None),
            (-7, "x", "é", None, 1, None, None, 1, None), (9, "x", "z", None, None, None, None, 1, None)]
    assert proofs(spark, rows, 1) == brute(rows) == proofs(spark, rows, 12)
    assert proofs(spark, [], 12) == []
    assert proofs(spark, rows[:1], 12) == brute(rows[:1])  # a lone leaf is the root


def test_a_false_record_is_noticed(spark):
    with pytest.raises(ValueError):
        merkle.follow("a", {"a": ["b", "c"]}, 1, 1, "b")
