"""The training-data operators against brute force, and on the rows that tables may hold."""

import hashlib
import itertools
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check_oracle
import corpus_pipeline
from corvane.llm import (catalogue, components, decontamination, exact_dedup, jaccard_join, language, line_dedup,
                         packing, resampling, sharding, token_counts, tokens, warc)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, positions string, score string, node long"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def words(seed, n, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, clashing column names."""
    line = "a line that many documents share"
    texts = [None, "", "\n", "x", words(1, 40), words(1, 40), line + "\n" + words(2, 30), line.upper() + " \n" + words(3, 30),
             "\t" + line, "é'll <|endoftext|>  don't\r\n½", words(4, 30_000), "%%% 123", None]
    rows = [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 2}", 1, "p", "s", 0) for i, t in enumerate(texts)]
    return rows + [rows[4], (None, "no id " + words(5, 20), "fr", "s1", 1, "p", "s", 0), (4, "another text, same id", "en", "s0", 1, "p", "s", 0)]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@needs_tables
@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_oracle(spark, name):
    problem, _, _ = check_oracle.compare(spark, check_oracle.connect(SF), SF, name)
    assert problem is None, problem


def test_queries_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in catalogue.QUERIES}
    assert set(catalogue.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_ids_equal_tokenizers():
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokens.default_path())
    draw = random.Random(3)
    parts = ["'", "s", "t", "re", "ve", "ll", "d", " ", "  ", "\n", "\t", "a", "B", "é", "1", "²", "½", "_", "-", "\xa0",
             "中", "\U0001F600", "\x85", "\x1c", "<|endoftext|>", "'S", "x" * 60]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(14))) for _ in range(3000)] + [words(9, 2000)]
    encode = tokens.Encoder(tokens.default_path(), cache=500)
    for start in range(0, len(texts), 100):
        flat, begins = encode.encode(texts[start:start + 100])
        for i, found in enumerate(reference.encode_batch(texts[start:start + 100], add_special_tokens=False)):
            assert flat[begins[i]:begins[i + 1]].tolist() == found.ids


def test_packing(spark, odd, odd_rows, empty):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokens.default_path())
    rows = packing.pack(odd.repartition(3)).collect()
    pieces = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids_crc32"], r["length"]) for r in rows)
    want = []
    for r in odd_rows:
        ids = reference.encode(r[1] or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want += [(r[0] is None, r[0] or 0, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), b - a) for a, b in zip(cuts, cuts[1:])]
    assert pieces == sorted(want)
    for _, of in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), lambda r: r["sequence_id"]):
        end = 0
        for r in of:
            assert r["offset"] == end
            end += r["length"]
        assert end <= 1024
    assert packing.pack(empty).count() == 0


def test_bins_close_the_fullest():
    bins = packing.Bins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 8, 9, 4, 1)] == [(0, 0), (1, 0), (1, 7), (2, 0), (3, 0), (0, 6), (2, 8)]


def test_exact_dedup(spark, odd, odd_rows, empty):
    for old in (odd.doc_id <= 5, odd.doc_id > 99, odd.doc_id < 99):
        got = exact_dedup.exact_dedup(odd, old).collect()
        assert len(got) == len(odd_rows)
        for r in got:
            same = [x[0] for x in odd_rows if hashlib.sha256((x[1] or "").encode()).hexdigest() == r["text_sha256"]]
            assert (r["group_size"], r["keep_id"]) == (len(same), max((i for i in same if i is not None), default=None))
    assert exact_dedup.exact_dedup(empty, empty.doc_id > 0).count() == 0


def test_perfect_hash():
    keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(6000)), np.uint8).reshape(-1, 32)
    made = exact_dedup.PerfectHash.build(keys[:5000], np.arange(5000), np.ones(5000, np.int64))
    again = exact_dedup.PerfectHash.load(made.dump())
    slots = again.lookup(keys)
    assert sorted(slots[:5000]) == list(range(5000)) and (slots[5000:] == -1).all()
    assert (again.winners[slots[:5000]] == np.arange(5000)).all()


def brute_lines(rows):
    held = {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
            if len(key) >= 20:
                held.setdefault(key, set()).add(r[0])
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        keys = [x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)}) for x in lines]
        stay = [x for x, k in zip(lines, keys) if len(held.get(k, ())) < 3 or r[0] == max(held[k], key=lambda i: (i is not None, i or 0))]
        out.append((r[0], len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", [1, 7])
def test_line_dedup(spark, odd, odd_rows, empty, partitions):
    hot = [(1000 + i, f"this line is in all of the documents\nown line number {i} of the document\n\nend", "en", "s0", 1, "p", "s", 0)
           for i in range(300)]
    rows = odd_rows + hot
    docs = spark.createDataFrame(rows, DOCS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = line_dedup.line_dedup(docs).collect()
        texts = line_dedup.drop_lines(docs)
        assert texts.columns == docs.columns
        kept = sorted(((r["doc_id"], r["text"] or "") for r in texts.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute_lines(rows)
    assert sorted(((r[0], r["n_lines"], r["n_dropped"]) for r in got), key=repr) == sorted((w[:3] for w in want), key=repr)
    assert kept == sorted(((w[0], w[3]) for w in want), key=repr)
    assert line_dedup.line_dedup(empty).count() == 0


def test_sharding(spark, odd, odd_rows, empty):
    got = sharding.interleave(odd, 5).collect()
    assert len(got) == len(odd_rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    sizes = [len(by.get(s, ())) for s in range(5)]
    assert max(sizes) - min(sizes) <= 1
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted(
        (len((x[1] or "").encode()) + 8, zlib.crc32((x[1] or "").encode())) for x in odd_rows)
    assert sharding.interleave(empty, 5).count() == 0


def test_shards_hold_the_mixture(spark):
    rows = [(i, f"t{i}", None, "big" if i % 3 else f"s{i % 4}", 0, "", "", 0) for i in range(6000)]
    got = sharding.interleave(spark.createDataFrame(rows, DOCS), 8).groupBy("source", "shard").count().collect()
    for source in {r["source"] for r in got}:
        counts = [r["count"] for r in got if r["source"] == source]
        assert len(counts) == 8 and max(counts) - min(counts) <= 2


def test_small_sources_spread_over_all_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET", 20)
    monkeypatch.setattr(sharding, "STEP", 3)
    rows = [(i, f"text {i}", None, f"host {i}" if i < 400 else "large") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = sharding.interleave(docs, 8).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(k, j) for k in range(8) for j in range(100)]
    small = [sum(r["source"] != "large" and r["shard"] == k for r in got) for k in range(8)]
    assert sum(small) == 400 and min(small) >= 25 and max(small) <= 75


def test_warc(spark):
    big, tab = "<p>" + "x" * 200 + "\r\n\r\nWARC/1.0\r\n", "é\r\n"
    rows = [(3, "http://a\nb", big), (1, None, big), (2, "u", tab), (5, "u", tab), (4, "u", None), (6, "u", ""), (None, "u", big),
            (7, "u", "z" * 3_000_000), (1, None, big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    got = warc.archive(pages).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=repr) == sorted(
        ((i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(),
          "revisit" if h == big and i != 1 else "response", 1 if h == big and i != 1 else None) for i, _, h in rows), key=repr)
    assert all(r["payload"].decode() == next(h or "" for i, _, h in rows if i == r["page_id"])
               for r in got if r["record_type"] == "response")
    assert warc.archive(pages.limit(0)).count() == 0


def test_record_reader_takes_any_chunks():
    data = b"".join(b"WARC/1.0\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(x), x) for x in (b"", b"\r\n\r\n", b"abc" * 50))
    for step in (1, 7, 1000):
        reader = warc.RecordReader()
        made = [p for a in range(0, len(data), step) for p in reader.feed(data[a:a + step])]
        reader.close()
        assert b"".join(d for _, d in made) == data and sum(k == "end" for k, _ in made) == 3
    reader = warc.RecordReader()
    list(reader.feed(data[:-9]))
    with pytest.raises(ValueError):
        reader.close()


@needs_tables
def test_language_on_held_out_documents(spark):
    sf = SF.replace("0.001", "0.01")
    got = catalogue.QUERIES["op9_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    rows = got.filter("held_out").select("lang", "lang_pred", "score").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(spark, odd, odd_rows, empty):
    model = language.train(odd)
    got = language.identify(odd, model)
    assert got.columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score"]
    for r in got.collect():
        none = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == none and (r["score"] == 0) == none
    assert language.identify(odd, language.train(empty)).filter("lang_pred <> 'und'").count() == 0
    assert language.identify(empty, model).count() == 0


def test_resampling(spark, odd, odd_rows, empty):
    target = spark.createDataFrame([(4,), (None,)], "doc_id long")
    got = resampling.resample(odd, target, 0.5).collect()
    assert len(got) == len(odd_rows)
    keys = sorted((r["sample_key"] for r in got), reverse=True)
    cut = keys[round(len(keys) / 2) - 1]
    assert all(r["kept"] == (r["sample_key"] >= cut) for r in got)
    assert resampling.resample(empty, target, 0.5).count() == 0


def test_resampling_weights(spark):
    rows = [(i, words(i, 30, 50) if i % 2 else words(i, 30, 60).replace("w", "v"), None, None, 0, "", "", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    got = resampling.resample(docs, docs.filter("doc_id % 2 = 1").select("doc_id"), 0.5).collect()
    assert all(r["kept"] == (r["doc_id"] % 2 == 1) for r in got)


@pytest.mark.parametrize("k", [1, 17, 500, 1000])
def test_kth_largest(spark, k):
    values = [float(i % 300) for i in range(1000)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    assert resampling.kth_largest(frame, "x", k, bins=4, few=10) == sorted(values, reverse=True)[k - 1]


def test_edits_keep_counts(spark, odd, empty):
    encode = tokens.encoder(tokens.default_path())
    count = lambda w: len(encode.bpe.encode_ordinary(w))
    draw = random.Random(5)
    parts = [" word", "'", "re", "  ", "\n", "x", "1", "!", " don't", "é"]
    for _ in range(300):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(400)))
        tree = token_counts.CountTree(*next(token_counts.trees([text], encode))[2].tolist())
        for _ in range(6):
            a = draw.randrange(len(text) + 1)
            b = min(len(text), a + draw.randrange(30) * draw.randrange(9))
            text, _ = tree.edit(text, (a, b, "".join(draw.choice(parts) for _ in range(draw.randrange(4)))), count)
            assert tree.total == len(encode.bpe.encode_ordinary(text)) and tree.chars[1] == len(text)
    rows = token_counts.apply_edits(token_counts.with_trees(odd, edits=token_counts.redactions(odd.text))).collect()
    assert len(rows) == odd.count()
    assert all(r["n_tokens"] == len(encode.bpe.encode_ordinary(r["text"])) for r in rows)
    assert token_counts.apply_edits(token_counts.with_trees(empty)).count() == 0


def test_decontamination(spark, odd, odd_rows, empty):
    items = [(0, words(100, 40, 4000) + ". " + words(101, 6, 4000) + "."), (1, None), (2, ""), (3, "One. Two three four five six.")]
    held = [(50, "before " + items[0][1].upper().replace(" ", "\n") + " after " + words(7, 300), "en", "s", 0, "", "", 0),
            (51, words(100, 15, 4000), "en", "s", 0, "", "", 0)]
    docs = spark.createDataFrame(odd_rows + held, DOCS)
    found = decontamination.items_of(spark.createDataFrame(items, "item_id long, text string"))
    twice = found.unionByName(found.filter("item_id = 0").withColumn("item_id", F.lit(None).cast("long")))
    for part_bytes in (1 << 24, 150):
        got = decontamination.find_items(docs, twice, part_bytes=part_bytes).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == {(50, 0), (50, None)} and len(got) == 2
    clean = decontamination.decontaminate(docs, found)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 1
    assert decontamination.find_items(empty, found).count() == 0
    assert decontamination.find_items(docs, found.limit(0)).count() == 0


def test_block_maxima_leave_no_item_out():
    items = [(i, words(i, 30, 3000), words(500 + i, 5, 3000)) for i in range(60)]
    texts = [words(900 + i, 60, 3000) + " " + " ".join(items[i][1].split()[:5 * (i % 7)]) for i in range(60)]
    index = decontamination.Index(items)
    got = {(t, i) for t, i, *_ in index.search(texts, 0.4, 0.0)}
    every = decontamination.Index(items)
    every.maxima[:] = 1  # no block is left out
    assert got == {(t, i) for t, i, *_ in every.search(texts, 0.4, 0.0)} and got


def brute_bm25(items, texts, threshold, overlap, k1=1.2, b=0.75):
    """Scores of all items for all passages, term by term."""
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    docs = {i: split(q) + split(a) for i, q, a in items}
    docs = {i: d for i, d in docs.items() if d}
    width, mean = max(map(len, docs.values())), sum(map(len, docs.values())) / len(docs)
    df = Counter(t for d in docs.values() for t in set(d))

    def weight(t, d):
        tf = d.count(t)
        return math.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(d) / mean))

    def share(part, passage):
        n = min(decontamination.GRAM, len(part))
        runs = lambda w: {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if n else set()
        return len(runs(part) & runs(passage)) / len(runs(part)) if part else 1.0

    out = {}
    for k, text in enumerate(texts):
        w = split(text)
        for start in range(0, len(w), width):
            passage = w[start:start + 2 * width]
            for i, q, a in items:
                if i not in docs:
                    continue
                weights = {t: weight(t, docs[i]) for t in set(docs[i])}
                score = sum(v for t, v in weights.items() if t in passage) / sum(weights.values())
                values = (score, share(split(q), passage), share(split(a), passage))
                if score >= threshold and min(values[1:]) >= overlap:
                    out[k, i] = max(out.get((k, i), (0, 0, 0)), values)
    return out


def test_scores_by_hand_whatever_the_parts(spark, monkeypatch):
    items = [(i, words(i, 8 + i % 9, 300), words(500 + i, i % 5, 300)) for i in range(60)]
    texts = [words(900 + i, 200, 300) + " " + " ".join(items[i][1].split()[:i % 9]) + " " + items[i][2] + ", "
             + words(1900 + i, 30 * (i % 3), 300) for i in range(60)] + [None, "", words(3, 40)]
    want = brute_bm25(items, texts, 0.4, 0.3)
    assert len(want) > 15
    for stretch in (1 << 20, 700):
        monkeypatch.setattr(decontamination, "STRETCH", stretch)
        got = decontamination.Index(items).search(texts, 0.4, 0.3)
        assert {h[:2]: pytest.approx(h[2:]) for h in got} == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, question string, answer string")
    for part_bytes in (1 << 24, 700):
        got = decontamination.find_items(docs, table, 0.4, 0.3, part_bytes=part_bytes).collect()
        assert {(r[0], r[1]): pytest.approx(tuple(r[2:])) for r in got} == want and len(got) == len(want)


def test_packing_hardly_depends_on_the_splits(spark):
    rows = [(i, words(i, 20 + i * i % 700, 3000), "en", "s", 0, "", "", 0) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS)
    made = {}
    for splits in (1, 40):
        got = packing.pack(docs.repartition(splits)).collect()
        made[splits] = len({r["sequence_id"] for r in got})
        whole = packing.Bins(1024, len(got))
        for r in sorted(got, key=lambda r: -r["length"]):
            whole.place(r["length"])
        assert made[splits] <= math.ceil(1.005 * whole.opened)
    assert abs(made[1] - made[40]) <= 1 + 0.005 * made[1]


def brute_join(rows):
    sets = []
    for r in rows:
        w = (r[1] or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [[j for j, t in enumerate(sets) if j != i and s and len(s & t) / len(s | t) >= 0.8] for i, s in enumerate(sets)]
    label = list(range(len(rows)))
    for _ in rows:
        new = [min([label[i], *(label[j] for j in of)]) for i, of in enumerate(links)]
        if new == label:
            break
        label = new
    least = {}
    for x, r in zip(label, rows):
        least[x] = min((i for i in (least.get(x), r[0]) if i is not None), default=None)
    return sorted(((r[0], least[x], len(of)) for r, x, of in zip(rows, label, links)), key=repr)


def test_jaccard_leaf_of_many_parts(spark, monkeypatch):
    """In a leaf above the bound, sets that are unlike its least one still meet, whatever their parts."""
    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    monkeypatch.setattr(jaccard_join, "PART", 4, raising=False)
    draw = random.Random(3)
    sigs = [[draw.getrandbits(31) for _ in range(jaccard_join.TOKENS)] for _ in range(40)]
    rows = [(bytes([i, copy]), sig[:60] + [copy] * 4) for i, sig in enumerate(sigs) for copy in (0, 1)]
    reps = spark.createDataFrame(rows, "node binary, sig array<int>")
    found = reps.select(F.lit(1).cast("long").alias("path"), "node", F.lit(len(rows)).cast("long").alias("size"))
    got = {tuple(sorted((bytes(e.u), bytes(e.v)))) for e in jaccard_join.candidate_edges(found, reps, 0.8).collect()}
    assert got == {(bytes([i, 0]), bytes([i, 1])) for i in range(40)}


def test_jaccard_join(spark, odd_rows, empty, monkeypatch):
    """With a group of near copies and one of a shared passage that fill more than a bucket."""
    monkeypatch.setattr(jaccard_join, "SMALL", 16)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 32)
    base, passage = words(50, 120, 5000).split(), words(51, 60, 5000)
    near = []
    for i in range(120):
        draw, text = random.Random(i), list(base)
        for _ in range(draw.randrange(4)):
            text[draw.randrange(len(text))] = f"edit{i}"
        near.append((2000 + i, " ".join(text), "en", "s", 0, "", "", 0))
    shared = [(3000 + i, passage + " " + words(600 + i, 70, 5000), "en", "s", 0, "", "", 0) for i in range(60)]
    rows = odd_rows + near + shared
    docs = spark.createDataFrame(rows, DOCS)
    got = jaccard_join.jaccard_join(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_join(rows)
    kept = jaccard_join.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in brute_join(rows) if r[0] == r[1]} | {None}
    assert jaccard_join.jaccard_join(empty).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7), (200, 150)]
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 150: 150, 200: 150}


@needs_tables
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF)
        assert left.columns == docs.columns
        docs = corpus_pipeline.stored(left, "stage")
        now = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "language id":
            assert set(now) == {i for i, t in texts.items() if any(c.isalpha() for c in t or "")}
        if name == "line dedup":
            before = [(i, t) for i, t in texts.items()]
            assert sorted(now.items()) == sorted((r[0], r[3]) for r in brute_lines(before))
        if name == "n-gram Jaccard join":
            assert set(now) == {r[0] for r in brute_join(list(texts.items())) if r[0] == r[1]}
        assert set(now) <= set(texts)
        texts = now
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()} == set(texts)


def test_many_redactions_of_one_text(spark):
    text = " ".join(str(1000000 + i) for i in range(3000)) + " " + "w" * 2000 + " a@b.c+d@e.f\nlast"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = token_counts.apply_edits(token_counts.with_trees(docs, edits=token_counts.redactions(docs.text))).first()
    assert row["n_edits"] == 3003 and row["text"] == " ".join(["[REDACTED]"] * 3000) + " " + "w" * 2000 + " [REDACTED][REDACTED]"
    encode = tokens.encoder(tokens.default_path())
    assert row["n_tokens"] == len(encode.bpe.encode_ordinary(row["text"]))
    tree = token_counts.CountTree.load(row["tree"])
    assert max(tree.chars) == len(row["text"]) and max(tree.chars[tree.size:]) < 5000  # no leaf grows with the edits


@needs_tables
def test_language_stage_rejects_noise_and_keeps_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    draw = random.Random(2)
    noise = [(10_000_000 + 3 * i, "".join(draw.choice("bcdfghjklmnpqrstvwxz  ") for _ in range(draw.choice([80, 3000])))) for i in range(60)]
    mixed = docs.unionByName(spark.createDataFrame(noise, "doc_id long, text string"), allowMissingColumns=True)
    left = {r["doc_id"] for r in corpus_pipeline.language_id(spark, mixed, SF).collect()}
    assert left == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}


@needs_tables
def test_language_posteriors_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    langs, model = language.train(docs)
    texts = [r["text"] for r in docs.collect()] + ["zq" * 9, "é", ""]
    names, scores, fits = language.score(texts, langs, model)
    for text, name, value, fit in zip(texts, names, scores, fits):
        grams = language.features([text])[0].ravel()
        sums = [sum(row[g] for g in grams) + row[-1] for row in model]
        if name == "und":
            assert not any(c.isalpha() for c in text) and value == 0 and fit is None
            continue
        best = int(np.argmax(sums))
        assert name == langs[best] and value == pytest.approx(1 / sum(np.exp(s - sums[best]) for s in sums))
        known = [g for g in grams if g < 1 << language.BITS]
        assert fit == pytest.approx((sums[best] - model[best][-1]) / len(known) - sum(np.exp(m) * m for m in model[best][:1 << language.BITS]))
