import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.functions.similarity import soundex
from corvane.operators import joins, linkage, ordinals, vectors

L, R = linkage.LEFT, linkage.RIGHT


@pytest.fixture
def numbers(spark):
    """3,000 rows, a third of them under one key."""
    return spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot")
                                    .otherwise(F.col("id").cast("string")).alias("key"))


def test_shuffle_rank_is_a_permutation(numbers):
    ranks = [r["rank"] for r in ordinals.with_shuffle_rank(numbers, ["id"]).collect()]
    assert sorted(ranks) == list(range(1, 3001))
    per_key = ordinals.with_shuffle_rank(numbers.withColumn("hot", F.col("key") == "hot"), ["id"], within=["hot"])
    assert per_key.groupBy("hot").agg(F.max("rank"), F.count_distinct("rank")).filter(
        "hot").first()[1:] == (1000, 1000)


def test_key_rank_over_blocks(spark):
    ids = spark.range(5000).select((F.col("id") * 1237).alias("id"))
    rows = ordinals.with_key_rank(ids, "id", "n", 10, bits=6).orderBy("id").collect()
    assert [r["n"] for r in rows] == list(range(10, 5010))


def test_split_is_exact_and_a_partition(numbers):
    counts = {r["split"]: r["count"] for r in ordinals.split_three(numbers, ["id"]).groupBy("split").count().collect()}
    assert counts == {"train": 2100, "valid": 450, "test": 450}


def test_first_n_and_balanced_sample(numbers):
    assert ordinals.first_n(numbers, ["id"], 77).count() == 77
    labelled = numbers.withColumn("label", (F.col("key") == "hot").cast("int"))
    got = {r["label"]: r["count"] for r in ordinals.balanced_sample(labelled, ["id"], "label").groupBy("label").count().collect()}
    assert got == {0: 451, 1: 451}


def test_keep_first_under_a_hot_key(numbers):
    with_nulls = numbers.withColumn("key", F.when(F.col("id") % 7 != 0, F.col("key")))
    kept = linkage.keep_first(with_nulls, "key", "id")
    assert kept.filter("key = 'hot'").select("id").collect()[0][0] == 3
    assert kept.filter("key IS NULL").count() == with_nulls.filter("key IS NULL").count()
    by_chunk = linkage.keep_first_by_chunk(numbers, "key", "id", 1000)
    assert by_chunk.filter("key = 'hot'").count() == 334


def test_salted_lookup_is_whole(numbers, spark):
    small = numbers.select("key").distinct().withColumn("w", F.length("key"))
    assert joins.salted_lookup(numbers, small, ["key"], ["id"]).count() == 3000
    left = joins.salted_lookup(numbers, small.filter("key = 'hot'"), ["key"], ["id"], how="left", flag="found")
    assert (left.count(), left.filter("found").count()) == (3000, 1000)


RAW = "vin string, make_name string, model_name string, year string, price string, extra string, pos long"


def test_alignment(spark):
    rows = [("v1", "a", "b", "1", "2", "x", 0), ("v1", "a", "b", "1", None, "x", 1), (None, "a", " ", "1", "2", "x", 2),
            ("v2", " ", "", None, "2", "x", 3), (None, "a", "b", "1", "2", "x", 4)]
    aligned = linkage.aligned_rows(spark.createDataFrame(rows, RAW), linkage.LISTING_A, "pos")
    assert aligned.columns == ["vin", "manufacturer", "model", "year", "price", "_order"]
    got = linkage.listing(aligned, 100).orderBy("row_id").collect()
    assert [(r["vin"], r["row_id"]) for r in got] == [("v1", 100), (None, 102), (None, 103)]


def test_match_table_null_keys(spark):
    a = spark.createDataFrame([("v", 1), (None, 2)], "vin string, ia int")
    b = spark.createDataFrame([("v", 3), (None, 4)], "vin string, ib int")
    assert joins.equi_match(a, b, "vin", "ia", "ib").collect() == [(1, 3)]
    assert joins.missing_key_pairs(a, b.union(b), "vin").collect() == [(1, 2, 2)]


def pair(spark, **sides):
    cols, vals = zip(*[(f + s, v) for f, two in sides.items() for s, v in zip((L, R), two)])
    return spark.createDataFrame([vals], ", ".join(f"{c} string" for c in cols))


@pytest.mark.parametrize("manufacturer, model, year, sound, loose", [
    (("Ford", "ford "), ("Focus", "Focuss"), ("2015", "2016"), True, 2),
    (("Ram", "ram"), ("1500", "1500"), ("2015", "2015"), True, 4),
    ((None, None), (None, None), ("2015", "2015"), False, 1),
    ((None, None), (None, None), ("2015.0", "2015.0"), False, 0),
    (("Kia", "bmw"), ("rio", "x5"), ("2015", "2016"), False, 0),
])
def test_blocking(spark, manufacturer, model, year, sound, loose):
    p = pair(spark, manufacturer=manufacturer, model=model, year=year)
    assert linkage.route_by_sound(p).first()["blocked"] is sound
    assert len(linkage.route_by_any_key(p).first()["common_keys"]) == loose


def test_missing_text_as_nan(spark):
    p = pair(spark, manufacturer=(None, None), model=(None, None), year=("1", "2"))
    assert linkage.route_by_sound(p, nan_text=True).first()["blocked"] is True


def test_rule_match(spark):
    p = pair(spark, year=("2015", "2015"), body_type=("suv", "suv"), fuel_type=("gas", None),
             manufacturer=("ford", "ford"), model=("focus", "focsu"), color=("red", "blue"),
             description=("a car", "a car"), price=("1000", "2100"), mileage=("10", "20"))
    row = linkage.rule_match(linkage.compare(p)).first()
    assert (row["score"], row["predicted"]) == (1 + 1 + 0 + 1 + 1 + 0 + 1 + 0.5 + 1, 1)


# Stored confusion counts and the scores they give.
@pytest.mark.parametrize("tp, fp, fn, tn, p, r, f1", [
    (3241, 32, 1081, 4163, 0.9902, 0.7499, 0.8535), (4135, 69, 187, 4126, 0.9836, 0.9567, 0.9700),
    (3050, 8, 191, 24, 0.9974, 0.9411, 0.9684), (1929, 15, 0, 0, 0.9923, 1.0, 0.9961), (0, 0, 0, 5, 0, 0, 0),
])
def test_scores_of_stored_counts(spark, tp, fp, fn, tn, p, r, f1):
    row = linkage.with_prf(spark.createDataFrame([(tp, fp, fn, tn)], "tp int, fp int, fn int, tn int")).first()
    assert [round(row[c], 4) for c in ("precision", "recall", "f1")] == [p, r, f1]


def test_threshold_sweep_against_brute_force(spark):
    rng = np.random.default_rng(1)
    probs = [round(float(x), 2) for x in rng.random(400)] + [i / 20 for i in range(21)]
    rows = [(p, int(rng.random() < p)) for p in probs]
    sweep = linkage.threshold_sweep(spark.createDataFrame(rows, f"p double, {linkage.LABEL} int"), "p")
    got = {r["step"]: (r["tp"], r["fp"], r["fn"], r["tn"]) for r in sweep.collect()}
    for step in range(20):
        hit = [(p > step / 20, y) for p, y in rows]
        assert got[step] == tuple(sum(h is a and y == b for h, y in hit)
                                  for a, b in ((True, 1), (True, 0), (False, 1), (False, 0)))


def test_best_step_ignores_the_first_points(spark):
    rows = [("r", i, f1, i / 10) for i, f1 in enumerate([0.99, 0.1, 0.1, 0.1, 0.1, 0.5, 0.8, 0.8, 0.2])]
    series = spark.createDataFrame(rows + [("z", 0, 0.9, 0.9)], "run string, step int, f1 double, t_f1 double")
    got = {r["run"]: (r["best_step"], r["test_at_best"]) for r in
           linkage.best_step(series, "run", "step", "f1", "t_f1").collect()}
    assert got == {"r": (6, 0.6), "z": (None, 0.0)}


def test_true_labels(spark):
    pairs = spark.createDataFrame([("1.0", "2"), ("x", "2"), (None, "2"), ("1", "3")], "a string, b string")
    match = spark.createDataFrame([(1, 2)], "a int, b int")
    assert [r["true_label"] for r in joins.true_labels(pairs, match, "a", "b").orderBy("b", F.desc("true_label")).collect()] == [1, 0, 0, 0]


def test_learned_matcher_saved_and_reused(spark, tmp_path):
    rows = [(i, f"name{i}", f"name{i if i % 2 else i + 500}", float(i), float(i), i % 2) for i in range(60)]
    pairs = spark.createDataFrame(rows, f"id int, manufacturer{L} string, manufacturer{R} string, "
                                        f"price{L} double, price{R} double, {linkage.LABEL} int")
    features, names = linkage.learned_features(pairs)
    path = str(tmp_path / "model")
    model = linkage.fit_matcher(features, names)
    linkage.save_matcher(model, path)
    first = linkage.learned_match(model, features, names)
    again = linkage.learned_match(linkage.load_matcher(spark, path), features, names)
    show = lambda d: sorted((r["id"], round(r["match_probability"], 9)) for r in d.collect())
    assert show(first) == show(again)
    assert first.filter("match_confidence < 0.5").count() == 0
    # at the minimum of the penalised loss the gradient is zero
    w = np.array(model.first()["weights"])
    rows = features.select(*names, linkage.LABEL).collect()
    x = np.array([[1.0, *r[:-1]] for r in rows])
    p = 1 / (1 + np.exp(-x @ w))
    gradient = x.T @ (p - np.array([r[-1] for r in rows])) / len(rows) + 0.01 * np.append(0, w[1:])
    assert np.abs(gradient).max() < 1e-9
    with pytest.raises(ValueError):
        linkage.fit_matcher(features.limit(0), names)


@pytest.mark.parametrize("how", [{"k": 7}, {"threshold": 0.35}, {"k": 7, "query_bytes": None},
                                 {"threshold": 0.35, "query_bytes": None}])
def test_vector_join_against_brute_force(spark, how):
    rng = np.random.default_rng(3)
    mats = [rng.normal(size=(n, 6)) + 0.5 for n in (400, 150)]
    mats[0][5] = 0.0
    mats[0][7:40] = mats[0][6]  # ties
    frames = [spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"{c} long, v array<double>")
              for m, c in zip(mats, "ab")]
    got = vectors.similarity_join(frames[0], frames[1], "a", "b", "v", block_rows=60, **how)
    unit = [m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300) for m in mats]
    sims = np.round(unit[1] @ unit[0].T, 6)
    sims[:, 5] = -2
    want = set()
    for b, row in enumerate(sims):
        order = np.argsort(-row, kind="stable")
        chosen = order[:how["k"]] if "k" in how else np.flatnonzero(row >= how["threshold"])
        want |= {(int(a), b) for a in chosen}
    assert {(r["left_id"], r["right_id"]) for r in got.collect()} == want


@pytest.mark.parametrize("held", [vectors.HELD_HITS, 100])
def test_a_task_keeps_k_hits_per_query(spark, monkeypatch, held):
    monkeypatch.setattr(vectors, "HELD_HITS", held)
    rng = np.random.default_rng(4)
    m = np.round(rng.normal(size=(300, 3)))  # many ties
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "a long, v array<double>").coalesce(1)
    got = vectors.similarity_join(frame, frame.withColumnRenamed("a", "b"), "a", "b", "v", k=4, block_rows=30)
    some = np.linalg.norm(m, axis=1) > 0
    unit = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    sims = np.where(some, np.round(unit @ unit.T, 6), -2)
    assert {(r["left_id"], r["right_id"]) for r in got.collect()} == {
        (int(a), b) for b in np.flatnonzero(some) for a in np.argsort(-sims[b], kind="stable")[:4]}


def test_too_many_queries_to_broadcast(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0])], "a long, v array<double>")
    with pytest.raises(Exception, match="bytes to broadcast"):
        vectors.similarity_join(frame, frame.withColumnRenamed("a", "b"), "a", "b", "v", k=1, query_bytes=5).collect()
    none = frame.filter("a > 1").withColumnRenamed("a", "b")
    assert vectors.similarity_join(frame, none, "a", "b", "v", k=1).collect() == []


def test_first_n_is_the_head_of_the_shuffle(numbers):
    ranked = ordinals.with_shuffle_rank(numbers, ["id"])
    assert sorted(ordinals.first_n(numbers, ["id"], 20).collect()) == sorted(
        ranked.filter("rank <= 20").drop("rank").collect())


def test_unit(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0])], "a array<double>, b array<double>").select(
        vectors.unit(F.col("a")), vectors.unit(F.col("b"))).first()
    assert row[0] == pytest.approx([0.6, 0.8]) and row[1] == [0.0]


def test_soundex_of_null(spark):
    assert spark.range(1).select(soundex(F.lit(None).cast("string"))).first()[0] is None
