"""Record linkage queries over ``part`` and its perturbed copy, and over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import cleaning, similarity
from corvane.operators import joins, linkage, ordinals, vectors
from corvane.plans import sqltext as sql
from corvane.plans.tables import spread_table, table
from corvane.session import materialise, private_folder

LEFT, RIGHT, LABEL = linkage.LEFT, linkage.RIGHT, linkage.LABEL


def raw_a(spark, sf_dir):
    """Parts as the first listing; some VINs missing, some shared, some colours blank."""
    k = F.col("p_partkey")
    return spread_table(spark, sf_dir, "part", "p_partkey").select(
        k,
        F.when(k % 19 == 0, None).when(k % 23 == 0, F.md5(F.lit("hot")))
        .otherwise(F.md5(k.cast("string"))).alias("vin"),
        F.col("p_brand").alias("make_name"), F.col("p_name").alias("model_name"),
        (F.lit(1990) + F.col("p_size") % 35).alias("year"),
        F.col("p_retailprice").alias("price"), (k % 1000 * 100).alias("mileage"),
        F.col("p_type").alias("body_type"),
        F.when(k % 5 == 0, "  ").otherwise(F.col("p_brand")).alias("exterior_color"),
        F.when(k % 10 == 0, "").otherwise(F.concat_ws(" ", "p_brand", "p_name", "p_type"))
        .alias("description"),
        F.when(k % 4 != 0, F.col("p_type")).alias("fuel_type"),
        F.when(k % 20 != 0, "used").alias("is_new"), F.lit("x").alias("unmapped"))


def raw_b(spark, sf_dir):
    """The perturbed copy: a character dropped from the name, price moved, brand missing."""
    k = F.col("p_partkey")
    typo = F.concat(F.expr("substring(p_name, 1, cast(p_partkey % length(p_name) as int))"),
                    F.expr("substring(p_name, cast(p_partkey % length(p_name) as int) + 2)"))
    return spread_table(spark, sf_dir, "part", "p_partkey").select(
        k,
        F.when(k % 13 == 0, None).when(k % 29 == 0, F.md5(F.lit("hot")))
        .otherwise(F.md5(k.cast("string"))).alias("VIN"),
        F.when(k % 11 != 0, F.col("p_brand")).alias("manufacturer"),
        F.when(k % 3 == 0, typo).otherwise(F.col("p_name")).alias("model"),
        (F.lit(1990) + F.col("p_size") % 35).alias("year"),
        (F.col("p_retailprice") + k % 7 * 50).alias("price"),
        (k % 1000 * 100 + k % 3 * 4000).alias("odometer"),
        F.col("p_type").alias("type"), F.col("p_brand").alias("paint_color"),
        F.concat_ws(" ", "p_name", "p_type").alias("description"),
        F.when(k % 6 != 0, F.col("p_type")).alias("fuel"),
        F.lit("used").alias("condition"))


def _rows(spark, sf_dir):
    return (linkage.aligned_rows(raw_a(spark, sf_dir), linkage.LISTING_A, "p_partkey"),
            linkage.aligned_rows(raw_b(spark, sf_dir), linkage.LISTING_B, "p_partkey"))


def _listings(spark, sf_dir):
    return tuple(materialise(x) for x in linkage.two_listings(*_rows(spark, sf_dir)))


_CARD = ("vin", "manufacturer", "model", "year", "price", "mileage", "body_type", "fuel_type",
         "color", "description", "condition")


def _flat(df, *columns):
    return df.select(*[F.col(c).cast("bigint").alias(c) if t == "int" else F.col(c)
                       for c, t in df.dtypes if not columns or c in columns])


def align_schema(spark, sf_dir):
    return _flat(linkage.align(raw_a(spark, sf_dir), linkage.LISTING_A, keep=("p_partkey",)))


def null_threshold(spark, sf_dir):
    return _flat(_rows(spark, sf_dir)[0])


def row_id_assign(spark, sf_dir):
    a, b = _rows(spark, sf_dir)
    second = ordinals.with_key_rank(b, "_order", "row_id", a.agg(F.count(F.lit(1))).scalar())
    first = ordinals.with_key_rank(a, "_order", "row_id", 0)
    return (first.select("_order", "row_id", F.lit("a").alias("side"))
            .unionByName(second.select("_order", "row_id", F.lit("b").alias("side"))))


def keep_first_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("key", F.md5("text"))
    return linkage.keep_first(docs.select("doc_id", "key", "source"), "key", "doc_id")


def keep_first_by_chunk(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("key", F.md5("text"))
    numbered = ordinals.with_key_rank(docs.select("doc_id", "key"), "doc_id", "ordinal", 0)
    return linkage.keep_first_by_chunk(numbered, "key", "ordinal", 100).select("doc_id", "key")


def listings(spark, sf_dir):
    a, b = _listings(spark, sf_dir)
    return (_flat(a).withColumn("side", F.lit("a")).unionByName(_flat(b).withColumn("side", F.lit("b"))))


def column_drop(spark, sf_dir):
    return _flat(_listings(spark, sf_dir)[1].drop("description", "condition"))


def match_table(spark, sf_dir):
    return _matches(*_listings(spark, sf_dir))


def _matches(a, b):
    return joins.equi_match(a.withColumnRenamed("row_id", "row_id" + LEFT),
                            b.withColumnRenamed("row_id", "row_id" + RIGHT),
                            "vin", "row_id" + LEFT, "row_id" + RIGHT)


def positive_pairs(spark, sf_dir):
    return _flat(linkage.positive_pairs(*_listings(spark, sf_dir)))


def negative_pairs(spark, sf_dir):
    a, b = _listings(spark, sf_dir)
    return _flat(linkage.negative_pairs(a, b, _matches(a, b).agg(F.count(F.lit(1))).scalar()))


def _pairs(spark, sf_dir):
    a, b = _listings(spark, sf_dir)
    count = _matches(a, b).agg(F.count(F.lit(1))).scalar()
    return materialise(linkage.labelled_pairs(a, b, count))


def label_counts(spark, sf_dir):
    return (_pairs(spark, sf_dir).groupBy(F.col(LABEL).cast("long").alias("label"))
            .agg(F.count(F.lit(1)).alias("n")))


def clean_pairs(spark, sf_dir):
    text = _pairs(spark, sf_dir).select(
        *[F.when(F.col("row_id" + s) % 7 != 0, F.concat(F.col("row_id" + s).cast("string"), F.lit(".0")))
          .alias("row_id" + s) for s in (LEFT, RIGHT)], LABEL)
    return _flat(linkage.clean_ids(text))


def split_70_15_15(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return ordinals.split_three(docs, ["doc_id"])


def split_counts(spark, sf_dir):
    pairs = _pairs(spark, sf_dir).select("row_id" + LEFT, "row_id" + RIGHT)
    split = ordinals.split_three(pairs, ["row_id" + LEFT, "row_id" + RIGHT])
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def sample_fraction(spark, sf_dir):
    return ordinals.sample_chunks(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.05)


def shuffle_hash(spark, sf_dir):
    return ordinals.shuffle_rows(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"])


def cap_rows(spark, sf_dir):
    return ordinals.first_n(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 500)


def balanced_sample(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("long").alias("toxic"))
    return ordinals.balanced_sample(labels, ["doc_id"], "toxic")


def page_window(spark, sf_dir):
    return ordinals.page_of_rows(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 100, 50)


def block_keys(spark, sf_dir):
    a, b = _listings(spark, sf_dir)
    both = a.unionByName(b)
    return both.select(
        "row_id", linkage.sound_key(F.col("manufacturer"), F.col("model")).alias("sound_key"),
        F.array_join(F.array_sort(linkage.loose_keys(
            F.col("manufacturer"), F.col("model"), F.col("year"))), ",").alias("loose_keys"))


def soundex_codes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    words = F.split("text", "[ \t\n]+")
    return docs.select("doc_id", F.array_join(F.transform(words, similarity.soundex), " ").alias("code"),
                       similarity.soundex(F.col("source")).alias("source_code"))


_IDS = ("row_id" + LEFT, "row_id" + RIGHT)


def block_b1(spark, sf_dir):
    return linkage.route_by_sound(_pairs(spark, sf_dir)).select(*_IDS, "blocked", "block_key")


def block_b2(spark, sf_dir):
    return linkage.route_by_any_key(_pairs(spark, sf_dir)).select(
        *_IDS, "blocked", F.size("common_keys").cast("long").alias("n_common"))


def _rounded(df, *names):
    return df.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


def block_eval(spark, sf_dir):
    pairs, actual = _pairs(spark, sf_dir), F.col(LABEL) == 1
    done = [linkage.confusion(route(pairs), F.col("blocked"), actual).withColumn("blocking", F.lit(n))
            for n, route in (("sound", linkage.route_by_sound), ("any", linkage.route_by_any_key))]
    return _rounded(done[0].unionByName(done[1]), "precision", "recall", "f1")


def block_sizes(spark, sf_dir):
    return linkage.block_sizes(*_listings(spark, sf_dir))


def _compared(spark, sf_dir):
    return linkage.compare(_pairs(spark, sf_dir))


_SIMS = ("sim_year", "sim_body_type", "sim_fuel_type", "sim_manufacturer", "sim_model", "sim_color",
         "sim_description", "sim_price", "sim_mileage", "score")


def pair_features(spark, sf_dir):
    return _rounded(_compared(spark, sf_dir).select(*_IDS, *_SIMS), *_SIMS)


def jaro_winkler_names(spark, sf_dir):
    pairs = _pairs(spark, sf_dir).select(*_IDS, "model" + LEFT, "model" + RIGHT)
    sim = similarity.jaro_winkler(F.col("model" + LEFT), F.col("model" + RIGHT))
    return pairs.select(*_IDS, F.round(sim, 6).alias("similarity"))


def pair_rule_match(spark, sf_dir):
    return linkage.rule_match(_compared(spark, sf_dir)).select(
        *_IDS, F.col("predicted").cast("long").alias("predicted"))


def pair_rule_eval(spark, sf_dir):
    blocked = linkage.route_by_any_key(_pairs(spark, sf_dir)).filter("blocked")
    matched = linkage.rule_match(linkage.compare(blocked))
    result = linkage.confusion(matched, F.col("predicted") == 1, F.col(LABEL) == 1)
    return _rounded(result, "precision", "recall", "f1")


def _scored(spark, sf_dir):
    scored = _compared(spark, sf_dir).withColumn("p", F.round(F.col("score") / 9, 6))
    return materialise(scored.select(*_IDS, LABEL, "p"))


def threshold_curve(spark, sf_dir):
    sweep = linkage.threshold_sweep(_scored(spark, sf_dir), "p")
    return _rounded(sweep.drop("step"), "precision", "recall", "f1")


def threshold_best(spark, sf_dir):
    best = linkage.best_threshold(linkage.threshold_sweep(_scored(spark, sf_dir), "p"))
    return _rounded(best, "f1")


def threshold_verified(spark, sf_dir):
    """The threshold is chosen on the valid split and verified on the test split."""
    split = ordinals.split_three(_scored(spark, sf_dir), list(_IDS))
    best = linkage.best_threshold(linkage.threshold_sweep(split.filter("split = 'valid'"), "p"))
    cut = best.select("threshold").scalar()
    return _rounded(linkage.confusion(split.filter("split = 'test'"), F.col("p") > cut, F.col(LABEL) == 1),
                    "precision", "recall", "f1")


def _series(spark, sf_dir):
    """Daily event metrics per event type as training curves."""
    day = F.date_diff(F.col("ts"), F.lit("2024-01-01"))
    return (table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("run"), day.alias("step"))
            .agg(F.round(F.avg("value") / 100, 4).alias("f1"),
                 F.round(F.max("value") / 1000, 4).alias("t_f1")))


def best_epoch(spark, sf_dir):
    best = linkage.best_step(_series(spark, sf_dir), "run", "step", "f1", "t_f1")
    return best.withColumn("best_step", F.col("best_step").cast("long"))


def best_checkpoint(spark, sf_dir):
    return _flat(linkage.best_so_far(_series(spark, sf_dir), "run", "step", "f1", "t_f1"))


def _learned(spark, sf_dir, kept=lambda pairs: pairs):
    return linkage.learned_features(kept(_pairs(spark, sf_dir).select(
        *_IDS, LABEL, *[f + s for s in (LEFT, RIGHT) for f in (
            "manufacturer", "model", "year", "price", "fuel_type", "color", "body_type")])))


def _written(df, name):
    """``df`` as a table in the shared folder: the fit reads it once for each step."""
    path = private_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fitted(spark, sf_dir):
    """Features with their split, their names, and weights fitted on a balanced sample of the train split."""
    features, names = _learned(spark, sf_dir, lambda pairs: _written(pairs, "pairs"))
    split = _written(ordinals.split_three(features, list(_IDS)), "features")
    sample = _written(ordinals.balanced_sample(split.filter("split = 'train'"), list(_IDS), LABEL), "sample")
    return split, names, linkage.fit_matcher(sample, names)


def pair_lr_match(spark, sf_dir):
    """Every pair is scored and carries its split."""
    split, names, model = _fitted(spark, sf_dir)
    scored = linkage.learned_match(model, split, names)
    return _rounded(scored.select(*_IDS, LABEL, "split", "match_probability", F.col("predicted").cast("long").alias("predicted"),
                                  "match_confidence"), "match_probability", "match_confidence")


def pair_lr_eval(spark, sf_dir):
    split, names, model = _fitted(spark, sf_dir)
    judged = linkage.learned_match(model, split.filter("split = 'test'"), names)
    return _rounded(linkage.confusion(judged, F.col("predicted") == 1, F.col(LABEL) == 1), "precision", "recall", "f1")


def pair_lr_saved(spark, sf_dir):
    """A matcher that was fitted on the train split and saved scores the test split after it is loaded again."""
    split, names, model = _fitted(spark, sf_dir)
    path = private_folder(spark, "matcher")
    linkage.save_matcher(model, path)
    scored = linkage.learned_match(linkage.load_matcher(spark, path), split.filter("split = 'test'"), names)
    return _rounded(scored.select(*_IDS, "match_probability", F.col("predicted").cast("long").alias("predicted")), "match_probability")


def pair_verdicts(spark, sf_dir):
    """Inputs joined with predictions that were made apart, by the pair's place."""
    pairs = ordinals.with_shuffle_rank(_pairs(spark, sf_dir).select(*_IDS, "model" + LEFT, "model" + RIGHT, LABEL), list(_IDS), "place")
    said = ordinals.with_shuffle_rank(linkage.weighted_match(_learned(spark, sf_dir)[0], WEIGHTS, INTERCEPT), list(_IDS), "place")
    joined = joins.zip_rows(pairs, said.select("place", F.col("predicted").cast("long").alias("predicted")), "place")
    return joined.withColumn(LABEL, F.col(LABEL).cast("long"))


# Weights of the matcher that is not fitted.
WEIGHTS = {"dist_manufacturer": -3.0, "dist_model": -9.0, "dist_year": -2.5, "dist_price": -1.5,
           "miss_manufacturer": -0.5, "miss_model": -1.0}
INTERCEPT = 4.0


def pair_weighted_match(spark, sf_dir):
    scored = linkage.weighted_match(_learned(spark, sf_dir)[0], WEIGHTS, INTERCEPT)
    return _rounded(scored.select(*_IDS, "match_probability", F.col("predicted").cast("long").alias("predicted"),
                                  "match_confidence"), "match_probability", "match_confidence")


def learned_distances(spark, sf_dir):
    features, names = linkage.learned_features(_pairs(spark, sf_dir))
    return _rounded(features.select(*_IDS, *names), *names)


def truth_lookup(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    left, right = _IDS
    matches = pairs.filter(F.col(LABEL) == 1).select(left, right)
    text = pairs.select(*[
        F.when(F.col(c) % 9 == 0, "?").otherwise(F.concat(F.col(c).cast("string"), F.lit(".0"))).alias(c)
        for c in _IDS])
    return _flat(joins.true_labels(text, matches, *_IDS))


def unit_normalise(spark, sf_dir):
    doubled = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 2)).alias("v"))
    unit = doubled.select("vec_id", vectors.unit(F.col("v")).alias("u"))
    return unit.select("vec_id", F.round(F.get("u", F.lit(0)), 6).alias("first"),
                       F.round(F.get("u", F.lit(63)), 6).alias("last"))


def _centres(spark, sf_dir):
    """One query vector per label: the mean of its vectors."""
    e = table(spark, sf_dir, "embeddings")
    mean = F.array(*[F.avg(F.get("embedding", F.lit(i)).cast("double")) for i in range(64)])
    return e.groupBy("label").agg(mean.alias("embedding"))


def vector_topk(spark, sf_dir):
    return vectors.similarity_join(table(spark, sf_dir, "embeddings"), _centres(spark, sf_dir), "vec_id", "label",
                                   "embedding", k=10)


def vector_threshold(spark, sf_dir):
    return vectors.similarity_join(table(spark, sf_dir, "embeddings"), _centres(spark, sf_dir), "vec_id", "label",
                                   "embedding", threshold=0.2)


def _near_rows(spark, sf_dir, **how):
    """Every row whose id is divisible by 50 as a query against all rows; any number of queries."""
    e = table(spark, sf_dir, "embeddings")
    return vectors.similarity_join(e, e.filter(F.col("vec_id") % 50 == 0), "vec_id", "vec_id", "embedding",
                                   query_bytes=None, **how)


def vector_row_topk(spark, sf_dir):
    return _near_rows(spark, sf_dir, k=10)


def vector_row_threshold(spark, sf_dir):
    return _near_rows(spark, sf_dir, threshold=0.6)


def text_normalise(spark, sf_dir):
    b = raw_b(spark, sf_dir)
    price = F.concat(F.lit("$ "), F.format_number("price", 2), F.lit(" USD"))
    messy = F.when(F.col("p_partkey") % 8 == 0, "n/a").otherwise(price)
    return b.select("p_partkey", cleaning.normalise_text(F.concat(F.lit("  "), "manufacturer", F.lit("\t")))
                    .alias("brand"), cleaning.normalise_price(messy).alias("price"))


QUERIES = {f.__name__: f for f in (
    align_schema, null_threshold, row_id_assign, keep_first_dedup, keep_first_by_chunk, listings,
    column_drop, match_table, positive_pairs, negative_pairs, label_counts, clean_pairs,
    split_70_15_15, split_counts, sample_fraction, shuffle_hash, cap_rows, balanced_sample,
    page_window, block_keys, soundex_codes, block_b1, block_b2, block_eval, block_sizes,
    pair_features, jaro_winkler_names, pair_rule_match, pair_rule_eval, threshold_curve,
    threshold_best, threshold_verified, best_epoch, best_checkpoint, pair_lr_match, pair_lr_eval,
    pair_lr_saved, pair_verdicts, pair_weighted_match,
    learned_distances, truth_lookup, unit_normalise, vector_topk, vector_threshold,
    vector_row_topk, vector_row_threshold, text_normalise)}


# --- oracles ---------------------------------------------------------------------------------
_RAW = """
pa AS (SELECT p_partkey AS k, * FROM part),
ra AS (SELECT k, CASE WHEN k % 19 = 0 THEN NULL WHEN k % 23 = 0 THEN md5('hot')
                      ELSE md5(CAST(k AS VARCHAR)) END AS vin,
       p_brand AS manufacturer, p_name AS model, CAST(1990 + p_size % 35 AS BIGINT) AS year,
       p_retailprice AS price, k % 1000 * 100 AS mileage, p_type AS body_type,
       CASE WHEN k % 5 = 0 THEN '  ' ELSE p_brand END AS color,
       CASE WHEN k % 10 = 0 THEN '' ELSE p_brand || ' ' || p_name || ' ' || p_type END AS description,
       CASE WHEN k % 4 <> 0 THEN p_type END AS fuel_type,
       CASE WHEN k % 20 <> 0 THEN 'used' END AS condition FROM pa),
rb AS (SELECT k, CASE WHEN k % 13 = 0 THEN NULL WHEN k % 29 = 0 THEN md5('hot')
                      ELSE md5(CAST(k AS VARCHAR)) END AS vin,
       CASE WHEN k % 11 <> 0 THEN p_brand END AS manufacturer,
       CASE WHEN k % 3 = 0 THEN left(p_name, CAST(k % length(p_name) AS INT))
                 || substr(p_name, CAST(k % length(p_name) AS INT) + 2) ELSE p_name END AS model,
       CAST(1990 + p_size % 35 AS BIGINT) AS year, p_retailprice + k % 7 * 50 AS price,
       k % 1000 * 100 + k % 3 * 4000 AS mileage, p_type AS body_type, p_brand AS color,
       p_name || ' ' || p_type AS description, CASE WHEN k % 6 <> 0 THEN p_type END AS fuel_type,
       'used' AS condition FROM pa)"""


def _blank(c):
    return f"CASE WHEN trim({c}) <> '' THEN {c} END"


def _kept(name, raw):
    cols = ", ".join(f"{_blank(c)} AS {c}" if c not in ("year", "price", "mileage") else c for c in _CARD)
    need = " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in _CARD)
    return f"{name} AS (SELECT * FROM (SELECT k AS _order, {cols} FROM {raw}) x WHERE {need} >= 7)"


def _first(name, kept, start):
    return f"""{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, CASE WHEN vin IS NULL THEN 1 ELSE
        row_number() OVER (PARTITION BY vin ORDER BY row_id) END AS rn FROM (SELECT * EXCLUDE (_order),
        row_number() OVER (ORDER BY _order) - 1 + {start} AS row_id FROM {kept}) y) z WHERE rn = 1)"""


_KEPT = f"WITH {_RAW}, {_kept('ka', 'ra')}, {_kept('kb', 'rb')}"
_LIST = f"""{_KEPT}, {_first('la', 'ka', '0')}, {_first('lb', 'kb', '(SELECT count(*) FROM ka)')}"""
_ROW = _CARD + ("row_id",)


def _side(alias, suffix):
    return ", ".join(f"{alias}.{c} AS {c}{suffix}" for c in _ROW)


_BOTH = f"{_side('a', LEFT)}, {_side('b', RIGHT)}"
_PAIRS = f"""{_LIST},
mt AS (SELECT a.row_id AS row_id{LEFT}, b.row_id AS row_id{RIGHT} FROM la a JOIN lb b USING (vin)),
pos AS (SELECT {_BOTH}, CAST(1 AS BIGINT) AS {LABEL} FROM la a JOIN lb b ON a.vin = b.vin),
ha AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || row_id), row_id) AS rk FROM la),
hb AS (SELECT *, row_number() OVER (ORDER BY md5('43|' || row_id), row_id) AS rk FROM lb),
neg AS (SELECT {_BOTH}, CAST(0 AS BIGINT) AS {LABEL} FROM ha a JOIN hb b USING (rk)
        WHERE rk <= (SELECT count(*) FROM mt) AND NOT coalesce(a.vin = b.vin, false)),
pairs AS (SELECT * FROM pos UNION ALL SELECT * FROM neg)"""


def _soundex(expr):
    up = f"upper(replace({expr}, 'ß', 'ss'))"  # the full upper case of ß; upper() here maps single characters only
    joined = f"left({up}, 1) || regexp_replace(substr({up}, 2), '[HW]', '', 'g')"
    codes = (f"translate(regexp_replace({joined}, '[^A-Z]', '0', 'g'), '{similarity.SOUNDEX_LETTERS}', "
             f"'{similarity.SOUNDEX_DIGITS}')")
    codes = f"regexp_replace({codes}, '[^1-6]', '0', 'g')"
    for d in "123456":
        codes = f"regexp_replace({codes}, '{d}+', '{d}', 'g')"
    return (f"CASE WHEN {expr} <> '' THEN left({up}, 1) || "
            f"rpad(left(replace(substr({codes}, 2), '0', ''), 3), 3, '0') END")


def _part(c):
    return f"nullif(lower(trim({c})), '')"


def _sound(s):
    return (f"md5(({_soundex(_part('manufacturer' + s))}) || '_' || "
            f"({_soundex(_part('model' + s))}))")


def _loose(s):
    brand, model = _part("manufacturer" + s), _part("model" + s)
    return f"""list_distinct(list_transform(list_filter([
        ({_soundex(brand)}) || '_' || ({_soundex(model)}), {brand} || '_' || left({model}, 1), {model},
        'year_' || CAST(year{s} AS VARCHAR)], lambda x: x IS NOT NULL), lambda x: md5(x)))"""


def _prf(tp="tp", fp="fp", fn="fn"):
    p, r = f"{tp}/({tp}+{fp})::DOUBLE", f"{tp}/({tp}+{fn})::DOUBLE"
    pz = f"CASE WHEN {tp}+{fp} > 0 THEN {p} ELSE 0.0 END"
    rz = f"CASE WHEN {tp}+{fn} > 0 THEN {r} ELSE 0.0 END"
    return (f"round({pz}, 6) AS precision, round({rz}, 6) AS recall, "
            f"CASE WHEN {tp} > 0 THEN round(2*({p})*({r})/(({p})+({r})), 6) ELSE 0.0 END AS f1")


def _confusion(source, predicted, extra=""):
    act = f"{LABEL} = 1"
    return f"""SELECT {extra} tp, fp, fn, tn, {_prf()} FROM (SELECT
      CAST(count(*) FILTER (({predicted}) AND {act}) AS BIGINT) AS tp,
      CAST(count(*) FILTER (({predicted}) AND NOT {act}) AS BIGINT) AS fp,
      CAST(count(*) FILTER (NOT ({predicted}) AND {act}) AS BIGINT) AS fn,
      CAST(count(*) FILTER (NOT ({predicted}) AND NOT {act}) AS BIGINT) AS tn FROM {source}) c"""


_B1 = f"coalesce({_sound(LEFT)} = {_sound(RIGHT)}, false)"
_COMMON = f"len(list_intersect({_loose(LEFT)}, {_loose(RIGHT)}))"


def _jw(f):
    return (f"CASE WHEN jaro_winkler_similarity({f}{LEFT}, {f}{RIGHT}) >= 0.6 THEN 1.0 ELSE 0.0 END "
            f"AS sim_{f}")


def _gauss(f, offset, scale):
    d = f"abs({f}{LEFT} - {f}{RIGHT})"
    return (f"coalesce(CASE WHEN {d} <= {offset} THEN 1.0 ELSE pow(2.0::DOUBLE, -pow(({d} - {offset}) "
            f"/ {scale}::DOUBLE, 2)) END, 0.0) AS sim_{f}")


_COMPARE = f"""SELECT *, sim_year + sim_body_type + sim_fuel_type + sim_manufacturer + sim_model
  + sim_color + sim_description + sim_price + sim_mileage AS score FROM (SELECT *,
  CASE WHEN year{LEFT} = year{RIGHT} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS sim_year,
  {', '.join(_jw(f) for f in linkage.STRING_FIELDS)},
  {_gauss('price', 100, 1000)}, {_gauss('mileage', 500, 5000)} FROM pairs) f"""
_CMP = f"{_PAIRS}, cmp AS ({_COMPARE})"
_SCORED = f"{_CMP}, sc AS (SELECT *, round(score / 9, 6) AS p FROM cmp)"
_SWEEP = f"""{_SCORED}, th AS (SELECT unnest(range(20)) / 20.0::DOUBLE AS threshold),
sw AS (SELECT threshold, tp, fp, fn, tn, {_prf()} FROM (SELECT threshold,
      CAST(count(*) FILTER (p > threshold AND {LABEL} = 1) AS BIGINT) AS tp,
      CAST(count(*) FILTER (p > threshold AND {LABEL} = 0) AS BIGINT) AS fp,
      CAST(count(*) FILTER (p <= threshold AND {LABEL} = 1) AS BIGINT) AS fn,
      CAST(count(*) FILTER (p <= threshold AND {LABEL} = 0) AS BIGINT) AS tn
      FROM sc CROSS JOIN th GROUP BY threshold) c)"""
_SPLIT = f"""{_SCORED}, nb AS (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY
    md5('42|' || {_IDS[0]} || '|' || {_IDS[1]}), {_IDS[0]}, {_IDS[1]}) AS rn FROM sc),
sp AS (SELECT *, CASE WHEN rn <= floor(0.7 * n) THEN 'train' WHEN rn <= floor(0.7 * n) + floor(0.15 * n) THEN 'valid'
       ELSE 'test' END AS split FROM nb),
th AS (SELECT unnest(range(20)) / 20.0::DOUBLE AS threshold),
va AS (SELECT threshold, tp, fp, fn, {_prf()} FROM (SELECT threshold, count(*) FILTER (p > threshold AND {LABEL} = 1) AS tp,
       count(*) FILTER (p > threshold AND {LABEL} = 0) AS fp, count(*) FILTER (p <= threshold AND {LABEL} = 1) AS fn
       FROM sp CROSS JOIN th WHERE split = 'valid' GROUP BY threshold) c),
te AS (SELECT * FROM sp WHERE split = 'test')"""
_SERIES = """WITH s AS (SELECT event_type AS run, date_diff('day', DATE '2024-01-01', ts::DATE) AS step,
  round(avg(value) / 100, 4) AS f1, round(max(value) / 1000, 4) AS t_f1 FROM events GROUP BY ALL)"""


def _dist(f):
    a, b = _part(f"CAST({f}{LEFT} AS VARCHAR)"), _part(f"CAST({f}{RIGHT} AS VARCHAR)")
    return f"1 - jaro_winkler_similarity({a}, {b})"


_DISTANCES = {f: _dist(f) for f in linkage.LEARNED_STRINGS + linkage.LEARNED_SHORT}
_DISTANCES["year"] = f"CAST(year{LEFT} <> year{RIGHT} AS DOUBLE)"
_DISTANCES["price"] = f"abs(log10(price{LEFT}) - log10(price{RIGHT}))"
_COSINE = """WITH u AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM u),
c AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS x FROM x GROUP BY ALL) y GROUP BY label),
s AS (SELECT vec_id AS left_id, c.label AS right_id, round(list_inner_product(v, c)
             / sqrt(list_inner_product(v, v)) / sqrt(list_inner_product(c, c)), 6) AS similarity FROM u CROSS JOIN c)"""
_ROW_COSINE = """WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
n AS (SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS v FROM u
      WHERE list_inner_product(v, v) > 0),
s AS (SELECT a.vec_id AS left_id, b.vec_id AS right_id, round(list_inner_product(a.v, b.v), 6) AS similarity
      FROM n a CROSS JOIN n b WHERE b.vec_id % 50 = 0)"""


def _lr_sql() -> str:
    """The same Newton steps: ``lr`` has every pair with its split and probability."""
    names = [f"{kind}_{f}" for f in _DISTANCES for kind in ("dist", "miss")]
    x = ", ".join(["1.0::DOUBLE", *[f"coalesce({_DISTANCES[n[5:]]}, 0.0)::DOUBLE" if n.startswith("dist") else
                                    f"CAST(({_DISTANCES[n[5:]]}) IS NULL AS DOUBLE)" for n in names]])
    size = len(names) + 1
    key = f"md5('42|' || {_IDS[0]} || '|' || {_IDS[1]}), {_IDS[0]}, {_IDS[1]}"
    z = lambda w: " + ".join(f"{w}[{j}] * x[{j}]" for j in range(1, size + 1))
    steps = [f"""fx AS MATERIALIZED (SELECT {', '.join(_IDS)}, model{LEFT}, model{RIGHT}, {LABEL}, [{x}] AS x, count(*) OVER () AS n, row_number() OVER (ORDER BY {key}) AS place FROM pairs)""",
             "fs AS (SELECT *, CASE WHEN place <= floor(0.7 * n) THEN 'train' WHEN place <= floor(0.7 * n) + floor(0.15 * n) THEN 'valid' ELSE 'test' END AS split FROM fx)",
             f"""fb AS MATERIALIZED (SELECT x, {LABEL} AS y FROM (SELECT *, count(*) OVER () AS m, row_number() OVER (PARTITION BY {LABEL} ORDER BY {key}) AS r
                 FROM fs WHERE split = 'train') t WHERE r <= floor(floor(0.3 * m) / 2) + 1)""",
             f"w0 AS (SELECT list_transform(range({size}), lambda i: 0.0::DOUBLE) AS w)",
             f"grid AS (SELECT j, k FROM (SELECT unnest(range(1, {size + 1})) AS j) a CROSS JOIN (SELECT unnest(range(1, {size + 2})) AS k) b)"]
    for t in range(linkage.NEWTON_STEPS):
        shrink = f"{linkage.PENALTY} * count(*) * (j > 1)::INT"
        steps += [
            f"p{t} AS MATERIALIZED (SELECT x, y, w, 1 / (1 + exp(-({z('w')}))) AS p FROM fb CROSS JOIN w{t})",
            f"""s{t} AS MATERIALIZED (SELECT j, k, CASE WHEN k > {size} THEN sum((y - p) * x[j]) - {shrink} * any_value(w[j])
                ELSE sum(p * (1 - p) * x[j] * x[k]) + CASE WHEN j = k THEN {shrink} ELSE 0 END END AS v FROM p{t} CROSS JOIN grid GROUP BY j, k)""",
            f"m{t} AS MATERIALIZED (SELECT list(r ORDER BY j) AS m FROM (SELECT j, list(v ORDER BY k) AS r FROM s{t} GROUP BY j) q)",
            f"""e{t} AS (SELECT 1 AS k, m FROM m{t} UNION ALL SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k
                THEN list_transform(r, lambda v: v / m[k][k]) ELSE list_transform(r, lambda v, c: v - r[k] * m[k][c] / m[k][k]) END) FROM e{t} WHERE k <= {size})""",
            f"w{t + 1} AS MATERIALIZED (SELECT list_transform(w, lambda v, i: v + m[i][{size + 1}]) AS w FROM e{t} CROSS JOIN w{t} WHERE k = {size + 1})"]
    steps.append(f"lr AS (SELECT * EXCLUDE (x, w, n), 1 / (1 + exp(-({z('w')}))) AS p FROM fs CROSS JOIN w{linkage.NEWTON_STEPS})")
    return _PAIRS.replace("WITH", "WITH RECURSIVE", 1) + ",\n" + ",\n".join(steps)


_TEXT_ID = "CASE WHEN {0} % 9 <> 0 THEN {0} END"

_LR = _lr_sql()
ORACLES = {
    "pair_lr_match": f"""{_LR} SELECT {', '.join(_IDS)}, {LABEL}, split, round(p, 6) AS match_probability,
        CAST(p > 0.5 AS BIGINT) AS predicted, round(greatest(p, 1 - p), 6) AS match_confidence FROM lr""",
    "pair_lr_eval": f"{_LR}, te AS (SELECT * FROM lr WHERE split = 'test') {_confusion('te', 'p > 0.5')}",
    "pair_lr_saved": f"""{_LR} SELECT {', '.join(_IDS)}, round(p, 6) AS match_probability,
        CAST(p > 0.5 AS BIGINT) AS predicted FROM lr WHERE split = 'test'""",
    "pair_verdicts": f"""{_PAIRS}, z AS (SELECT {', '.join(_IDS)}, model{LEFT}, model{RIGHT}, {LABEL}, 1 / (1 + exp(-({INTERCEPT} {' '.join(
        f"+ ({w}) * " + (f'coalesce({_DISTANCES[n[5:]]}, 0.0)' if n.startswith('dist') else
                         f'CAST(({_DISTANCES[n[5:]]}) IS NULL AS INTEGER)')
        for n, w in WEIGHTS.items())}))) AS p FROM pairs)
        SELECT * EXCLUDE (p), row_number() OVER (ORDER BY md5('42|' || {_IDS[0]} || '|' || {_IDS[1]})) AS place,
               CAST(p > 0.5 AS BIGINT) AS predicted FROM z""",
    "align_schema": f"""WITH {_RAW} SELECT k AS p_partkey, {', '.join(_CARD)} FROM ra""",
    "null_threshold": f"{_KEPT} SELECT * FROM ka",
    "row_id_assign": f"""{_KEPT} SELECT _order, CAST(row_number() OVER (ORDER BY _order) - 1 AS BIGINT)
        AS row_id, 'a' AS side FROM ka UNION ALL SELECT _order, CAST(row_number() OVER (ORDER BY _order)
        - 1 + (SELECT count(*) FROM ka) AS BIGINT), 'b' FROM kb""",
    "keep_first_dedup": """SELECT min(doc_id) AS doc_id, md5(text) AS key,
        arg_min(source, doc_id) AS source FROM documents GROUP BY md5(text)""",
    "keep_first_by_chunk": """WITH c AS (SELECT doc_id, md5(text) AS key,
          (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS chunk FROM documents)
        SELECT doc_id, key FROM (SELECT *, min(chunk) OVER (PARTITION BY key) AS f FROM c) x
        WHERE chunk = f""",
    "listings": f"""{_LIST} SELECT *, 'a' AS side FROM la UNION ALL BY NAME
        SELECT *, 'b' AS side FROM lb""",
    "column_drop": f"{_LIST} SELECT * EXCLUDE (description, condition) FROM lb",
    "match_table": f"{_PAIRS} SELECT * FROM mt",
    "positive_pairs": f"{_PAIRS} SELECT * FROM pos",
    "negative_pairs": f"{_PAIRS} SELECT * FROM neg",
    "label_counts": f"{_PAIRS} SELECT {LABEL} AS label, CAST(count(*) AS BIGINT) AS n FROM pairs GROUP BY 1",
    "clean_pairs": f"""{_PAIRS} SELECT {', '.join(_IDS)}, {LABEL} FROM pairs
        WHERE {_IDS[0]} % 7 <> 0 AND {_IDS[1]} % 7 <> 0""",
    "split_70_15_15": """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id)) AS r,
          count(*) OVER () AS n FROM documents)
        SELECT doc_id, CASE WHEN r <= floor(0.7 * n) THEN 'train'
          WHEN r <= floor(0.7 * n) + floor(0.15 * n) THEN 'valid' ELSE 'test' END AS split FROM r""",
    "split_counts": f"""{_PAIRS}, c AS (SELECT count(*) AS n FROM pairs),
        s AS (SELECT CAST(floor(0.7 * n) AS BIGINT) AS a, CAST(floor(0.15 * n) AS BIGINT) AS b, n FROM c)
        SELECT 'train' AS split, a AS n FROM s UNION ALL SELECT 'valid', b FROM s
        UNION ALL SELECT 'test', CAST(n - a - b AS BIGINT) FROM s""",
    "sample_fraction": """WITH c AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 1000 AS c
          FROM documents), r AS (SELECT doc_id, row_number() OVER (PARTITION BY c
          ORDER BY md5('42|' || doc_id)) AS r, count(*) OVER (PARTITION BY c) AS n FROM c)
        SELECT doc_id FROM r WHERE r <= round_even(0.05 * n, 0)""",
    "shuffle_hash": """SELECT doc_id, CAST(row_number() OVER (ORDER BY md5('42|' || doc_id)) AS BIGINT)
        AS position FROM documents""",
    "cap_rows": "SELECT o_orderkey FROM orders ORDER BY md5('42|' || o_orderkey) LIMIT 500",
    "balanced_sample": """WITH r AS (SELECT doc_id, CAST(toxic AS BIGINT) AS toxic, row_number() OVER
          (PARTITION BY toxic ORDER BY md5('42|' || doc_id)) AS r, count(*) OVER () AS n FROM labels)
        SELECT doc_id, toxic FROM r WHERE r <= floor(floor(0.3 * n) / 2) + 1""",
    "page_window": """SELECT o_orderkey, ordinal FROM (SELECT o_orderkey,
        CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS ordinal FROM orders) x
        WHERE ordinal BETWEEN 100 AND 149""",
    "block_keys": f"""{_LIST}, b AS (SELECT * FROM la UNION ALL BY NAME SELECT * FROM lb)
        SELECT row_id, {_sound('')} AS sound_key,
               array_to_string(list_sort({_loose('')}), ',') AS loose_keys FROM b""",
    "soundex_codes": f"""SELECT doc_id, coalesce(array_to_string(list_transform(
          string_split_regex(text, '[ \t\n]+'), lambda w: {_soundex("w")}), ' '), '') AS code,
        {_soundex('source')} AS source_code FROM documents""",
    "block_b1": f"""{_PAIRS} SELECT {', '.join(_IDS)}, {_B1} AS blocked,
        CASE WHEN {_B1} THEN {_sound(LEFT)} END AS block_key FROM pairs""",
    "block_b2": f"""{_PAIRS} SELECT {', '.join(_IDS)}, {_COMMON} > 0 AS blocked,
        CAST({_COMMON} AS BIGINT) AS n_common FROM pairs""",
    "block_eval": f"""{_PAIRS}, r AS (SELECT *, {_B1} AS b1, {_COMMON} > 0 AS b2 FROM pairs)
        {_confusion('r', 'b1', "'sound' AS blocking,")} UNION ALL
        {_confusion('r', 'b2', "'any' AS blocking,")}""",
    "block_sizes": f"""{_LIST},
        xa AS (SELECT unnest({_loose('')}) AS block_key FROM la),
        xb AS (SELECT unnest({_loose('')}) AS block_key FROM lb),
        na AS (SELECT block_key, CAST(count(*) AS BIGINT) AS n_left FROM xa GROUP BY 1),
        nb AS (SELECT block_key, CAST(count(*) AS BIGINT) AS n_right FROM xb GROUP BY 1)
        SELECT block_key, n_left, n_right, n_left * n_right AS comparisons FROM na JOIN nb USING (block_key)""",
    "pair_features": f"""{_CMP} SELECT {', '.join(_IDS)},
        {', '.join(f'round({c}::DOUBLE, 6) AS {c}' for c in _SIMS)} FROM cmp""",
    "jaro_winkler_names": f"""{_PAIRS} SELECT {', '.join(_IDS)},
        round(jaro_winkler_similarity(model{LEFT}, model{RIGHT}), 6) AS similarity FROM pairs""",
    "pair_rule_match": f"""{_CMP} SELECT {', '.join(_IDS)}, CAST(score >= 5.0 AS BIGINT) AS predicted
        FROM cmp""",
    "pair_rule_eval": f"{_CMP}, b AS (SELECT * FROM cmp WHERE {_COMMON} > 0) {_confusion('b', 'score >= 5.0')}",
    "threshold_curve": f"{_SWEEP} SELECT threshold, tp, fp, fn, tn, precision, recall, f1 FROM sw",
    "threshold_best": f"{_SWEEP} SELECT threshold, f1 FROM sw ORDER BY f1 DESC, threshold LIMIT 1",
    "threshold_verified": f"""{_SPLIT} {_confusion('te',
        'p > (SELECT threshold FROM va ORDER BY f1 DESC, threshold LIMIT 1)')}""",
    "pair_weighted_match": f"""{_PAIRS}, z AS (SELECT {', '.join(_IDS)}, 1 / (1 + exp(-({INTERCEPT} {' '.join(
        f"+ ({w}) * " + (f'coalesce({_DISTANCES[n[5:]]}, 0.0)' if n.startswith('dist') else
                         f'CAST(({_DISTANCES[n[5:]]}) IS NULL AS INTEGER)')
        for n, w in WEIGHTS.items())}))) AS p FROM pairs)
        SELECT {', '.join(_IDS)}, round(p, 6) AS match_probability, CAST(p > 0.5 AS BIGINT) AS predicted,
               round(greatest(p, 1 - p), 6) AS match_confidence FROM z""",
    "best_epoch": f"""{_SERIES}, b AS (SELECT run, row_number() OVER (PARTITION BY run
          ORDER BY f1 DESC, step) AS r, step, f1, t_f1 FROM s WHERE step >= 5 AND f1 > 0)
        SELECT run, CAST(b.step AS BIGINT) AS best_step, coalesce(b.f1, 0.0) AS best_dev,
               coalesce(b.t_f1, 0.0) AS test_at_best
        FROM (SELECT DISTINCT run FROM s) a LEFT JOIN (SELECT * FROM b WHERE r = 1) b USING (run)""",
    "best_checkpoint": f"""{_SERIES} SELECT a.run, CAST(a.step AS BIGINT) AS step,
        coalesce(arg_max(b.f1, [b.f1, -b.step]), 0.0) AS best_dev,
        coalesce(arg_max(b.t_f1, [b.f1, -b.step]), 0.0) AS best_test
        FROM s a LEFT JOIN s b ON a.run = b.run AND b.step <= a.step AND b.f1 > 0 GROUP BY a.run, a.step""",
    "learned_distances": f"""{_PAIRS} SELECT {', '.join(_IDS)}, {', '.join(
        f'round(coalesce({d}, 0.0), 6) AS dist_{f}, CAST(({d}) IS NULL AS DOUBLE) AS miss_{f}'
        for f, d in _DISTANCES.items())} FROM pairs""",
    "truth_lookup": f"""{_PAIRS}, t AS (SELECT {', '.join(
        f"CASE WHEN {c} % 9 = 0 THEN '?' ELSE {c} || '.0' END AS {c}, {_TEXT_ID.format(c)} AS n{i}"
        for i, c in enumerate(_IDS))} FROM pairs)
        SELECT t.{_IDS[0]}, t.{_IDS[1]}, CAST(CASE WHEN mt.{_IDS[0]} IS NULL THEN 0 ELSE 1 END AS BIGINT)
        AS true_label FROM t LEFT JOIN mt ON n0 = mt.{_IDS[0]} AND n1 = mt.{_IDS[1]}""",
    "unit_normalise": """WITH u AS (SELECT vec_id, list_transform(embedding,
          lambda x: x::DOUBLE * (label + 2)) AS v FROM embeddings)
        SELECT vec_id, round(v[1] / sqrt(list_inner_product(v, v)), 6) AS first,
               round(v[64] / sqrt(list_inner_product(v, v)), 6) AS last FROM u""",
    "vector_topk": f"""{_COSINE} SELECT left_id, right_id, similarity FROM (SELECT *, row_number() OVER
        (PARTITION BY right_id ORDER BY similarity DESC, left_id) AS r FROM s) x WHERE r <= 10""",
    "vector_threshold": f"{_COSINE} SELECT left_id, right_id, similarity FROM s WHERE similarity >= 0.2",
    "vector_row_topk": f"""{_ROW_COSINE} SELECT left_id, right_id, similarity FROM (SELECT *, row_number() OVER
        (PARTITION BY right_id ORDER BY similarity DESC, left_id) AS r FROM s) x WHERE r <= 10""",
    "vector_row_threshold": f"{_ROW_COSINE} SELECT left_id, right_id, similarity FROM s WHERE similarity >= 0.6",
    "text_normalise": f"""WITH {_RAW} SELECT k AS p_partkey, lower(manufacturer) AS brand,
        CASE WHEN k % 8 <> 0 THEN round(price, 2) END AS price FROM rb""",
}
