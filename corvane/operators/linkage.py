"""Record linkage: schema alignment, labelled pairs, blocking, comparison, classification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.functions import cleaning, similarity
from corvane.operators import ordinals
from corvane.operators.joins import salted_lookup, zip_rows

# Source column -> aligned column, one mapping per listing.
LISTING_A = {
    "vin": "vin", "make_name": "manufacturer", "model_name": "model", "year": "year",
    "price": "price", "mileage": "mileage", "transmission": "transmission",
    "fuel_type": "fuel_type", "body_type": "body_type", "exterior_color": "color",
    "description": "description", "engine_cylinders": "cylinders",
    "wheel_system": "wheel_system", "is_new": "condition", "latitude": "lat",
    "longitude": "long",
}
LISTING_B = {
    "VIN": "vin", "manufacturer": "manufacturer", "model": "model", "year": "year",
    "price": "price", "odometer": "mileage", "transmission": "transmission",
    "fuel": "fuel_type", "type": "body_type", "paint_color": "color",
    "description": "description", "cylinders": "cylinders", "drive": "wheel_system",
    "condition": "condition", "lat": "lat", "long": "long",
}

LEFT, RIGHT, LABEL = "_used_cars", "_vehicles", "match_label"
LEAKS = ("vin", "row_id")


# --- alignment -------------------------------------------------------------------------------
def align(df: DataFrame, mapping: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Keep the mapped columns under their aligned names (and ``keep`` as they are)."""
    return df.select(*[F.col(s).alias(t) for s, t in mapping.items() if s in df.columns], *keep)


def blanks_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[cleaning.blank_to_null(F.col(c)).alias(c) if t == "string" else F.col(c)
                       for c, t in df.dtypes])


def drop_sparse(df: DataFrame, columns: list[str], threshold: float = 0.7) -> DataFrame:
    """Rows with at least ``int(len(columns) * threshold)`` values."""
    return df.dropna(thresh=int(len(columns) * threshold), subset=columns)


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """First row of every key; rows without a key all stay.

    The ``row_number() = 1`` filter is applied per task before the shuffle, so a key that holds a
    third of the table arrives as one row per task.
    """
    # a row without a key is a group of its own
    alone = F.when(F.col(key).isNull(), F.col(order))
    ranked = df.withColumn("_alone", alone).withColumn(
        "_rn", F.row_number().over(W.partitionBy(key, "_alone").orderBy(order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn", "_alone")


def keep_first_by_chunk(df: DataFrame, key: str, ordinal: str, chunk_rows: int = 1000) -> DataFrame:
    """Drop a key seen in an *earlier chunk* of input rows; repeats inside a chunk stay."""
    chunked = df.withColumn("_chunk", F.floor(F.col(ordinal) / chunk_rows))
    first = (chunked.filter(F.col(key).isNotNull()).groupBy(key)
             .agg(F.min("_chunk").alias("_first")))
    known = (salted_lookup(chunked, first, [key], [ordinal])
             .filter(F.col("_chunk") == F.col("_first")).select(*df.columns))
    return known.unionByName(df.filter(F.col(key).isNull()))


def aligned_rows(df: DataFrame, mapping: dict[str, str], order: str,
                 threshold: float = 0.7) -> DataFrame:
    """Aligned rows that carry enough values, with their input order ``_order``."""
    aligned = blanks_to_null(align(df, mapping, keep=(F.col(order).alias("_order"),)))
    return drop_sparse(aligned, [c for c in aligned.columns if c != "_order"], threshold)


def listing(rows: DataFrame, start: Column | int = 0) -> DataFrame:
    """Row ids from ``start`` in input order, given before de-duplication by VIN (so with gaps)."""
    numbered = ordinals.with_key_rank(rows, "_order", "row_id", start).drop("_order")
    return keep_first(numbered, "vin", "row_id") if "vin" in numbered.columns else numbered


def two_listings(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both listings; the ids of the second continue after the first."""
    return listing(a), listing(b, a.agg(F.count(F.lit(1))).scalar())


# --- labelled pairs --------------------------------------------------------------------------
def suffixed(df: DataFrame, suffix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c + suffix) for c in df.columns])


def positive_pairs(a: DataFrame, b: DataFrame, key: str = "vin") -> DataFrame:
    left, right = suffixed(a, LEFT), suffixed(b, RIGHT)
    return (left.join(right, F.col(key + LEFT) == F.col(key + RIGHT))
            .withColumn(LABEL, F.lit(1)))


def negative_pairs(a: DataFrame, b: DataFrame, count: Column, id_col: str = "row_id",
                   key: str = "vin", seed: int = 42) -> DataFrame:
    """``count`` random rows of each side (fewer when a side is smaller) put side by side; pairs
    with an equal key are dropped, a missing key never equals."""
    n_a, n_b = (x.agg(F.count(F.lit(1))).scalar() for x in (a, b))
    n = F.least(count, n_a, n_b)
    picked = [
        suffixed(ordinals.with_shuffle_rank(df, [id_col], "_rank", s)
                 .filter(F.col("_rank") <= n), suffix)
        .withColumnRenamed(f"_rank{suffix}", "_rank")
        for df, s, suffix in ((a, seed, LEFT), (b, seed + 1, RIGHT))]
    zipped = zip_rows(picked[0], picked[1], "_rank").drop("_rank")
    same = F.coalesce(F.col(key + LEFT) == F.col(key + RIGHT), F.lit(False))
    return zipped.filter(~same).withColumn(LABEL, F.lit(0))


def labelled_pairs(a: DataFrame, b: DataFrame, match_count: Column, **how) -> DataFrame:
    """All positives and as many drawn negatives as the match table has rows."""
    return positive_pairs(a, b).unionByName(negative_pairs(a, b, match_count, **how))


def clean_ids(pairs: DataFrame, columns: tuple[str, ...] = ("row_id" + LEFT, "row_id" + RIGHT)) -> DataFrame:
    """Drop rows without ids; ``12.0`` becomes 12."""
    out = pairs.dropna(subset=list(columns))
    for c in columns:
        out = out.withColumn(c, F.col(c).cast("double").cast("long"))
    return out


# --- blocking --------------------------------------------------------------------------------
def _key_text(c: Column, nan_text: bool) -> Column:
    """Lower-cased trimmed key part.  ``nan_text`` turns a missing value into the text ``nan``,
    as the source scripts do; otherwise it gives no key."""
    text = F.lower(cleaning.strip(c.cast("string")))
    return F.coalesce(text, F.lit("nan")) if nan_text else F.nullif(text, F.lit(""))


def sound_key(manufacturer: Column, model: Column, nan_text: bool = False) -> Column:
    """md5 of the soundex codes of brand and model."""
    brand, name = _key_text(manufacturer, nan_text), _key_text(model, nan_text)
    return F.md5(F.concat(similarity.soundex(brand), F.lit("_"), similarity.soundex(name)))


def loose_keys(manufacturer: Column, model: Column, year: Column, nan_text: bool = False) -> Column:
    """Up to four md5 keys: sound of brand and model, brand with first letter of the model,
    model, and the year when it is four digits."""
    brand, name = _key_text(manufacturer, nan_text), _key_text(model, nan_text)
    text = F.trim(year.cast("string"))
    keys = F.array(
        F.concat(similarity.soundex(brand), F.lit("_"), similarity.soundex(name)),
        F.concat(brand, F.lit("_"), F.substring(name, 1, 1)),
        name,
        F.when(text.rlike(r"^\d{4}$"), F.concat(F.lit("year_"), text)))
    return F.array_distinct(F.transform(F.array_compact(keys), F.md5))


def route_by_sound(pairs: DataFrame, nan_text: bool = False) -> DataFrame:
    """Pairs with block_key and ``blocked``: both sides have the same sound key."""
    key = lambda s: sound_key(F.col("manufacturer" + s), F.col("model" + s), nan_text)
    same = F.coalesce(key(LEFT) == key(RIGHT), F.lit(False))
    return (pairs.withColumn("blocked", same)
            .withColumn("block_key", F.when(F.col("blocked"), key(LEFT))))


def route_by_any_key(pairs: DataFrame, nan_text: bool = False) -> DataFrame:
    """Pairs with the shared keys and ``blocked``: the sides share at least one loose key."""
    def keys(s: str) -> Column:
        return loose_keys(F.col("manufacturer" + s), F.col("model" + s), F.col("year" + s), nan_text)

    return (pairs.withColumn("common_keys", F.array_intersect(keys(LEFT), keys(RIGHT)))
            .withColumn("blocked", F.size("common_keys") > 0))


def block_sizes(a: DataFrame, b: DataFrame, nan_text: bool = False) -> DataFrame:
    """Rows of each side per loose key and the comparisons the block would cost.

    Sizes are aggregated before any join, so a block holding a third of the rows is one row here;
    no pair is built.
    """
    def sizes(df: DataFrame, out: str) -> DataFrame:
        keys = loose_keys(F.col("manufacturer"), F.col("model"), F.col("year"), nan_text)
        return (df.select(F.explode_outer(keys).alias("block_key"))
                .filter(F.col("block_key").isNotNull()).groupBy("block_key")
                .agg(F.count(F.lit(1)).alias(out)))

    return (sizes(a, "n_left").join(sizes(b, "n_right"), "block_key")
            .withColumn("comparisons", F.col("n_left") * F.col("n_right")))


# --- comparison and classification -----------------------------------------------------------
# Compared fields, Jaro-Winkler cut, Gaussian offset and scale, match threshold.
STRING_FIELDS = ("body_type", "fuel_type", "manufacturer", "model", "color", "description")
STRING_CUT = 0.6
NUMERIC_FIELDS = {"price": (100.0, 1000.0), "mileage": (500.0, 5000.0)}
MATCH_SCORE = 5.0


def compare(pairs: DataFrame) -> DataFrame:
    """Add one similarity per compared field that the pairs carry, and their sum ``score``."""
    fields = {c[: -len(LEFT)] for c in pairs.columns if c.endswith(LEFT)}
    sims = {}
    if "year" in fields:
        sims["year"] = similarity.exact(F.col("year" + LEFT), F.col("year" + RIGHT))
    for f in STRING_FIELDS:
        if f in fields:
            sims[f] = similarity.string_match(F.col(f + LEFT).cast("string"),
                                              F.col(f + RIGHT).cast("string"), STRING_CUT)
    for f, (offset, scale) in NUMERIC_FIELDS.items():
        if f in fields:
            sims[f] = similarity.gauss(F.col(f + LEFT), F.col(f + RIGHT), offset, scale)
    out = pairs.select("*", *[c.alias("sim_" + f) for f, c in sims.items()])
    score = F.lit(0.0)
    for f in sims:
        score = score + F.col("sim_" + f)
    return out.withColumn("score", score)


def rule_match(compared: DataFrame, threshold: float = MATCH_SCORE) -> DataFrame:
    return compared.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


# Fields of the learned matcher.
LEARNED_STRINGS = ("manufacturer", "model")
LEARNED_SHORT = ("fuel_type", "color", "body_type")


def learned_features(pairs: DataFrame) -> tuple[DataFrame, list[str]]:
    """Distances of the learned matcher; a missing side gives distance 0 and a missing flag."""
    fields = {c[: -len(LEFT)] for c in pairs.columns if c.endswith(LEFT)}
    text = lambda f, s: cleaning.normalise_text(F.col(f + s))
    price = lambda s: cleaning.normalise_price(F.col("price" + s))
    distances = {f: 1.0 - similarity.jaro_winkler(text(f, LEFT), text(f, RIGHT))
                 for f in LEARNED_STRINGS + LEARNED_SHORT if f in fields}
    if "year" in fields:
        distances["year"] = (text("year", LEFT) != text("year", RIGHT)).cast("double")
    if "price" in fields:
        distances["price"] = similarity.log_price_distance(price(LEFT), price(RIGHT))
    out = pairs.select("*", *[d.alias("dist_" + f) for f, d in distances.items()])
    names = []
    for f in distances:
        out = (out.withColumn("miss_" + f, F.col("dist_" + f).isNull().cast("double"))
               .withColumn("dist_" + f, F.coalesce("dist_" + f, F.lit(0.0))))
        names += ["dist_" + f, "miss_" + f]
    return out, names


NEWTON_STEPS = 8
PENALTY = 0.01
"""Weight of the squared coefficients in the mean loss; the intercept is free."""


def fit_matcher(features: DataFrame, names: list[str], steps: int = NEWTON_STEPS, penalty: float = PENALTY) -> DataFrame:
    """One row: ``weights`` of a logistic regression over the named columns, the intercept first.

    A Newton step is one pass over ``features`` (which should be kept, as with ``materialise``): a task
    multiplies its batches out to (d + 1)(d + 2) sums for d columns, these are added up by place and solved by
    the driver.  The steps are fixed, so the same rows give the same weights on any number of tasks, up to
    rounding.  A null counts as 0.
    """
    size = len(names) + 1
    rows = features.select(*[F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, n in enumerate(names)],
                           F.col(LABEL).cast("double").alias("y"))
    shrink = np.array([0.0] + [penalty] * len(names))
    weights = np.zeros(size)

    def sums(weights: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((size, size + 1))
            for batch in batches:
                columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                x = np.stack([np.ones(batch.num_rows), *columns[:-1]], axis=1)
                p = 1 / (1 + np.exp(-x @ weights))
                total[:, :size] += (x * (p * (1 - p))[:, None]).T @ x
                total[:, size] += x.T @ (columns[-1] - p)
            yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["place", "v"])

        return run

    for step in range(steps):
        found = rows.mapInArrow(sums(weights), "place int, v double").groupBy("place").agg(F.sum("v").alias("v")).collect()
        total = np.zeros(size * (size + 1))
        for place, v in found:  # (d + 1)(d + 2) numbers
            total[place] = v
        total = total.reshape(size, size + 1)
        if not step:
            count = 4 * total[0, 0]  # p (1 - p) is 1/4 for every row at first
        if not count:
            raise ValueError("no row to fit the matcher on")
        # lstsq: with one label only, the intercept has no finite best value
        weights = weights + np.linalg.lstsq(total[:, :size] + np.diag(count * shrink), total[:, size] - count * shrink * weights, rcond=None)[0]
    return features.sparkSession.range(1).select(F.array(*[F.lit(float(w)) for w in weights]).alias("weights"))


def save_matcher(model: DataFrame, path: str) -> None:
    """The fitted weights as a table of one row."""
    model.coalesce(1).write.mode("overwrite").parquet(path)


def load_matcher(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("weights array<double>").parquet(path)


def with_verdict(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add the predicted label and the confidence in that label to ``match_probability``."""
    p, predicted = F.col("match_probability"), F.col("predicted")
    return (scored.withColumn("predicted", (p > threshold).cast("int"))
            .withColumn("match_confidence", F.when(predicted == 1, p).otherwise(1 - p)))


def learned_match(model: DataFrame, features: DataFrame, names: list[str], threshold: float = 0.5) -> DataFrame:
    """Add probability of a match, predicted label and the confidence in that label, by fitted weights."""
    scored = features.join(F.broadcast(model.select(F.col("weights").alias("_w"))))  # one row
    z = F.get("_w", F.lit(0))
    for j, name in enumerate(names, start=1):
        z = z + F.get("_w", F.lit(j)) * F.col(name)
    return with_verdict(scored.withColumn("match_probability", 1 / (1 + F.exp(-z))), threshold).drop("_w")


def weighted_match(features: DataFrame, weights: dict[str, float], intercept: float, threshold: float = 0.5) -> DataFrame:
    """As learned_match, with the weights of a published model: no fit, no model file."""
    z = F.lit(intercept)
    for name, weight in weights.items():
        z = z + F.col(name) * weight
    return with_verdict(features.withColumn("match_probability", 1 / (1 + F.exp(-z))), threshold)


# --- evaluation ------------------------------------------------------------------------------
def ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(0.0)


def with_prf(counts: DataFrame) -> DataFrame:
    """Add precision, recall and F1 to tp, fp, fn, tn; 0 where a denominator is 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    out = (counts.withColumn("precision", ratio(tp, tp + fp))
           .withColumn("recall", ratio(tp, tp + fn)))
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", ratio(2 * p * r, p + r))


def confusion(df: DataFrame, predicted: Column, actual: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """tp, fp, fn, tn and the derived scores, over the table or per group."""
    return with_prf(df.groupBy(*by).agg(
        F.count_if(predicted & actual).alias("tp"), F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"), F.count_if(~predicted & ~actual).alias("tn")))


def threshold_sweep(scored: DataFrame, probability: str, label: str = LABEL) -> DataFrame:
    """F1 at the thresholds 0.00, 0.05 .. 0.95 with ``probability > threshold``.

    Rows are first counted by the number of thresholds they exceed (21 groups), then summed from
    above, so the table is read once and not multiplied by the thresholds.
    """
    p = F.col(probability)
    above = F.greatest(F.lit(0), F.least(F.lit(20), F.ceil(p * 20)))
    # the cut below can be off by one when p*20 is rounded; compare against the exact threshold
    above = F.when((above > 0) & ~(p > (above - 1) / 20), above - 1).otherwise(above)
    above = F.when((above < 20) & (p > above / 20), above + 1).otherwise(above)
    hist = (scored.withColumn("_n", above.cast("int")).groupBy("_n")
            .agg(F.count_if(F.col(label) == 1).alias("pos"),
                 F.count_if(F.col(label) == 0).alias("neg")))
    # 21 groups at most, held as one array
    bins = hist.agg(F.collect_list(F.struct("_n", "pos", "neg")).alias("bins"))
    steps = bins.select("bins", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("step"))

    def total(part: str, test) -> Column:
        chosen = F.filter("bins", lambda x: test(x["_n"], F.col("step")))
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda acc, x: acc + x[part])

    counted = steps.select(
        "step", total("pos", lambda n, s: n > s).alias("tp"),
        total("neg", lambda n, s: n > s).alias("fp"),
        total("pos", lambda n, s: n <= s).alias("fn"),
        total("neg", lambda n, s: n <= s).alias("tn"))
    return with_prf(counted).withColumn("threshold", F.col("step") / 20)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The first threshold with the best F1; 0.5 when no F1 is above 0."""
    best = sweep.filter(F.col("f1") > 0).agg(
        F.max_by(F.struct("threshold", "f1"), F.struct("f1", -F.col("threshold"))).alias("b"))
    return best.select(F.coalesce("b.threshold", F.lit(0.5)).alias("threshold"),
                       F.coalesce("b.f1", F.lit(0.0)).alias("f1"))


def best_step(series: DataFrame, run: str, step: str, dev: str, test: str, skip: int = 5) -> DataFrame:
    """Per run the test metric at the best validation metric after the first ``skip`` points;
    the earliest best counts, 0 when none is above 0."""
    late = series.filter((F.col(step) >= skip) & (F.col(dev) > 0))
    best = late.groupBy(run).agg(F.max_by(F.struct(F.col(step), F.col(dev), F.col(test)),
                                          F.struct(F.col(dev), -F.col(step))).alias("b"))
    return (series.select(run).distinct().join(best, run, "left")
            .select(run, F.col(f"b.{step}").alias("best_step"),
                    F.coalesce(F.col(f"b.{dev}"), F.lit(0.0)).alias("best_dev"),
                    F.coalesce(F.col(f"b.{test}"), F.lit(0.0)).alias("test_at_best")))


def best_so_far(series: DataFrame, run: str, step: str, dev: str, test: str) -> DataFrame:
    """Per step the test metric of the best validation metric up to that step."""
    until = (W.partitionBy(run).orderBy(step)
             .rowsBetween(W.unboundedPreceding, W.currentRow))
    seen = F.when(F.col(dev) > 0, F.struct(F.col(dev), -F.col(step), F.col(test)))
    best = F.max(seen).over(until)
    return series.select(run, step, F.coalesce(best[dev], F.lit(0.0)).alias("best_dev"),
                         F.coalesce(best[test], F.lit(0.0)).alias("best_test"))
