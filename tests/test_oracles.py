"""Named queries against their SQL oracles.  CORVANE_ALL=1 runs every query."""

import os

import pytest

import __spark_entry__ as entry
import check_oracle

SF = "/root/testdata/sf0.001"
QUICK = """search_bm25 search_must search_multi_match search_phrase search_field_and search_mixed index_postings
index_term_stats rank_per_query query_normalise date_month_eq html_paragraphs html_tree_counts xml_paragraphs
xml_tables article_metadata substring_link link_text_blob context_paragraphs title_section_extract
keep_first_dedup row_id_assign split_70_15_15 sample_fraction balanced_sample block_b2 pair_features
threshold_best best_checkpoint vector_topk vector_threshold parse_pair tfidf_summary tfidf_mean
ngram_repetition auto_thresholds quality_filter augment_swap augment_append_col synthetic_fanout
csv_fields stored_confusion text_files markup_files metadata_files object_list_rows link_map_rows json_lines
annotation_lines query_set_files pair_lines run_log_lines feed_entries result_pages routed_rows load_counts run_entry
index_figures index_tables search_tables synthetic_dataset synthetic_counts pair_weighted_match
threshold_verified pair_lr_saved pair_verdicts""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("CORVANE_ALL") else QUICK)
def test_query_equals_oracle(spark, duck, name):
    problem, _, _ = check_oracle.compare(spark, duck, SF, name)
    assert problem is None, problem


@pytest.mark.parametrize("name", ["vector_row_topk", "vector_row_threshold"])
def test_row_searches_ask_with_every_50th_row(spark, duck, name):
    problem, _, _ = check_oracle.compare(spark, duck, SF, name)
    assert problem is None, problem
    asked = {r["right_id"] for r in entry.queries()[name](spark, SF).select("right_id").distinct().collect()}
    assert asked == {i for i, in duck.execute("SELECT vec_id FROM embeddings WHERE vec_id % 50 = 0").fetchall()}


def test_learned_matcher_scores_every_pair(spark, duck):
    scored = entry.queries()["pair_lr_match"](spark, SF)
    ids = [c for c in scored.columns if c.startswith("row_id")]
    pairs = duck.execute(entry.oracle_sql()["clean_pairs"].replace(
        f"WHERE {ids[0]} % 7 <> 0 AND {ids[1]} % 7 <> 0", "")).fetchall()
    rows = scored.collect()
    assert sorted(tuple(r[c] for c in ids) for r in rows) == sorted(p[:2] for p in pairs)
    assert {r["split"] for r in rows} == {"train", "valid", "test"}
    assert all(0 <= r["match_probability"] <= 1 for r in rows)
    judged = entry.queries()["pair_lr_eval"](spark, SF).first()
    assert judged["tp"] + judged["fp"] + judged["fn"] + judged["tn"] == sum(r["split"] == "test" for r in rows)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["query_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("name", ["search_should", "block_eval", "tfidf_mean"])
def test_result_does_not_depend_on_partitions(spark, name):
    def run(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        return sorted(map(tuple, entry.queries()[name](spark, SF).collect()))

    try:
        assert run("1") == run("7")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
