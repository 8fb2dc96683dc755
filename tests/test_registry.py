"""The registered queries: names, columns, and agreement with SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.check import compare, connect

# Fast ones from every section; tools/check.py runs all of them.
CHECKED = [
    "a5_cleaned_cache", "b4_class_distribution", "b8_length_summary", "b9_length_histogram", "c11_without_single_chars",
    "c13_lemmatized_text", "c16_preset_keep_latex_text", "d6_bigram_vocabulary", "d11_feature_size_sweep",
    "e1_stratified_holdout", "e2_stratified_folds_5", "f8_ovr_predictions", "f10_knn_predict", "f10b_knn_vectors",
    "f12_complement_nb_predict_norm", "g2_label_scores", "g7_g8_grid_search",
]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "predicted"] and df.count() == 113


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, small, name):
    con = connect(small)
    df = entry.queries()[name](spark, small)
    cur = con.execute(entry.oracle_sql()[name])
    assert compare([tuple(r) for r in df.collect()], df.columns, cur.fetchall(), [d[0] for d in cur.description]) == "ok"
