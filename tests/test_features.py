"""Vocabulary, TF-IDF, SVD and encoding."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.operators import vocabulary as V
from lexispark.operators.encode import decode_labels, encode_labels
from lexispark.operators.knn import dense_rows
from lexispark.operators.ranking import spread_join, top_k
from lexispark.operators.reduce import truncated_svd
from lexispark.plans.features import text_features

DOCS = [(1, "red red blue"), (2, "red green"), (3, "blue green green"), (4, ""), (5, "red blue")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id long, t string")


def test_vocabulary_limits_and_order(spark, docs):
    counts = V.term_counts(docs, "id", "t")
    vocab = V.fit_vocabulary(docs, counts, V.TfidfConfig(max_features=2, min_df=2))
    got = {r.term: (r.rank, r.df, r.cf, round(r.idf, 9)) for r in vocab.collect()}
    # blue and green both occur three times: the order is alphabetical
    assert got == {
        "red": (1, 3, 4, round(np.log(6 / 4) + 1, 9)), "blue": (2, 3, 3, round(np.log(6 / 4) + 1, 9)),
    }
    limited = V.fit_vocabulary(docs, counts, V.TfidfConfig(max_features=None, min_df=1, max_df=0.5))
    assert {r.term for r in limited.collect()} == {"green"}


def test_tfidf_rows_have_unit_length(docs):
    counts = V.term_counts(docs, "id", "t")
    vocab = V.fit_vocabulary(docs, counts, V.TfidfConfig())
    w = V.tfidf(counts, vocab, "id")
    lengths = {r.id: r.n for r in w.groupBy("id").agg(F.sum(F.col("w") * F.col("w")).alias("n")).collect()}
    assert set(lengths) == {1, 2, 3, 5} and all(abs(n - 1) < 1e-12 for n in lengths.values())
    one = {r.term: r.w for r in w.where("id = 1").collect()}
    assert abs(one["red"] / one["blue"] - (1 + np.log(2))) < 1e-12


def test_unseen_terms_and_empty_documents(spark):
    train = spark.createDataFrame([(1, "red blue", "a"), (2, "red blue", "b")], "id long, t string, y string")
    test = spark.createDataFrame([(1, "red violet"), (9, "violet"), (10, "")], "id long, t string")
    f = text_features(train, test, "id", "t", "y", V.TfidfConfig(max_features=10))
    rows = {r.id: (list(r.idx), list(r.w)) for r in f.test_rows().collect()}
    # id 1 is in both tables; its test row has its own norm
    assert rows[1] == ([1], [1.0]) and rows[9] == ([], []) and rows[10] == ([], [])


def test_sweep_equals_single_fits(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    counts = V.term_counts(docs, "doc_id", "text")
    vocab = V.fit_vocabulary(docs, counts, V.TfidfConfig(max_features=200))
    swept = V.feature_size_sweep(counts, vocab, "doc_id", [200, 50]).where("size = 50")
    cfg = V.TfidfConfig(max_features=50)
    alone = V.tfidf(counts, V.fit_vocabulary(docs, counts, cfg), "doc_id", cfg)
    key = lambda df: {(r.doc_id, r.term): round(r.w, 10) for r in df.collect()}
    assert key(swept) == key(alone)


def test_top_k_is_exact(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), "id", (F.col("id") * 7919 % 1009).alias("x"))
    order = [F.desc("x"), F.asc("id")]
    got = {(r.g, r.id, r["rank"]) for r in top_k(df, 40, order, "id", ["g"], slices=(16, 4)).collect()}
    want = set()
    for g in range(3):
        rows = sorted(((-(i * 7919 % 1009), i) for i in range(g, 5000, 3)))[:40]
        want |= {(g, i, n) for n, (_, i) in enumerate(rows, 1)}
    assert got == want
    whole = top_k(df, 7, order, "id").orderBy("rank").collect()
    assert [r["rank"] for r in whole] == list(range(1, 8))


def test_spread_join_equals_plain_join(spark):
    big = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 5).alias("k"))
    small = spark.createDataFrame([(0, "a"), (1, "b"), (3, "c")], "k long, v string")
    rows = lambda df: sorted((r.id, r.k, r.v or "") for r in df.select("id", "k", "v").collect())
    for how in ("left", "inner"):
        assert rows(spread_join(big, small, ["k"], ["id"], how)) == rows(big.join(small, "k", how))


def test_svd_matches_dense_decomposition(spark, small):
    e = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = dense_rows(e, "embedding").select("vec_id", "idx", "w")
    x = np.array([r.w for r in rows.orderBy("vec_id").collect()])
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    model = truncated_svd(rows, 64, 64)
    assert np.allclose(model.singular_values, s, atol=1e-8)
    low = truncated_svd(rows, 64, 8, n_iter=20)
    assert np.allclose(low.singular_values, s[:8], rtol=1e-3)
    again = truncated_svd(rows, 64, 8, n_iter=20)
    assert np.allclose(low.components, again.components)
    projected = np.array([r.vector for r in model.project(rows, "vec_id").orderBy("vec_id").collect()])
    assert np.allclose(projected @ projected.T, x @ x.T, atol=1e-8)
    with pytest.raises(ValueError):
        truncated_svd(rows, 64, 65)


def test_encoding_of_gaps(spark):
    df = spark.createDataFrame([(7,), (2,), (7,)], "y long")
    rows = decode_labels(encode_labels(df, "y"), [2, 7]).collect()
    assert [(r.y, r.label_idx, r.label) for r in rows] == [(7, 1, 7), (2, 0, 2), (7, 1, 7)]


def test_terms_are_counted_in_small_slices():
    from lexispark.operators import rows

    lengths = np.full(10_000, 300)
    parts = list(rows._slices(lengths))
    assert parts[0][0] == 0 and parts[-1][1] == len(lengths)
    assert max(lengths[a:b].sum() for a, b in parts) <= 1 << 18  # a batch of 10,000 texts was two slices
