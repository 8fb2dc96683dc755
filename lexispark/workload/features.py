"""Vectoriser, TF-IDF, SVD and label encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark.functions import text as T
from lexispark.functions.arithmetic import l2_normalized, narrowed, rounded
from lexispark.operators import rows as R, vocabulary as V
from lexispark.operators.cleaning import preprocess
from lexispark.operators.encode import decode_labels, encode_labels
from lexispark.operators.knn import dense_rows
from lexispark.operators.reduce import singular_value_table, truncated_svd
from lexispark.session import class_values, materialize
from lexispark.workload import sql as S
from lexispark.workload.inputs import (
    CLEANING, KEY, LABEL, STOP_WORDS, TFIDF, documents, features, table, texts, train_texts,
)

SWEEP = (2000, 1000, 500, 100)
WIDE = V.TfidfConfig(max_features=2000, ngram_max=2, max_df=0.8)


def _regex_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select(KEY, T.cleaned(F.col("text")).alias("cleaned"))


def _terms(cfg: V.TfidfConfig):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _regex_cleaned(spark, sf_dir).select(
            KEY, F.array_join(V.terms_column(F.col("cleaned"), cfg), "|").alias("terms"))

    return run


def _counted(docs: DataFrame, cfg: V.TfidfConfig) -> tuple[DataFrame, DataFrame]:
    """The documents' keys and their term counts, one row per document; stored, as the vocabulary reads it twice."""
    counted = materialize(R.counted_rows(preprocess(docs, KEY, "text", CLEANING), "cleaned", cfg, (KEY,)), "counted")
    return counted.select(KEY), counted


def _train_counts(spark: SparkSession, sf_dir: str, cfg: V.TfidfConfig = TFIDF) -> tuple[DataFrame, DataFrame]:
    docs, counted = _counted(train_texts(spark, sf_dir), cfg)
    return docs, R.long_counts(counted, (KEY,))


def counted_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.long_counts(_counted(texts(spark, sf_dir), V.TfidfConfig())[1], (KEY,))


def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, counts = _train_counts(spark, sf_dir)
    cfg = V.TfidfConfig(max_features=None, min_df=2, max_df=0.8)
    return V.fit_vocabulary(docs, counts, cfg).select("term", "df", "cf")


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = V.fit_vocabulary(*_train_counts(spark, sf_dir), TFIDF)
    return vocab.select("term", "df", "cf", F.col("rank").cast("long").alias("rank"))


def bigram_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = V.fit_vocabulary(*_train_counts(spark, sf_dir, WIDE), WIDE)
    return vocab.select("term", "df", "cf", F.col("rank").cast("long").alias("rank"))


def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.fit_vocabulary(*_train_counts(spark, sf_dir), TFIDF).select("term", rounded(F.col("idf")).alias("idf"))


def _raw(sublinear: bool):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = V.TfidfConfig(max_features=2000, sublinear_tf=sublinear)
        docs, counts = _train_counts(spark, sf_dir)
        raw = V.raw_weights(counts, V.fit_vocabulary(docs, counts, cfg), cfg)
        return raw.select(KEY, "term", rounded(F.col("raw")).alias("raw"))

    return run


def train_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, counted = _counted(train_texts(spark, sf_dir), TFIDF)
    vocab = materialize(V.fit_vocabulary(docs, R.long_counts(counted, (KEY,)), TFIDF), "vocabulary")
    w = R.long_weights(R.weighted_rows(counted, vocab, TFIDF, (KEY,)), (KEY,))
    return w.join(F.broadcast(vocab.select("rank", "term")), "rank").select(KEY, "term", rounded(F.col("w")).alias("w"))


def test_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    return f.test_weights.join(F.broadcast(f.vocab.select("rank", "term")), "rank").select(KEY, "term", rounded(F.col("w")).alias("w"))


def size_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and summed weights of every document for each vocabulary size."""
    f = features(spark, sf_dir)
    return R.swept_rows(f.rows, SWEEP, (KEY,)).where("size(idx) > 0").select(
        "size", KEY, F.size("idx").cast("long").alias("n_terms"),
        rounded(F.aggregate("w", F.lit(0.0), lambda s, x: s + x)).alias("sum_w"), rounded(F.array_max("w")).alias("max_w"))


def text_svd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Singular values of the training TF-IDF rows."""
    f = features(spark, sf_dir)
    rows = f.train_rows()
    return singular_value_table(truncated_svd(rows, f.n_features, 100), rows)


def svd_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With all components the squared singular values add up to the squared entries, and lengths stay."""
    rows = dense_rows(table(spark, sf_dir, "embeddings"), "embedding").select("vec_id", "idx", "w")
    model = truncated_svd(rows, 64, 64)
    energy = float((model.singular_values**2).sum())
    square = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x)
    return model.project(rows, "vec_id").select(
        "vec_id", rounded(square).alias("square"), rounded(F.lit(energy), 4).alias("energy"))


def unit_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = table(spark, sf_dir, "embeddings").select("vec_id", l2_normalized(F.col("embedding")).alias("v"))
    return unit.select("vec_id", F.posexplode("v").alias("pos", "x")).select(
        "vec_id", F.col("pos").cast("long").alias("pos"), rounded(F.col("x")).alias("x"))


def narrowed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit vectors in single precision."""
    unit = table(spark, sf_dir, "embeddings").select("vec_id", narrowed(l2_normalized(F.col("embedding"))).alias("v"))
    return unit.select("vec_id", F.posexplode("v").alias("pos", "x")).select(
        "vec_id", F.col("pos").cast("long").alias("pos"), rounded(F.col("x").cast("double")).alias("x"))


def encoded_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(KEY, LABEL)
    classes = class_values(docs, LABEL)
    return decode_labels(encode_labels(docs, LABEL, classes), classes, out="decoded")


QUERIES = {
    "d1_vectorizer_tokens": _terms(V.TfidfConfig()),
    "d2_vectorizer_stop_words": _terms(V.TfidfConfig(stop_words=STOP_WORDS)),
    "d3_bigrams": _terms(V.TfidfConfig(ngram_max=2)),
    "d3_bigrams_after_stop_words": _terms(V.TfidfConfig(ngram_max=2, stop_words=STOP_WORDS)),
    "d4_term_counts": counted_terms,
    "d5_document_frequency": document_frequency,
    "d6_vocabulary": vocabulary,
    "d6_bigram_vocabulary": bigram_vocabulary,
    "d7_sublinear_weights": _raw(True),
    "d7_plain_weights": _raw(False),
    "d8_smoothed_idf": idf,
    "d9_tfidf_train": train_tfidf,
    "d10_tfidf_test": test_tfidf,
    "d11_feature_size_sweep": size_sweep,
    "d12_text_svd": text_svd,
    "d12_svd_all_components": svd_energy,
    "d13_unit_vectors": unit_vectors,
    "d14_single_precision": narrowed_vectors,
    "d15_label_encoding": encoded_labels,
}

PLAIN = f"plain AS (SELECT doc_id, {S.cleaned('text')} AS cleaned FROM documents)"
TOKENS = S.vectorizer_tokens("cleaned")
BIGRAM_COUNTS = S.COUNTS.replace(
    f"unnest({S.vectorizer_tokens('cleaned')})", f"unnest({S.with_bigrams('t')})"
).replace("FROM prep)", f"FROM (SELECT *, {TOKENS} AS t FROM prep))")


def _terms_sql(tokens: str, bigrams: bool) -> str:
    final = S.with_bigrams("t") if bigrams else "t"
    return f"""WITH {PLAIN}, tok AS (SELECT doc_id, {tokens} AS t FROM plain)
SELECT doc_id, array_to_string({final}, '|') AS terms FROM tok"""


UNIT = """flat AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
unit AS (SELECT vec_id, pos, x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS x FROM flat)"""

SQL = {
    "d1_vectorizer_tokens": _terms_sql(TOKENS, False),
    "d2_vectorizer_stop_words": _terms_sql(S.without_stop_words(TOKENS), False),
    "d3_bigrams": _terms_sql(TOKENS, True),
    "d3_bigrams_after_stop_words": _terms_sql(S.without_stop_words(TOKENS), True),
    "d4_term_counts": f"WITH {S.CORPUS}, {S.PREP}, {S.COUNTS} SELECT doc_id, term, tf FROM counts",
    "d5_document_frequency": f"""WITH {S.CORPUS}, {S.PREP}, {S.COUNTS}
SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM counts WHERE is_train GROUP BY term
HAVING count(*) >= 2 AND count(*) <= 0.8::DOUBLE * (SELECT count(*) FROM prep WHERE is_train)""",
    "d6_vocabulary": f"WITH {S.tfidf()} SELECT term, df, cf::BIGINT AS cf, rank FROM vocab",
    "d6_bigram_vocabulary": f"""WITH {S.CORPUS}, {S.PREP}, {BIGRAM_COUNTS}
SELECT term, df, cf, row_number() OVER (ORDER BY cf DESC, term) AS rank
FROM (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM counts WHERE is_train GROUP BY term)
WHERE df >= 2 AND df <= 0.8::DOUBLE * (SELECT count(*) FROM prep WHERE is_train)
ORDER BY rank LIMIT 2000""",
    "d7_sublinear_weights": f"""WITH {S.tfidf()}
SELECT doc_id, term, {S.r6('(1 + ln(tf::DOUBLE)) * idf')} AS raw FROM counts JOIN vocab USING (term) WHERE is_train""",
    "d7_plain_weights": f"""WITH {S.tfidf()}
SELECT doc_id, term, {S.r6('tf * idf')} AS raw FROM counts JOIN vocab USING (term) WHERE is_train""",
    "d8_smoothed_idf": f"WITH {S.tfidf()} SELECT term, {S.r6('idf')} AS idf FROM vocab",
    "d9_tfidf_train": f"WITH {S.tfidf()} SELECT doc_id, term, {S.r6('w')} AS w FROM weights WHERE is_train",
    "d10_tfidf_test": f"WITH {S.tfidf()} SELECT doc_id, term, {S.r6('w')} AS w FROM weights WHERE NOT is_train",
    "d11_feature_size_sweep": f"""WITH {S.tfidf()},
sizes AS (SELECT unnest([2000, 1000, 500, 100])::BIGINT AS size),
raw AS (SELECT s.size, c.doc_id, (1 + ln(tf::DOUBLE)) * idf AS raw
        FROM counts c JOIN vocab v USING (term) JOIN sizes s ON v.rank <= s.size),
w AS (SELECT size, doc_id, raw / sqrt(sum(raw * raw) OVER (PARTITION BY size, doc_id)) AS w FROM raw)
SELECT size, doc_id, count(*) AS n_terms, {S.r6('sum(w)')} AS sum_w, {S.r6('max(w)')} AS max_w FROM w GROUP BY ALL""",
    "d12_svd_all_components": f"""WITH {UNIT}
SELECT vec_id, {S.r6('sum(x * x)')} AS square, round((SELECT sum(x * x) FROM unit), 4) AS energy FROM unit GROUP BY vec_id""",
    "d13_unit_vectors": f"WITH {UNIT} SELECT vec_id, pos::BIGINT AS pos, {S.r6('x')} AS x FROM unit",
    "d14_single_precision": f"WITH {UNIT} SELECT vec_id, pos::BIGINT AS pos, {S.r6('x::FLOAT::DOUBLE')} AS x FROM unit",
    "d15_label_encoding": """SELECT doc_id, lang, label_idx, lang AS decoded FROM documents
JOIN (SELECT lang, (row_number() OVER (ORDER BY lang) - 1)::BIGINT AS label_idx FROM (SELECT DISTINCT lang FROM documents))
USING (lang)""",
}
