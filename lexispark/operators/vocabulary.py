"""Vocabulary and TF-IDF in long form: one row per document and term."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexispark.functions import text as T
from lexispark.operators.ranking import lookup_join, top_k
from lexispark.session import BROADCAST_ROWS


@dataclass(frozen=True)
class TfidfConfig:
    max_features: int | None = 5000
    min_df: int = 2
    max_df: float = 1.0
    sublinear_tf: bool = True
    ngram_max: int = 1
    stop_words: tuple[str, ...] = ()
    token_pattern: str = T.TOKEN_PATTERN


def terms_column(text: Column, cfg: TfidfConfig) -> Column:
    return T.ngrams(T.vectorizer_tokens(text, cfg.stop_words, cfg.token_pattern), cfg.ngram_max)


def by_document(docs: DataFrame, key: str) -> DataFrame:
    """Place each document by its key.

    The text is shuffled once, while it is still compact.  Term counts, row norms
    and scores are all grouped by document, so none of them shuffles again.
    """
    return docs.repartition(key)


def term_counts(docs: DataFrame, key: str, text: str, cfg: TfidfConfig = TfidfConfig(),
                keep: Sequence[str] = ()) -> DataFrame:
    """``(key, keep..., term, tf)``; ``docs`` should come from :func:`by_document`."""
    return (
        docs.select(key, *keep, F.explode(terms_column(F.col(text), cfg)).alias("term"))
        .groupBy(key, *keep, "term")
        .agg(F.count("*").alias("tf"))
    )


def term_statistics(counts: DataFrame) -> DataFrame:
    """Document frequency and corpus count of each term."""
    return counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def smooth_idf(n: Column, df: Column) -> Column:
    return F.log((F.lit(1.0) + n) / (F.lit(1.0) + df)) + F.lit(1.0)


def select_terms(stats: DataFrame, n_docs: Column, cfg: TfidfConfig) -> DataFrame:
    """Terms within the frequency limits, the ``max_features`` most frequent of them.

    The order is by corpus count, then by term.
    """
    kept = stats.where(F.col("df") >= cfg.min_df)
    if cfg.max_df < 1.0:
        kept = kept.where(F.col("df") <= F.lit(cfg.max_df) * n_docs)
    if cfg.max_features is not None:
        kept = top_k(kept, cfg.max_features, [F.desc("cf"), F.asc("term")], "term")
    return kept.withColumn("idf", smooth_idf(n_docs, F.col("df")))


def fit_vocabulary(train_docs: DataFrame, train_counts: DataFrame, cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    """``(term, df, cf, rank, idf)`` of the training documents, empty ones included in their number."""
    return select_terms(term_statistics(train_counts), train_docs.agg(F.count("*")).scalar(), cfg)


def term_weight(tf: Column, idf: Column, sublinear: Column | bool = True) -> Column:
    damped = F.lit(1.0) + F.log(tf.cast("double"))
    if isinstance(sublinear, bool):
        return (damped if sublinear else tf.cast("double")) * idf
    return F.when(sublinear, damped).otherwise(tf.cast("double")) * idf


def raw_weights(counts: DataFrame, vocab: DataFrame, cfg: TfidfConfig = TfidfConfig()) -> DataFrame:
    """Weights before the row norm; terms outside the vocabulary are dropped."""
    side = vocab.select("term", "idf", *[c for c in ("rank",) if c in vocab.columns])
    key = counts.columns[0]
    joined = lookup_join(counts, side, ["term"], [key],
                         cfg.max_features is not None and cfg.max_features <= BROADCAST_ROWS)
    return joined.withColumn("raw", term_weight(F.col("tf"), F.col("idf"), cfg.sublinear_tf))


def tfidf(counts: DataFrame, vocab: DataFrame, key: str, cfg: TfidfConfig = TfidfConfig(),
          group: Sequence[str] = ()) -> DataFrame:
    """Unit-length rows ``(key, term, w, ...)``.  A document without a known term has no row.

    ``group`` names columns that, together with ``key``, identify a document.
    """
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key, *group)))
    return raw_weights(counts, vocab, cfg).withColumn("w", F.col("raw") / norm).drop("raw", "idf", "tf")


def feature_size_sweep(counts: DataFrame, vocab: DataFrame, key: str, sizes: Sequence[int],
                       cfg: TfidfConfig = TfidfConfig(), group: Sequence[str] = ()) -> DataFrame:
    """TF-IDF for several vocabulary sizes in one pass: ``(size, key, term, w)``.

    The vocabularies are nested, so only the row norm differs between sizes.
    """
    raw = raw_weights(counts, vocab, cfg)
    square = F.col("raw") * F.col("raw")
    rows = Window.partitionBy(key, *group)
    norms = F.array(*[
        F.struct(F.lit(s).alias("size"), F.sum(F.when(F.col("rank") <= s, square)).over(rows).alias("square"))
        for s in sorted(sizes, reverse=True)
    ])
    keep = [c for c in counts.columns if c not in (key, "term", "tf")]
    return (
        raw.withColumn("_norms", norms)
        .withColumn("_at", F.explode("_norms"))
        .where(F.col("rank") <= F.col("_at.size"))
        .select(F.col("_at.size").alias("size"), key, *keep, "term", "rank",
                (F.col("raw") / F.sqrt("_at.square")).alias("w"))
    )


def sparse_rows(weights: DataFrame, docs: DataFrame, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: sorted feature positions ``idx`` (0 is the most frequent term) and weights ``w``.

    Documents without a known term get empty arrays.
    """
    packed = (
        weights.groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct((F.col("rank") - 1).cast("int").alias("i"), "w"))).alias("_row"))
    )
    return docs.select(key, *keep).join(packed, key, "left").select(
        key, *keep,
        F.coalesce(F.col("_row.i"), F.array().cast("array<int>")).alias("idx"),
        F.coalesce(F.col("_row.w"), F.array().cast("array<double>")).alias("w"),
    )
