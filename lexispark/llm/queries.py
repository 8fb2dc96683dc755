"""The registered queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexispark.llm import decontaminate, extraction, filters, language, lm, mixing, pii, quality, simhash, spelling, stages, tokens, toxicity, vectors
from lexispark.llm.common import crc_fold, table

#: The fold, of 4 or (language model) 7, that is not learnt from.
HELD_OUT = 2
#: File name of the vocabulary whose pieces the language model is over.
LM_VOCABULARY = "piece_bpe_32k.model"


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, logs = language.fit(docs.where(crc_fold("doc_id", 4) != HELD_OUT))
    found = language.identify(docs, langs, logs, carried={"held_out": crc_fold("doc_id", 4) == HELD_OUT})
    return found.select(F.col("id").alias("doc_id"), "held_out", "lang_pred", "score", "languages", "proportions")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "fingerprint", F.col("component").alias("component_id"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.soft_mix(docs, stages.labelled_domains(spark, docs, sf_dir), stages.SHARES, keep=["doc_id", "source"])


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scorer = quality.train(docs, table(spark, sf_dir, "labels"), HELD_OUT, 4)
    found = quality.scores(docs, scorer, carried={"held_out": crc_fold("doc_id", 4) == HELD_OUT})
    return found.select(F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [k.name for k in pii.BASE]
    found = found.withColumn("base", F.filter("spans", lambda s: s["kind"].isin(base)))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, base), F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_text(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = toxicity.trained(docs, table(spark, sf_dir, "labels"), 0, stages.TOXIC_FOLDS)
    held_out = crc_fold("doc_id", stages.TOXIC_FOLDS) == 0
    found = toxicity.scores(docs, network, carried={"held_out": held_out})
    return found.select(F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= stages.TOXIC).cast("int").alias("predicted"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.interaction_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    held_out = crc_fold("doc_id", 7) == HELD_OUT
    model = lm.train(docs.where(~held_out), lm.Vocabulary.load(public_tokenizers.path(LM_VOCABULARY)))
    return lm.scores(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_language, op2_simhash, op3_mixing, op4_quality, op5_embedding_dedup, op6_token_counts, op7_pii, op8_decontamination, op9_html_text, op10_toxicity,
        op11_filter_audit, op12_spelling_variants, op13_lm_scoring,
    )
    return {f.__name__: f for f in found}
