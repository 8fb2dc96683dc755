"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns the documents it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark.llm import decontaminate, mixing, pii, simhash, toxicity
from lexispark.llm.common import table
from lexispark.session import fits_broadcast, materialize

TOXIC = 0.5
TOXIC_FOLDS = 5
SHARES = {"de": 0.2, "en": 0.4, "es": 0.2, "fr": 0.2}


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores below ``TOXIC``; it learns from the labels outside fold 0 of 5."""
    network = toxicity.trained(docs, table(spark, sf_dir, "labels"), 0, TOXIC_FOLDS)
    rows = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    scored = toxicity.scores(docs, network, carried={"row": rows}, text_in=True)
    return scored.where(F.col("score") < TOXIC).select("row.*")


def _without(docs: DataFrame, keys: DataFrame, key: F.Column) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not in ``keys(_key)``; a small side is sent to all tasks."""
    side = F.broadcast(keys) if fits_broadcast(keys) else keys
    return docs.withColumn("_key", key).join(side, "_key", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id.

    Five-word shingles and a similarity of 0.8.  It is decided by id and text: of repeated rows one stays, of an id
    with different texts those that are no near copies stay.  Rows with a null id stay.
    """
    groups = materialize(simhash.similar_documents(docs), "groups")
    known = groups.where("id is not null").withColumn("_key", F.struct("id", "digest"))
    gone = materialize(known.where("component < id or digest <> first").select("_key").distinct(), "near-copies")
    key = F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("digest"))
    kept = _without(docs, gone, key)
    again = known.where("component = id and digest = first").groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    again = materialize(again.where("n > 1").select("_key"), "repeated-rows")
    if not again.take(1):
        return kept
    side = F.broadcast(again) if fits_broadcast(again) else again
    once = _without(kept, again, key)
    repeated = kept.withColumn("_key", key).join(side, "_key", "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
    return once.unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    texts = docs.select(F.xxhash64("text").alias("key"), "text")
    held = decontaminate.contaminated(texts, table(spark, sf_dir, "benchmark"), "key")
    held = materialize(held.select(F.col("id").alias("_key")).distinct(), "contaminated")
    return _without(docs, held, F.xxhash64("text"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; ``n_chars`` is that of the new text."""
    redacted = pii.redact(docs)
    return redacted.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in redacted.columns))


def labelled_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of good quality with their language as the domain: at most ``mixing.LABELLED_ROWS`` distinct ones.

    Ids meet the labels without their texts; the few that are chosen, by the hash of domain and text, are then sent to
    the texts.
    """
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    named = docs.select("doc_id", F.col("lang").alias("domain"), F.xxhash64("lang", "text").alias("key")).where("domain is not null and doc_id is not null")
    chosen = named.join(good, "doc_id", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id")).orderBy("key").limit(mixing.LABELLED_ROWS)
    chosen = materialize(chosen.select("doc_id"), "labelled-ids")
    return docs.select("doc_id", "text", F.col("lang").alias("domain")).where("domain is not null").join(F.broadcast(chosen.distinct()), "doc_id", "left_semi")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the rate they are to be read at, so that languages have their target shares of words.

    The rate is this stage's decision; no row is left out.  Nulls, repeated rows and empty tables are as in ``soft_mix``.
    """
    return mixing.soft_mix(docs, labelled_domains(spark, docs, sf_dir), SHARES)
