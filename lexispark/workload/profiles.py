"""Profiles of the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark.functions.arithmetic import rounded
from lexispark.operators import profile as P
from lexispark.workload import sql as S
from lexispark.workload.inputs import KEY, LABEL, SEED, documents, table, taxonomy, test_documents, train_documents


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.table_shape({"train": train_documents(spark, sf_dir), "test": test_documents(spark, sf_dir)})


def missing_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels joined to all documents, so that there are missing cells."""
    return P.null_cells(documents(spark, sf_dir).select(KEY, LABEL, "text").join(
        table(spark, sf_dir, "labels"), KEY, "left"))


def n_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.distinct_labels(documents(spark, sf_dir), LABEL)


def distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.class_distribution(documents(spark, sf_dir), LABEL)


def named_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = P.with_taxonomy(P.class_distribution(documents(spark, sf_dir), LABEL), taxonomy(spark, sf_dir), LABEL)
    return named.orderBy(F.desc("n"), LABEL)


def frequent_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest sources, named by the taxonomy of labels where a name fits."""
    docs = documents(spark, sf_dir).select(F.concat_ws("-", LABEL, "source").alias("label_id"))
    names = taxonomy(spark, sf_dir).select(F.concat(LABEL, F.lit("-src0")).alias("label_id"), "category")
    return P.top_labels(docs, "label_id", names, 20)


def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.text_lengths(documents(spark, sf_dir), KEY, "text")


def length_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = P.numeric_summary(lengths(spark, sf_dir), ["n_chars", "n_words"])
    return summary.select("column_name", "count", *[
        rounded(F.col(c)).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = P.histogram(lengths(spark, sf_dir), "n_words", 40)
    return h.select("bin", rounded(F.col("bin_start")).alias("bin_start"), rounded(F.col("bin_end")).alias("bin_end"), "n")


def sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.sample_rows(documents(spark, sf_dir).select(KEY, LABEL, "text"), KEY, 10, SEED)
    return P.with_taxonomy(rows, taxonomy(spark, sf_dir), LABEL)


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.preview(documents(spark, sf_dir).select(KEY, LABEL, "text"), KEY, 5)


QUERIES = {
    "b1_table_shape": shapes,
    "b2_null_cells": missing_cells,
    "b3_distinct_labels": n_classes,
    "b4_class_distribution": distribution,
    "b5_distribution_with_taxonomy": named_distribution,
    "b6_top_labels": frequent_labels,
    "b7_text_lengths": lengths,
    "b8_length_summary": length_summary,
    "b9_length_histogram": length_histogram,
    "b10_random_sample": sampled,
    "b11_preview": first_rows,
}

DIST = """SELECT lang, n, round(n * 100.0::DOUBLE / (SELECT count(*) FROM documents), 2) AS percent
  FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1)"""
TAX = "SELECT DISTINCT lang, upper(lang) || ' texts' AS category FROM documents WHERE lang <> 'es'"
SPLIT = f"string_split({S.collapsed('text')}, ' ')"
LENGTHS = f"""SELECT doc_id, length(text)::BIGINT AS n_chars,
  (CASE WHEN {S.collapsed('text')} = '' THEN 0 ELSE len({SPLIT}) END)::BIGINT AS n_words FROM documents"""


def _summary(column: str) -> str:
    q = f"quantile_cont({column}, [0.25, 0.5, 0.75])"
    values = (f"avg({column})", f"stddev_samp({column})", f"min({column})", f"{q}[1]", f"{q}[2]", f"{q}[3]", f"max({column})")
    names = ("mean", "std", "min", "q25", "q50", "q75", "max")
    return (f"SELECT '{column}' AS column_name, count(*) AS count, "
            + ", ".join(f"{S.r6(f'{v}::DOUBLE')} AS {n}" for v, n in zip(values, names)) + " FROM lengths")


SQL = {
    "b1_table_shape": """SELECT 'train' AS table_name, count(*) AS n_rows, 5::BIGINT AS n_columns
FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'test', count(*), 5::BIGINT FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "b2_null_cells": """SELECT count(*) FILTER (d.doc_id IS NULL) AS null_doc_id, count(*) FILTER (lang IS NULL) AS null_lang,
  count(*) FILTER (text IS NULL) AS null_text, count(*) FILTER (quality IS NULL) AS null_quality,
  count(*) FILTER (toxic IS NULL) AS null_toxic,
  (count(*) * 5 - count(d.doc_id) - count(lang) - count(text) - count(quality) - count(toxic))::BIGINT AS null_total
FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "b3_distinct_labels": "SELECT count(DISTINCT lang) AS n_classes FROM documents",
    "b4_class_distribution": DIST,
    "b5_distribution_with_taxonomy": f"SELECT * FROM ({DIST}) LEFT JOIN ({TAX}) USING (lang)",
    "b6_top_labels": f"""WITH t AS (SELECT lang || '-' || source AS label_id, count(*) AS n FROM documents GROUP BY 1)
SELECT label_id, n, round(n * 100.0::DOUBLE / (SELECT sum(n) FROM t), 2) AS percent, coalesce(category, 'Unknown') AS category
FROM (SELECT * FROM t ORDER BY n DESC, label_id LIMIT 20)
LEFT JOIN (SELECT lang || '-src0' AS label_id, category FROM ({TAX})) USING (label_id)""",
    "b7_text_lengths": LENGTHS,
    "b8_length_summary": f"WITH lengths AS ({LENGTHS}) {_summary('n_chars')} UNION ALL {_summary('n_words')}",
    "b9_length_histogram": f"""WITH lengths AS ({LENGTHS}),
b AS (SELECT min(n_words)::DOUBLE AS lo, max(n_words)::DOUBLE AS hi FROM lengths),
c AS (SELECT least(floor((n_words - lo) / ((hi - lo) / 40)), 39)::BIGINT AS bin, count(*) AS n FROM lengths, b GROUP BY 1)
SELECT r.bin, {S.r6('lo + r.bin * (hi - lo) / 40')} AS bin_start, {S.r6('lo + (r.bin + 1) * (hi - lo) / 40')} AS bin_end,
       coalesce(n, 0)::BIGINT AS n
FROM (SELECT unnest(range(40)) AS bin) r CROSS JOIN b LEFT JOIN c USING (bin)""",
    "b10_random_sample": f"""SELECT * FROM (
  SELECT doc_id, lang, text FROM documents ORDER BY md5('{SEED}|' || doc_id), doc_id LIMIT 10) LEFT JOIN ({TAX}) USING (lang)""",
    "b11_preview": "SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 5",
}
