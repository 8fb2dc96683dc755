"""Sources and sinks: every table is written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lexispark.operators.cleaning import CleaningConfig, preprocess
from lexispark.operators.encode import encode_labels
from lexispark.operators.profile import class_distribution, top_labels
from lexispark.plans import predict
from lexispark.plans.search import select_best
from lexispark.session import class_values, new_path
from lexispark.sources.cache import CLEANED, cached_cleaning, read_legacy_cache
from lexispark.sources.sinks import best_params_table, write_delimited, write_predictions, write_results
from lexispark.sources.tables import (
    load_train_test, read_delimited, read_keyed_text, read_optional, reload_results,
    require_columns,
)
from lexispark.workload import sql as S
from lexispark.workload.inputs import (
    CLEANING, KEY, LABEL, documents, features, taxonomy, test_documents, train_documents,
)


def _train_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = class_values(documents(spark, sf_dir), LABEL)
    return encode_labels(train_documents(spark, sf_dir), LABEL, classes, "label_id").select(
        F.col(KEY).alias("id"), F.col("text").alias("abstract"), "label_id")


def _test_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return test_documents(spark, sf_dir).select(F.col(KEY).alias("id"), F.col("text").alias("abstract"))


def read_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "tables")
    write_delimited(_train_table(spark, sf_dir), f"{root}/train.csv", "\t")
    write_delimited(_test_table(spark, sf_dir), f"{root}/test.csv", "\t")
    train, test = load_train_test(spark, root)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("label_id", F.lit(None).cast("long")).withColumn("part", F.lit("test")))


def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = require_columns(_train_table(spark, sf_dir), ("id", "abstract", "label_id"), "train")
    return train.select("id", "label_id")


def optional_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "optional")
    write_delimited(_test_table(spark, sf_dir).select("id", F.lit(0).alias("label_id")), f"{root}/sample")
    found = read_optional(spark, f"{root}/sample", "id long, label_id long")
    absent = read_optional(spark, f"{root}/absent", "id long, label_id long")
    return found.withColumn("absent_is_none", F.lit(absent is None))


def read_text_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "abstracts")
    source = documents(spark, sf_dir).select(
        F.col(KEY).alias("id"), F.when(F.col(LABEL) != "es", F.col("text")).alias("abstract"))
    write_delimited(source, path)
    return read_keyed_text(spark, path)


def cleaned_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made, read again, and made anew for another configuration."""
    path, train = new_path(spark, "cache"), _train_table(spark, sf_dir)
    cached_cleaning(train, path, "id", "abstract", ("label_id",), CLEANING)
    again = cached_cleaning(train, path, "id", "abstract", ("label_id",), CLEANING).withColumn("run", F.lit("same"))
    other = CleaningConfig(preset="regex_only", use_lemmatization=False)
    anew = cached_cleaning(train, path, "id", "abstract", ("label_id",), other).withColumn("run", F.lit("changed"))
    return again.unionByName(anew)


def legacy_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "legacy")
    cleaned = preprocess(_train_table(spark, sf_dir), "id", "abstract", CLEANING, out=CLEANED).select(
        "id", "label_id", CLEANED)
    parts = []
    for name, sep in (("tab", "\t"), ("comma", ",")):
        write_delimited(cleaned, f"{root}/{name}", sep)
        parts.append(read_legacy_cache(spark, f"{root}/{name}").withColumn("format", F.lit(name)))
    return parts[0].unionByName(parts[1])


def prediction_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, path = features(spark, sf_dir), new_path(spark, "predictions")
    classes = class_values(documents(spark, sf_dir), LABEL)
    guessed = encode_labels(predict.complement_nb(f), "predicted", classes, "label_id").select(
        F.col(KEY).alias("id"), "label_id")
    write_predictions(guessed, f.test_docs, path, KEY)
    return read_delimited(spark, path, "id long, label_id long", ",")


def result_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "results")
    table = class_distribution(documents(spark, sf_dir), LABEL)
    write_results(table, f"{root}/columns", (LABEL, "n", "percent"))
    write_results(table, f"{root}/text", (LABEL, "n", "percent"), text=True)
    stored = spark.read.parquet(f"{root}/columns").withColumn("format", F.lit("parquet"))
    return stored.unionByName(
        read_delimited(spark, f"{root}/text", f"{LABEL} string, n long, percent double", ",").withColumn(
            "format", F.lit("text")))


def renamed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "old-results")
    old = class_distribution(documents(spark, sf_dir), LABEL).withColumnRenamed("n", "candidate_rank_stage1")
    write_results(old, path, ("candidate_rank_stage1",), text=True)
    return reload_results(
        read_delimited(spark, path, f"{LABEL} string, candidate_rank_stage1 long, percent double", ","))


def best_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent label as the parameter set of the best result."""
    path = new_path(spark, "best")
    scored = top_labels(documents(spark, sf_dir), LABEL, taxonomy(spark, sf_dir)).select(
        F.dense_rank().over(Window.orderBy(LABEL)).alias("candidate"),
        F.col(LABEL).alias("param"), F.col("percent").alias("mean_macro_f1"))
    write_results(best_params_table(select_best(scored, None, ["param"]), ["param"]), path)
    return spark.read.parquet(path)


QUERIES = {
    "a1_read_train_test": read_train_test,
    "a2_required_columns": required_columns,
    "a3_optional_table": optional_table,
    "a4_read_text_columns": read_text_columns,
    "a5_cleaned_cache": cleaned_cache,
    "a6_legacy_cache": legacy_cache,
    "a7_prediction_file": prediction_file,
    "a8_result_tables": result_tables,
    "a9_renamed_results": renamed_results,
    "a10_best_params": best_row,
}

LABEL_IDS = "label_ids AS (SELECT lang, (row_number() OVER (ORDER BY lang) - 1)::BIGINT AS label_id FROM (SELECT DISTINCT lang FROM documents))"
DISTRIBUTION = """dist AS (
  SELECT lang, n, round(n * 100.0::DOUBLE / (SELECT count(*) FROM documents), 2) AS percent
  FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1))"""

SQL = {
    "a1_read_train_test": f"""WITH {LABEL_IDS}
SELECT d.doc_id AS id, d.text AS abstract, CASE WHEN l.doc_id IS NOT NULL THEN i.label_id END AS label_id,
       CASE WHEN l.doc_id IS NOT NULL THEN 'train' ELSE 'test' END AS part
FROM documents d JOIN label_ids i USING (lang) LEFT JOIN labels l USING (doc_id)""",
    "a2_required_columns": f"""WITH {LABEL_IDS}
SELECT d.doc_id AS id, label_id FROM documents d JOIN labels l USING (doc_id) JOIN label_ids USING (lang)""",
    "a3_optional_table": """SELECT doc_id AS id, 0::BIGINT AS label_id, true AS absent_is_none
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "a4_read_text_columns": """SELECT doc_id AS id, CASE WHEN lang = 'es' THEN '' ELSE text END AS abstract
FROM documents""",
    "a5_cleaned_cache": f"""WITH {LABEL_IDS},
t AS (SELECT d.doc_id AS id, label_id, text FROM documents d JOIN labels l USING (doc_id) JOIN label_ids USING (lang))
SELECT id, label_id, {S.full('text')} AS cleaned_abstract, 'same' AS run FROM t
UNION ALL SELECT id, label_id, {S.cleaned('text')}, 'changed' FROM t""",
    "a6_legacy_cache": f"""WITH {LABEL_IDS},
t AS (SELECT d.doc_id AS id, label_id, text FROM documents d JOIN labels l USING (doc_id) JOIN label_ids USING (lang))
SELECT id, label_id, {S.full('text')} AS cleaned_abstract, unnest(['tab', 'comma']) AS format FROM t""",
    "a7_prediction_file": f"""WITH {LABEL_IDS}, {S.tfidf()}, {S.complement_nb(1.0, False)}
SELECT doc_id AS id, label_id FROM guessed JOIN label_ids ON label_ids.lang = predicted""",
    "a8_result_tables": f"WITH {DISTRIBUTION} SELECT *, unnest(['parquet', 'text']) AS format FROM dist",
    "a9_renamed_results": f"WITH {DISTRIBUTION} SELECT lang, n AS candidate_rank_tuning, percent FROM dist",
    "a10_best_params": f"WITH {DISTRIBUTION} SELECT lang AS param FROM dist ORDER BY n DESC, lang LIMIT 1",
}
