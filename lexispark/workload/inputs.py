"""The given tables in the roles the classifiers need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexispark.functions import text as T
from lexispark.operators.cleaning import CleaningConfig
from lexispark.operators.vocabulary import TfidfConfig
from lexispark.plans.features import IS_TRAIN, TextFeatures, split_features
from lexispark.session import spread

KEY, LABEL = "doc_id", "lang"
SEED = 42
# The shipped cleaner without the noun dictionary, which is an input of its own.
CLEANING = CleaningConfig(use_lemmatization=False)
MAX_FEATURES = 2000
TFIDF = TfidfConfig(max_features=MAX_FEATURES)
# Added to every document so that each cleaning rule has something to remove.
LATEX_PARTS = (
    " see \\textbf{", "} at https://x.org/", "?a=1 or www.x.org/", " as in [1, ",
    "] and \\begin{eq} $a_{", "}$ \\end{eq} \\[ b \\] \\( c \\) \\alpha real-world snake_case -x- cost $5 and $6 left ",
    "\\cite[p. 3]{a}{b} \\emph*{c} end",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, label and text, with the regular expressions spread over all cores."""
    return spread(documents(spark, sf_dir).select(KEY, LABEL, "text"), KEY)


def train_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an entry in ``labels``."""
    return documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), KEY, "left_semi")


def train_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).join(table(spark, sf_dir, "labels"), KEY, "left_semi")


def test_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), KEY, "left_anti")


def quality_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with the binary, imbalanced label ``quality``."""
    return documents(spark, sf_dir).join(table(spark, sf_dir, "labels").select(KEY, "quality"), KEY)


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category of each label; ``es`` is left out, so that one label has none."""
    return documents(spark, sf_dir).select(LABEL).distinct().where("lang <> 'es'").select(
        LABEL, F.concat(F.upper(LABEL), F.lit(" texts")).alias("category"))


def latex_text() -> Column:
    d, n = F.col(KEY).cast("string"), F.col("n_chars").cast("string")
    p = [F.lit(x) for x in LATEX_PARTS]
    return F.concat("text", p[0], F.upper(LABEL), p[1], d, p[2], d, p[3], n, p[4], d, p[5], p[6])


def latex_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(documents(spark, sf_dir), KEY).select(KEY, latex_text().alias("text"))


def features(spark: SparkSession, sf_dir: str, cfg: TfidfConfig = TFIDF) -> TextFeatures:
    known = table(spark, sf_dir, "labels").select(KEY, F.lit(True).alias("_known")).distinct()
    both = texts(spark, sf_dir).join(known, KEY, "left").select(KEY, LABEL, "text", F.col("_known").isNotNull().alias(IS_TRAIN))
    return split_features(both, KEY, "text", LABEL, cfg, CLEANING)


def cleaned_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexispark.operators.cleaning import preprocess
    from lexispark.operators.vocabulary import by_document

    return preprocess(by_document(train_documents(spark, sf_dir).select(KEY, LABEL, "text"), KEY), KEY, "text",
                      CLEANING).drop("text")


def vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Embeddings, split by whether ``labels`` has an entry of the same number."""
    from lexispark.operators.knn import dense_rows

    rows = dense_rows(spread(table(spark, sf_dir, "embeddings"), "vec_id"), "embedding").select("vec_id", "label", "idx", "w")
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("vec_id"))
    return rows.join(known, "vec_id", "left_semi"), rows.join(known, "vec_id", "left_anti")


STOP_WORDS = T.ENGLISH_STOP_WORDS
