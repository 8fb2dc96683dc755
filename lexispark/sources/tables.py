"""Table readers with fixed schemas and column contracts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

TRAIN_SCHEMA = "id long, abstract string, label_id long"
TEST_SCHEMA = "id long, abstract string"
TAXONOMY_SCHEMA = "label_id long, category string"


def require_columns(df: DataFrame, required: Iterable[str], name: str = "table") -> DataFrame:
    """Schema check only; no job runs."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{name} lacks the columns {missing}")
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Resolve the path without reading it."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_delimited(spark: SparkSession, path: str, schema: str | None = None, sep: str = "\t",
                   multi_line: bool = True) -> DataFrame:
    """Text table with a header; ``path`` is a file or a folder of files.

    Quoted fields may hold separators and quotes, and with ``multi_line`` line breaks.  Then one task reads a whole
    file; a large table without line breaks in its fields should be read without, so that its files are split.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    reader = (
        spark.read.option("sep", sep).option("header", True).option("multiLine", multi_line)
        .option("quote", '"').option("escape", '"').option("enforceSchema", False)
    )
    if schema is None:
        return reader.csv(path)
    # the header decides the order of columns, the schema their types
    found = reader.csv(path)
    wanted = _struct(spark, schema)
    require_columns(found, wanted.fieldNames(), path)
    typed = {f.name: f.dataType for f in wanted.fields}
    return found.select(*[F.col(f).cast(typed[f]).alias(f) for f in wanted.fieldNames()])


def _struct(spark: SparkSession, schema: str):
    return spark.createDataFrame([], schema).schema


def read_optional(spark: SparkSession, path: str, schema: str | None = None, sep: str = ",") -> DataFrame | None:
    return read_delimited(spark, path, schema, sep) if path_exists(spark, path) else None


def load_train_test(spark: SparkSession, root: str, sep: str = "\t") -> tuple[DataFrame, DataFrame]:
    """``train.csv`` and ``test.csv`` under ``root``."""
    return (
        read_delimited(spark, f"{root}/train.csv", TRAIN_SCHEMA, sep),
        read_delimited(spark, f"{root}/test.csv", TEST_SCHEMA, sep),
    )


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """``(label_id, category)``; other columns of the file are not read."""
    return read_delimited(spark, path, TAXONOMY_SCHEMA)


def read_keyed_text(spark: SparkSession, path: str, key: str = "id", text: str = "abstract") -> DataFrame:
    """Comma-separated text table; missing text counts as empty.  The key stays, so that text,
    labels and ids can be joined and never depend on row positions."""
    df = require_columns(read_delimited(spark, path, sep=","), (key, text), path)
    return df.select(F.col(key).cast("long").alias(key), F.coalesce(text, F.lit("")).alias(text))


def sniff_separator(spark: SparkSession, path: str) -> str:
    """Tab if the header line holds one, else comma."""
    header = spark.read.text(path).limit(1).collect()
    return "\t" if header and "\t" in header[0][0] else ","


def reload_results(df: DataFrame, old: str = "candidate_rank_stage1", new: str = "candidate_rank_tuning") -> DataFrame:
    """Result table with an outdated column name brought up to date."""
    return df.withColumnRenamed(old, new) if old in df.columns and new not in df.columns else df
