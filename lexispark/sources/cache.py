"""Cleaned-text cache: Parquet next to the configuration it was made with."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark.operators.cleaning import CleaningConfig, preprocess
from lexispark.sources.tables import path_exists, read_delimited, require_columns, sniff_separator

CLEANED = "cleaned_abstract"


def _current(spark: SparkSession, path: str, made_with: str) -> DataFrame | None:
    """Stored table if it was made with this configuration from this input.

    The pointer file names configuration and data folder.  It is written after the data,
    so it never refers to an unfinished table.
    """
    pointer = f"{path}/current"
    if not path_exists(spark, pointer):
        return None
    rows = spark.read.json(pointer, schema="config string, data string").limit(1).collect()
    if not rows or rows[0]["config"] != made_with:
        return None
    return spark.read.parquet(rows[0]["data"])


def _input_mark(df: DataFrame, columns: list[str]) -> str:
    """Number of rows and the sum of their hashes: differs when rows were added or dropped, or a kept column changed."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h")).first()
    return f"{row['n']}:{row['h']}"


def cached_cleaning(df: DataFrame, path: str, key: str, text: str, keep: tuple[str, ...] = (),
                    cfg: CleaningConfig = CleaningConfig(use_lemmatization=False), lemmas: DataFrame | None = None,
                    use_cache: bool = True, refresh: bool = False) -> DataFrame:
    """``(key, keep..., cleaned_abstract)`` from the cache if it was made with the same
    configuration from the same rows, else cleaned anew and stored.  Rows are compared by key and kept columns, without
    reading the texts: after texts were edited under their old keys, ask for ``refresh``.  The raw text is dropped."""
    spark = df.sparkSession
    columns = [key, *keep, CLEANED]
    made_with = f"{cfg.fingerprint()} {_input_mark(df, [key, *keep])}" if use_cache else ""
    if use_cache and not refresh:
        cached = _current(spark, path, made_with)
        if cached is not None and set(columns) <= set(cached.columns):
            return cached.select(*columns)
    cleaned = preprocess(df, key, text, cfg, lemmas, CLEANED).select(*columns)
    if not use_cache:
        return cleaned
    data = f"{path}/data-{uuid.uuid4().hex}"
    cleaned.write.parquet(data)
    pointer = spark.createDataFrame([(made_with, data)], "config string, data string")
    pointer.coalesce(1).write.mode("overwrite").json(f"{path}/current")
    return spark.read.parquet(data)


def read_legacy_cache(spark: SparkSession, path: str, with_label: bool = True) -> DataFrame:
    """Cache in the older text formats, tab or comma separated.  Missing text counts as empty."""
    found = read_delimited(spark, path, sep=sniff_separator(spark, path))
    columns = ["id", *(["label_id"] if with_label else []), CLEANED]
    require_columns(found, columns, path)
    return found.select(
        *[F.col(c).cast("long").alias(c) for c in columns[:-1]], F.coalesce(CLEANED, F.lit("")).alias(CLEANED)
    )
