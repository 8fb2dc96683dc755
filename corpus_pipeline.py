"""The corpus pipeline: each stage reads what the one before it kept, as Parquet in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexispark.llm import stages
from lexispark.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.without_toxic),
    ("near_duplicates", stages.without_near_duplicates),
    ("decontamination", stages.without_benchmark),
    ("pii", stages.without_personal_data),
    ("mixing", stages.mixed),
]

#: The first stage is a trained network, which SQL can't express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``: one row per document that is kept, with the rate it is to be read at."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
