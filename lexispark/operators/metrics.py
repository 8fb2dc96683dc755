"""Accuracy, macro F1, confusion counts and fold summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def confusion(df: DataFrame, truth: str, guess: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (truth, prediction).  All other metrics start from this small table."""
    return df.groupBy(*by, F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(F.count("*").alias("n"))


def label_scores(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per label of truth or prediction: hits, support, predictions, F1 (0 where undefined)."""
    hit = F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("actual"), zero.alias("guessed"), hit.alias("tp")),
        F.struct(F.col("guess").alias("label"), zero.alias("actual"), F.col("n").alias("guessed"), zero.alias("tp")),
    )
    return (
        pairs.select(*by, F.explode(sides).alias("s"))
        .groupBy(*by, F.col("s.label").alias("label"))
        .agg(F.sum("s.tp").alias("tp"), F.sum("s.actual").alias("actual"), F.sum("s.guessed").alias("guessed"))
        .withColumn("f1", F.when(F.col("tp") == 0, F.lit(0.0))
                    .otherwise(2.0 * F.col("tp") / (F.col("actual") + F.col("guessed"))))
    )


def evaluate(df: DataFrame, truth: str, guess: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., n, accuracy, macro_f1)`` from a single pass over the predictions."""
    return evaluate_pairs(confusion(df, truth, guess, by), by)


def evaluate_pairs(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same from the rows per (truth, prediction)."""
    return label_scores(pairs, by).groupBy(*by).agg(
        F.sum("actual").alias("n"),
        (F.sum("tp") / F.sum("actual").cast("double")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
    )


def accuracy(df: DataFrame, truth: str, guess: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((F.col(truth) == F.col(guess)).cast("double")).alias("accuracy"))


def macro_f1(df: DataFrame, truth: str, guess: str, by: Sequence[str] = ()) -> DataFrame:
    return evaluate(df, truth, guess, by).select(*by, "macro_f1")


def summarize_folds(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation over the folds."""
    return scores.groupBy(*by).agg(
        F.avg("macro_f1").alias("mean_macro_f1"),
        F.stddev_pop("macro_f1").alias("std_macro_f1"),
        F.avg("accuracy").alias("mean_accuracy"),
        F.stddev_pop("accuracy").alias("std_accuracy"),
    )
