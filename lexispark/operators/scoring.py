"""Scores of linear models: per document the sum of term weight times class weight."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lexispark.functions.arithmetic import argmax, literal_array, weighted_sums
from lexispark.operators.ranking import lookup_join
from lexispark.session import BROADCAST_CELLS


def linear_scores(docs: DataFrame, weights: DataFrame, theta: DataFrame, key: str, n_classes: int,
                  bias: Sequence[float] | None = None, keep: Sequence[str] = (), max_terms: int | None = None,
                  feature: str = "term") -> DataFrame:
    """``(key, keep..., scores)`` with one array position per class.

    ``theta(feature, theta)`` holds the class weights of a term as an array, so a matched
    term adds to all classes at once.  A document without a known term gets the bias.
    """
    summed = (
        lookup_join(weights, theta.select(feature, "theta"), [feature], [key],
                    max_terms is not None and max_terms * n_classes <= BROADCAST_CELLS)
        .groupBy(key)
        .agg(weighted_sums(F.col("w"), F.col("theta"), n_classes).alias("_sum"))
    )
    start = literal_array([float(b) for b in bias]) if bias is not None else F.array(*[F.lit(0.0)] * n_classes)
    return docs.select(key, *keep).join(summed, key, "left").select(
        key, *keep,
        F.when(F.col("_sum").isNull(), start)
        .otherwise(F.zip_with("_sum", start, lambda s, b: s + b)).alias("scores"),
    )


def predicted(scores: Column, classes: Sequence) -> Column:
    """Label of the largest score; ties go to the first class."""
    return literal_array(classes)[argmax(scores).cast("int")]
