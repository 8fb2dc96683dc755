"""Numeric expressions shared by the models and the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

PROBABILITY_CLIP = 1e-15


def rounded(x: Column, digits: int = 6) -> Column:
    """Rounded value with -0.0 turned into 0.0."""
    r = F.round(x, digits)
    return F.when(r == 0.0, F.lit(0.0)).otherwise(r)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def binary_log_loss(y: Column, p: Column) -> Column:
    """Cross-entropy of one row; average it for the loss of a table."""
    q = F.least(F.greatest(p, F.lit(PROBABILITY_CLIP)), F.lit(1.0 - PROBABILITY_CLIP))
    return -(y * F.log(q) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - q))


def l2_normalized(vector: Column) -> Column:
    """Array scaled to unit length; a zero array stays as it is."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.when(norm > 0, F.transform(vector, lambda x: x.cast("double") / norm)).otherwise(
        F.transform(vector, lambda x: x.cast("double"))
    )


def narrowed(vector: Column) -> Column:
    return vector.cast("array<float>")


def weighted_sums(weight: Column, per_class: Column, n_classes: int) -> Column:
    """Aggregate: the array of ``sum(weight * per_class[c])`` over all classes."""
    return F.array(*[F.sum(weight * per_class[c]) for c in range(n_classes)])


def argmax(scores: Column, digits: int = 9) -> Column:
    """Zero-based position of the largest score; the first one wins ties."""
    r = F.transform(scores, lambda s: F.round(s, digits))
    return (F.array_position(r, F.array_max(r)) - 1).cast("long")


def literal_array(values: Sequence) -> Column:
    return F.array(*[F.lit(v) for v in values])
