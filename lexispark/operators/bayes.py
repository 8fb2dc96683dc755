"""Complement naive Bayes in closed form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lexispark.operators.rows import scored_rows, theta_matrix
from lexispark.operators.scoring import linear_scores, predicted


def class_term_sums(weights: DataFrame, classes: Sequence, label: str, by: Sequence[str] = (),
                    feature: str = "term") -> DataFrame:
    """Per term the summed weight of each class, ``counts``, and of all classes, ``total``.

    Partial sums are made before the shuffle, so a frequent term costs one row per task.
    """
    per_class = [F.sum(F.when(F.col(label) == F.lit(c), F.col("w")).otherwise(0.0)) for c in classes]
    return weights.groupBy(*by, feature).agg(F.array(*per_class).alias("counts"), F.sum("w").alias("total"))


def complement_weights(sums: DataFrame, n_classes: int, alpha, norm, by: Sequence[str] = (),
                       feature: str = "term") -> DataFrame:
    """``(by..., feature, theta)`` with ``-log`` of the smoothed share the term has outside each class.

    With ``norm`` each class is divided by the sum of its logarithms instead.  ``alpha`` and ``norm`` are
    values or columns.  The sums over the vocabulary are one row per group and class, so the plan is of the same size
    for any number of classes.
    """
    alpha = F.lit(alpha) if isinstance(alpha, (int, float)) else alpha
    norm = F.lit(norm) if isinstance(norm, bool) else norm
    by = list(by)
    shares = sums.withColumn("_alpha", alpha.cast("double")).withColumn("_norm", norm)
    shares = shares.withColumn("_rest", F.transform("counts", lambda n: F.col("total") + F.col("_alpha") - n))
    # sum over terms of log(rest / S) is sum(log(rest)) - n_terms * log(S): one aggregate gives both
    per_class = shares.select(*by, F.posexplode("_rest").alias("_class", "_r")).groupBy(*by, "_class").agg(
        F.sum("_r").alias("_sum"), F.sum(F.log("_r")).alias("_logs"), F.count("*").alias("_terms"))
    summed = F.col("_logs") - F.col("_terms") * F.log("_sum")
    packed = F.sort_array(F.collect_list(F.struct("_class", F.col("_sum").alias("total"), summed.alias("summed"))))
    totals = per_class.groupBy(*by).agg(packed.alias("_of"))
    joined = shares.join(totals, by) if by else shares.withColumn("_of", totals.scalar())
    theta = F.zip_with("_rest", "_of", lambda r, t: F.when(
        F.col("_norm"), F.log(r / t["total"]) / t["summed"]).otherwise(-F.log(r / t["total"])))
    return joined.select(*by, feature, theta.alias("theta"))


def fit_complement_nb(train_weights: DataFrame, classes: Sequence, label: str, alpha: float = 1.0,
                      norm: bool = False, feature: str = "term") -> DataFrame:
    sums = class_term_sums(train_weights, classes, label, (), feature)
    return complement_weights(sums, len(classes), alpha, norm, (), feature)


def predict_complement_nb(docs: DataFrame, weights: DataFrame, theta: DataFrame, key: str, classes: Sequence,
                          keep: Sequence[str] = (), max_terms: int | None = None, feature: str = "term",
                          out: str = "predicted") -> DataFrame:
    scored = linear_scores(docs, weights, theta, key, len(classes), None, keep, max_terms, feature)
    return scored.select(key, *keep, predicted(F.col("scores"), classes).alias(out))


def predict_rows(rows: DataFrame, theta: DataFrame, key: str, classes: Sequence, n_features: int,
                 keep: Sequence[str] = (), out: str = "predicted") -> DataFrame:
    """The same for rows ``(key, idx, w)``, scored in place; for models that may be sent to the tasks."""
    scored = scored_rows(rows, theta_matrix(theta, n_features, len(classes)), None, (key, *keep))
    return scored.select(key, *keep, predicted(F.col("scores"), classes).alias(out))
