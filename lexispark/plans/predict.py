"""Fit on a training table, predict a test table: one function per model family.

Each returns ``(key, predicted)`` for every test row, so ``as_prediction_file`` and the sink
can take any of them.  ``train`` and ``test`` hold cleaned text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lexispark.operators import bayes, knn, linear, reduce as svd, svm, trees
from lexispark.operators.rows import truncated
from lexispark.plans.features import TextFeatures
from lexispark.session import BROADCAST_CELLS, class_values, materialize


def as_prediction_file(predicted: DataFrame, key: str) -> DataFrame:
    return predicted.select(F.col(key).alias("id"), F.col("predicted").alias("label_id"))


def complement_nb(f: TextFeatures, alpha: float = 1.0, norm: bool = False) -> DataFrame:
    classes = class_values(f.train_docs, f.label)
    theta = bayes.fit_complement_nb(f.train_weights, classes, f.label, alpha, norm, "rank")
    if f.cfg.max_features is not None and f.cfg.max_features * len(classes) <= BROADCAST_CELLS:
        return bayes.predict_rows(f.test_rows(), theta, f.key, classes, f.cfg.max_features, (f.label,))
    return bayes.predict_complement_nb(f.test_docs, f.test_weights, theta, f.key, classes, (f.label,),
                                       f.cfg.max_features, "rank")


def logistic_sgd(f: TextFeatures, cfg: linear.SgdConfig = linear.SgdConfig()) -> DataFrame:
    model = linear.fit_ovr(f.train_rows(), f.key, f.label, f.n_features, cfg)
    return linear.predict_rows(model, f.test_rows(), f.key, (f.label,))


def logistic_sgd_by_size(fs: Sequence[TextFeatures], sizes: Sequence[int], cfg: linear.SgdConfig = linear.SgdConfig()) -> list[DataFrame]:
    """For each features ``(size, key, label, predicted)`` of several vocabulary sizes; all models are trained together."""
    sized = [[with_max_features(f, size) for size in sizes] for f in fs]
    f = fs[0]
    models = iter(linear.fit_ovr_together([(s.train_rows(), s.n_features) for some in sized for s in some], f.key, f.label, cfg))
    guessed = [[linear.predict_rows(next(models), s.test_rows(), s.key, (s.label,)).withColumn("size", F.lit(size))
                for s, size in zip(some, sizes)] for some in sized]
    return [reduce(DataFrame.unionByName, parts) for parts in guessed]


def logistic_mllib(f: TextFeatures, c: float = 1.0, max_iter: int = 100) -> DataFrame:
    model = linear.fit_ovr_mllib(linear.ml_vectors(f.train_rows(), f.n_features), f.label, "logistic", c, max_iter)
    return linear.predict_rows(model, f.test_rows(), f.key, (f.label,))


def linear_svm(f: TextFeatures, c: float = 1.0, max_iter: int = 100, squared_hinge: bool = False, newton: bool = False) -> DataFrame:
    """Hinge loss by MLlib, squared hinge by gradient steps, or squared hinge at its optimum (``newton``)."""
    if newton:
        # positions beyond the terms that were found would be empty
        model = svm.fit_svm(f.train_rows(), f.key, f.label, max(1, f.vocab.count()), c, max_steps=max_iter)
    elif squared_hinge:
        model = linear.fit_squared_hinge_svm(f.train_rows(), f.key, f.label, f.n_features, c, epochs=max_iter)
    else:
        model = linear.fit_ovr_mllib(linear.ml_vectors(f.train_rows(), f.n_features), f.label, "svc", c, max_iter)
    return linear.predict_rows(model, f.test_rows(), f.key, (f.label,))


def random_forest(f: TextFeatures, cfg: trees.ForestConfig = trees.ForestConfig()) -> DataFrame:
    model = trees.fit_random_forest(linear.ml_vectors(f.train_rows(), f.n_features), f.label, cfg)
    return model.predict(linear.ml_vectors(f.test_rows(), f.n_features), f.key, (f.label,))


def boosted_trees(f: TextFeatures, cfg: trees.BoostingConfig = trees.BoostingConfig()) -> DataFrame:
    model = trees.fit_boosted_trees(linear.ml_vectors(f.train_rows(), f.n_features), f.label, cfg)
    return model.predict(linear.ml_vectors(f.test_rows(), f.n_features), f.key, (f.label,))


def nearest_neighbours(f: TextFeatures, k: int = 2, weighting: str = "distance") -> DataFrame:
    return knn.knn_predict(f.train_rows(), f.test_rows(), f.key, f.label, f.n_features, k, weighting, (f.label,))


def nearest_neighbours_by_size(f: TextFeatures, sizes: Sequence[int], k: int = 2) -> DataFrame:
    """``(size, key, label, predicted)`` for several vocabulary sizes; the rows are cut to each size in place."""
    parts = []
    for size in sizes:
        train, test = truncated(f.train_rows(), size), truncated(f.test_rows(), size)
        found = knn.knn_predict(train, test, f.key, f.label, size, k, keep=(f.label,))
        parts.append(found.select(F.lit(size).alias("size"), *found.columns))
    return reduce(DataFrame.unionByName, parts)


def _reduced(f: TextFeatures, k: int, n_iter: int, seed: int) -> tuple[DataFrame, DataFrame]:
    train, test = f.train_rows(), f.test_rows()
    model = svd.truncated_svd(train, f.n_features, k, n_iter, seed)
    # single precision, then unit length
    sides = []
    for rows in (train, test):
        projected = model.project(rows, f.key, (f.label,))
        sides.append(knn.dense_rows(projected.withColumn("vector", F.col("vector").cast("array<float>")), "vector"))
    return sides[0], sides[1]


def nearest_neighbours_svd(f: TextFeatures, components: int, k: int = 2, n_iter: int = 7, seed: int = 42) -> DataFrame:
    train, test = _reduced(f, components, n_iter, seed)
    return knn.knn_predict(train, test, f.key, f.label, components, k, keep=(f.label,))


def svd_logistic(f: TextFeatures, components: int = 100, c: float = 1.0, balanced: bool = False, n_iter: int = 7,
                 seed: int = 42) -> DataFrame:
    """Multinomial logistic regression on unit-length SVD coordinates."""
    train, test = _reduced(f, components, n_iter, seed)
    model = linear.fit_multinomial(linear.ml_vectors(train, components), f.label, c, balanced)
    return linear.predict_rows(model, test, f.key, (f.label,))


def with_max_features(f: TextFeatures, size: int) -> TextFeatures:
    """The same features with a smaller vocabulary; the rows are cut and get new norms."""
    return replace(f, cfg=replace(f.cfg, max_features=size), vocab=f.vocab.where(F.col("rank") <= size),
                   rows=materialize(truncated(f.rows, size), "rows"))
