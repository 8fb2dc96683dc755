"""Cross-validation over a fold column."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lexispark.operators.metrics import evaluate
from lexispark.session import materialize

# (training rows, validation rows) -> predictions with the columns truth label and "predicted"
FitPredict = Callable[[DataFrame, DataFrame], DataFrame]


def cross_validate(df: DataFrame, fold: str, folds: Iterable[int], fit_predict: FitPredict, label: str) -> DataFrame:
    """``(fold, n, accuracy, macro_f1)``.  Everything, the vocabulary included, is fitted inside the fold."""
    parts = [
        fit_predict(df.where(F.col(fold) != f), df.where(F.col(fold) == f)).select(
            F.lit(f).alias(fold), label, "predicted")
        for f in folds
    ]
    return evaluate(reduce(DataFrame.unionByName, parts), label, "predicted", [fold])


def timed_cross_validate(df: DataFrame, fold: str, folds: Iterable[int], fit_predict: FitPredict, label: str
                         ) -> DataFrame:
    """Fold scores with the seconds each fold took."""
    parts = []
    for f in folds:
        start = time.perf_counter()
        done = materialize(
            fit_predict(df.where(F.col(fold) != f), df.where(F.col(fold) == f)).select(
                F.lit(f).alias(fold), label, "predicted"), "fold")
        parts.append(done.withColumn("fold_time_sec", F.lit(time.perf_counter() - start)))
    return evaluate(reduce(DataFrame.unionByName, parts), label, "predicted", [fold, "fold_time_sec"])
