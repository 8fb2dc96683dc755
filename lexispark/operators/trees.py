"""Random forest and boosted trees on MLlib vector columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.sql import DataFrame, functions as F

from lexispark.operators.encode import decode_labels, encode_labels
from lexispark.operators.linear import with_class_weights
from lexispark.session import class_values

# MLlib's own limit.
MAX_DEPTH = 30


@dataclass(frozen=True)
class ForestConfig:
    """``min_samples_split`` has no counterpart: a leaf minimum of half its size comes closest.
    The balanced weights are those of the whole table, also where a forest would weigh each bootstrap."""

    n_trees: int = 200
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    balanced: bool = True
    seed: int = 42

    def depth(self) -> int:
        """Depth handed to MLlib; None stands for its largest, and more than that is an error."""
        if self.max_depth is not None and not 0 <= self.max_depth <= MAX_DEPTH:
            raise ValueError(f"max_depth is at most {MAX_DEPTH}; None means {MAX_DEPTH}")
        return MAX_DEPTH if self.max_depth is None else self.max_depth

    def leaf_rows(self) -> int:
        return max(self.min_samples_leaf, ceil(self.min_samples_split / 2))


@dataclass(frozen=True)
class BoostingConfig:
    """``min_child_share`` bounds the weight share of a leaf, and features are drawn per node."""

    n_rounds: int = 400
    max_depth: int = 6
    learning_rate: float = 0.1
    subsample: float = 0.8
    feature_share: float = 0.5
    min_child_share: float = 0.0
    seed: int = 42


class TreeModel:
    """A fitted MLlib model with the labels it was trained on."""

    def __init__(self, model, classes: list) -> None:
        self.model, self.classes = model, classes

    def predict(self, vectors: DataFrame, key: str, keep: Sequence[str] = (), out: str = "predicted") -> DataFrame:
        scored = self.model.transform(vectors).withColumn("_idx", F.col("prediction").cast("long"))
        return decode_labels(scored, self.classes, "_idx", out).select(key, *keep, out)


def _labelled(vectors: DataFrame, label: str) -> tuple[DataFrame, list]:
    classes = class_values(vectors, label)
    return encode_labels(vectors, label, classes).withColumn("_y", F.col("label_idx").cast("double")), classes


def fit_random_forest(vectors: DataFrame, label: str, cfg: ForestConfig = ForestConfig()) -> TreeModel:
    data, classes = _labelled(vectors, label)
    data = with_class_weights(data, label, "_weight") if cfg.balanced else data.withColumn("_weight", F.lit(1.0))
    forest = RandomForestClassifier(
        labelCol="_y", featuresCol="features", weightCol="_weight", numTrees=cfg.n_trees,
        maxDepth=cfg.depth(), minInstancesPerNode=cfg.leaf_rows(),
        featureSubsetStrategy="sqrt", bootstrap=True, seed=cfg.seed,
    )
    return TreeModel(forest.fit(data.select("_y", "_weight", "features")), classes)


def fit_boosted_trees(vectors: DataFrame, label: str, cfg: BoostingConfig = BoostingConfig()) -> TreeModel:
    """One boosted ensemble per class, since MLlib's is binary."""
    data, classes = _labelled(vectors, label)
    boosted = GBTClassifier(
        featuresCol="features", labelCol="_y", maxIter=cfg.n_rounds, maxDepth=cfg.max_depth,
        stepSize=cfg.learning_rate, subsamplingRate=cfg.subsample, featureSubsetStrategy=str(cfg.feature_share),
        minWeightFractionPerNode=cfg.min_child_share, seed=cfg.seed,
    )
    ovr = OneVsRest(classifier=boosted, labelCol="_y", featuresCol="features")
    return TreeModel(ovr.fit(data.select("_y", "features")), classes)
