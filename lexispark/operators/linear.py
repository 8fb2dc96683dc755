"""Linear classifiers: mini-batch one-vs-rest training and the MLlib estimators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark.functions.arithmetic import weighted_sums
from lexispark.operators.rows import scored_rows
from lexispark.operators.scoring import linear_scores, predicted
from lexispark.operators.split import epoch_batches
from lexispark.session import bounded_broadcast, class_values, materialize, spread

# Numbers a model may have; it is broadcast to the tasks for every update.
MAX_MODEL_CELLS = 50_000_000
# With more updates in an epoch than this, of at most so many rows, a task reads the batches of a model one after the other.
STREAMED_UPDATES = 16
STREAMED_ROWS = 8192


@dataclass
class LinearModel:
    """One weight vector and one bias per class."""

    classes: list
    weights: np.ndarray
    bias: np.ndarray

    def theta(self, spark: SparkSession) -> DataFrame:
        """``(rank, theta)`` for :func:`linear_scores`; ``rank`` starts at 1."""
        return _positions(spark, self.weights).select((F.col("position") + 1).alias("rank"), "theta")

    def as_table(self, spark: SparkSession) -> DataFrame:
        """``(label, feature, weight)``; feature -1 is the bias."""
        n_classes, n_features = self.weights.shape
        return spark.createDataFrame(pa.table({
            "label": pa.array(self.classes).take(pa.array(np.repeat(np.arange(n_classes), n_features + 1))),
            "feature": np.tile(np.arange(-1, n_features), n_classes).astype("int32"),
            "weight": np.column_stack([self.bias, self.weights]).ravel(),
        }))


def _positions(spark: SparkSession, weights: np.ndarray) -> DataFrame:
    """``(position, theta)``: the class weights of each feature."""
    return spark.createDataFrame(pa.table({
        "position": np.arange(weights.shape[1], dtype="int32"), "theta": pa.array(list(weights.T)),
    }))


@dataclass(frozen=True)
class SgdConfig:
    """Mini-batch settings; ``reg_strength`` may differ per class."""

    batch_size: int = 512
    epochs: int = 10
    learning_rate: float = 2.0
    reg_strength: float | Sequence[float] = 1e-4
    loss: str = "log"
    seed: int = 42


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights ``n / (K * n_c)``, one row per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    n, k = counts.agg(F.sum("n")).scalar(), counts.agg(F.count("*")).scalar()
    return counts.withColumn("class_weight", n.cast("double") / (k * F.col("n")))


def with_class_weights(df: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """Rows with the balanced weight of their class."""
    classes = class_values(df, label)
    weights = class_weights(df, label).select(label, F.col("class_weight").alias(out))
    return df.join(bounded_broadcast(weights, len(classes)), label)


def binary_class_weights(df: DataFrame, positive: str) -> DataFrame:
    """``(pos_weight, neg_weight)`` as ``n / (2 n_c)``; fails when a class is missing."""
    is_positive = F.col(positive)
    n, pos = F.count("*"), F.count_if(is_positive)
    missing = F.raise_error(F.lit("balanced class weights need both classes"))
    return df.agg(
        F.when((pos == 0) | (pos == n), missing.cast("double")).otherwise(n / (2.0 * pos)).alias("pos_weight"),
        F.when((pos == 0) | (pos == n), missing.cast("double")).otherwise(n / (2.0 * (n - pos))).alias("neg_weight"),
    )


def gradient_terms(weights: DataFrame, errors: DataFrame, key: str, n_classes: int) -> DataFrame:
    """Per term the summed ``weight * error`` of each class; ``errors(key, err)`` has one array per row."""
    return weights.join(errors, key).groupBy("term").agg(
        weighted_sums(F.col("w"), F.col("err"), n_classes).alias("gradient"))


def _partial_gradient(pdf: pd.DataFrame, weights: np.ndarray, bias: np.ndarray, pos: np.ndarray, neg: np.ndarray,
                      loss: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Touched features, their gradient per class, the bias gradient and the weight sum of one batch of rows."""
    lengths = pdf["idx"].map(len).to_numpy()
    row = np.repeat(np.arange(len(pdf)), lengths)
    idx = np.concatenate([np.asarray(x, dtype=int) for x in pdf["idx"]]) if lengths.sum() else np.zeros(0, int)
    w = np.concatenate([np.asarray(x, dtype=float) for x in pdf["w"]]) if lengths.sum() else np.zeros(0)
    z = np.stack([np.bincount(row, w * weights[c, idx], len(pdf)) for c in range(len(bias))], axis=1) + bias
    truth = pdf["label_idx"].to_numpy()[:, None] == np.arange(len(bias))[None, :]
    sample = np.where(truth, pos, neg)
    if loss == "log":
        error = (1.0 / (1.0 + np.exp(-z)) - truth) * sample
    else:
        sign = np.where(truth, 1.0, -1.0)
        error = -2.0 * sign * np.maximum(0.0, 1.0 - sign * z) * sample
    touched, place = np.unique(idx, return_inverse=True)
    grad = np.stack([np.bincount(place, w * error[row, c], len(touched)) for c in range(len(bias))], axis=1)
    return touched, grad, error.sum(axis=0), sample.sum(axis=0)


def _batch_gradients(rows: DataFrame, models: dict[int, tuple[np.ndarray, ...]], loss: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Gradient of one batch of every model over all its classes, as a single job.

    ``models`` holds weights, bias and the weights of both sides.  Tasks send one row per model and touched feature; those
    are added up after a shuffle, so the driver receives at most one row per feature of a model.
    """
    shared = rows.sparkSession.sparkContext.broadcast(models)
    widest = max(len(m[1]) for m in models.values())

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = shared.value
        for whole in batches:
            for m, pdf in whole.groupby("model"):
                touched, grad, b, s = _partial_gradient(pdf, *models[m], loss)
                yield pd.DataFrame({"model": np.full(len(touched) + 2, m, dtype="int32"),
                                    "feature": np.concatenate([[-2, -1], touched]).astype("int32"), "g": [s, b, *grad]})

    sums = (
        rows.select("model", "idx", "w", "label_idx").mapInPandas(partial, "model int, feature int, g array<double>")
        .groupBy("model", "feature").agg(F.array(*[F.sum(F.get("g", F.lit(c))) for c in range(widest)]).alias("g"))
        .toArrow().to_pandas()
    )
    shared.unpersist()
    out = {m: (np.zeros_like(v[0]), np.zeros_like(v[1])) for m, v in models.items()}
    for m, mine in sums.groupby("model"):
        weights, bias = models[m][:2]
        grad = np.zeros_like(weights)
        g = np.stack(mine["g"].to_numpy())[:, : len(bias)].astype(float)
        feature = mine["feature"].to_numpy()
        grad[:, feature[feature >= 0]] = g[feature >= 0].T
        weight_sum, grad_bias = g[feature == -2][0], g[feature == -1][0]
        out[m] = grad / weight_sum[:, None], grad_bias / weight_sum
    return out


def _streamed_epoch(ordered: DataFrame, models: dict[int, tuple[np.ndarray, ...]], regs: Sequence[np.ndarray], cfg: SgdConfig
                    ) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Weights and bias of each model after the batches of ``ordered(model, batch, label_idx, idx, w)``, as a single job.

    One task takes a model; it holds the weights and the rows of one batch.
    """
    shared = ordered.sparkSession.sparkContext.broadcast((models, regs, cfg.loss, cfg.learning_rate))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, regs, loss, rate = shared.value
        found, held, now = {}, [], None

        def update() -> None:
            weights, bias, pos, neg = found.get(now[0], models[now[0]])
            touched, grad, b, s = _partial_gradient(pd.concat(held, ignore_index=True), weights, bias, pos, neg, loss)
            slope = regs[now[0]] * weights
            slope[:, touched] += grad.T / s[:, None]
            found[now[0]] = weights - rate * slope, bias - rate * (b / s), pos, neg

        for batch in batches:
            pdf = batch.to_pandas()
            model, number = pdf["model"].to_numpy(), pdf["batch"].to_numpy()
            for at in np.split(np.arange(len(pdf)), np.flatnonzero((np.diff(model) != 0) | (np.diff(number) != 0)) + 1):
                if not len(at):
                    continue
                own = int(model[at[0]]), int(number[at[0]])
                if own != now and held:
                    update()
                    held = []
                now = own
                held.append(pdf.iloc[at])
        if held:
            update()
        for m, (weights, bias, _, _) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([m], pa.int32()), pa.array([weights.ravel()], pa.list_(pa.float64())), pa.array([bias], pa.list_(pa.float64()))], ["model", "weights", "bias"])

    rows = ordered.select("model", "batch", "label_idx", "idx", "w").repartitionById(len(models), F.col("model")).sortWithinPartitions("model", "batch")
    found = rows.mapInArrow(run, "model int, weights array<double>, bias array<double>").toArrow().to_pylist()
    shared.unpersist()
    return {r["model"]: (np.array(r["weights"]).reshape(models[r["model"]][0].shape), np.array(r["bias"])) for r in found}


def fit_ovr(rows: DataFrame, key: str, label: str, n_features: int, cfg: SgdConfig = SgdConfig()) -> LinearModel:
    """One-vs-rest mini-batch gradient descent on rows ``(key, label, idx, w)``.

    All classes share the batches of an epoch, so an update is one job whatever their number.
    The rows are materialised once, and each epoch's order is cached while it is in use.
    """
    return fit_ovr_together([(rows, n_features)], key, label, cfg)[0]


def fit_ovr_together(tables: Sequence[tuple[DataFrame, int]], key: str, label: str, cfg: SgdConfig = SgdConfig()) -> list[LinearModel]:
    """:func:`fit_ovr` of several ``(rows, n_features)``: a job is one update of each of the models, or with many small
    updates a whole epoch, in which a task takes a model.

    Each model has its own rows, classes and batches; one with fewer batches waits for the end of the epoch.
    """
    if cfg.loss not in ("log", "squared_hinge"):
        raise ValueError("loss must be log or squared_hinge")
    labels = [class_values(rows, label) for rows, _ in tables]
    if min(map(len, labels)) < 2:
        raise ValueError("balanced class weights need at least two classes")
    if sum(len(classes) * n_features for classes, (_, n_features) in zip(labels, tables)) > MAX_MODEL_CELLS:
        raise ValueError("classes times features is too large for a broadcast model")
    from lexispark.operators.encode import encode_labels

    coded = [encode_labels(rows, label, classes).select(F.lit(m).alias("model"), key, "label_idx", "idx", "w")
             for m, ((rows, _), classes) in enumerate(zip(tables, labels))]
    encoded = spread(materialize(reduce(DataFrame.unionByName, coded), "sgd-rows"), key)
    counted = {(r["model"], r["label_idx"]): r["count"] for r in encoded.groupBy("model", "label_idx").count().collect()}
    models, regs, n_batches = {}, [], []
    for m, (classes, (_, n_features)) in enumerate(zip(labels, tables)):
        per_class = np.array([counted[m, c] for c in range(len(classes))], dtype=float)
        n = per_class.sum()
        if cfg.loss == "log":
            pos, neg = n / (2.0 * per_class), n / (2.0 * (n - per_class))
        else:
            pos, neg = n / (len(classes) * per_class), np.ones(len(classes))
        regs.append(np.broadcast_to(np.asarray(cfg.reg_strength, dtype=float), (len(classes),))[:, None])
        models[m] = np.zeros((len(classes), n_features)), np.zeros(len(classes)), pos, neg
        n_batches.append(ceil(n / cfg.batch_size))
    for epoch in range(cfg.epochs):
        if max(n_batches) > STREAMED_UPDATES and cfg.batch_size <= STREAMED_ROWS:
            ordered = epoch_batches(encoded, key, cfg.batch_size, cfg.seed, epoch, by=("model",))
            for m, fitted in _streamed_epoch(ordered, models, regs, cfg).items():
                models[m] = *fitted, *models[m][2:]
            continue
        if max(n_batches) > 1:
            ordered = epoch_batches(encoded, key, cfg.batch_size, cfg.seed, epoch, by=("model",)).sortWithinPartitions("batch").persist()
        else:
            ordered = encoded.persist()
        for b in range(max(n_batches)):
            batch = ordered.where(F.col("batch") == b) if max(n_batches) > 1 else ordered
            live = {m: v for m, v in models.items() if b < n_batches[m]}
            for m, (grad, grad_bias) in _batch_gradients(batch, live, cfg.loss).items():
                weights, bias, pos, neg = models[m]
                models[m] = weights - cfg.learning_rate * (grad + regs[m] * weights), bias - cfg.learning_rate * grad_bias, pos, neg
        ordered.unpersist()
    return [LinearModel(classes, *models[m][:2]) for m, classes in enumerate(labels)]


def fit_squared_hinge_svm(rows: DataFrame, key: str, label: str, n_features: int, c: float = 1.0, epochs: int = 50,
                          learning_rate: float = 0.2, batch_size: int | None = None, seed: int = 42) -> LinearModel:
    """Balanced linear SVM with squared hinge loss in the loop of :func:`fit_ovr`.

    The penalty ``1/2 |w|^2 + C * sum(weight * loss)`` is divided by ``C * sum(weight)``.
    """
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    n, k = sum(counts.values()), len(counts)
    total = [n / k + (n - counts[v]) for v in sorted(counts)]
    reg = tuple(1.0 / (c * t) for t in total)
    return fit_ovr(rows, key, label, n_features,
                   SgdConfig(batch_size or n, epochs, learning_rate, reg, "squared_hinge", seed))


def predict_linear(model: LinearModel, docs: DataFrame, weights: DataFrame, key: str, keep: Sequence[str] = (),
                   out: str = "predicted") -> DataFrame:
    """Class of the largest score for ``weights(key, rank, w)``.

    The sigmoid is increasing, so it need not be applied.
    """
    theta = model.theta(docs.sparkSession)
    scored = linear_scores(docs, weights, theta, key, len(model.classes), model.bias, keep, model.weights.shape[1],
                           "rank")
    return scored.select(key, *keep, predicted(F.col("scores"), model.classes).alias(out))


def ml_vectors(rows: DataFrame, n_features: int, out: str = "features") -> DataFrame:
    """MLlib vector column from ``idx, w``."""
    to_vector = F.udf(lambda i, w: Vectors.sparse(n_features, i, w), VectorUDT())
    return rows.withColumn(out, to_vector("idx", "w"))


def fit_ovr_mllib(vectors: DataFrame, label: str, kind: str, c: float = 1.0, max_iter: int = 100) -> LinearModel:
    """One MLlib fit per class with that class's own weights.

    ``kind`` is ``logistic`` (both sides weighted) or ``svc`` (hinge loss, only the positive side
    weighted).  ``regParam = 1 / (C * sum(weight))`` gives the same trade-off as ``C``.  MLlib does not
    penalise the intercept.
    """
    classes = class_values(vectors, label)
    counts = {r[label]: r["count"] for r in vectors.groupBy(label).count().collect()}
    n, k = sum(counts.values()), len(classes)
    if k < 2:
        raise ValueError("balanced class weights need at least two classes")
    weights, bias = [], []
    vectors = vectors.select(label, "features").persist()
    for value in classes:
        n_pos = counts[value]
        if kind == "logistic":
            pos, neg = n / (2.0 * n_pos), n / (2.0 * (n - n_pos))
        else:
            pos, neg = n / (k * n_pos), 1.0
        is_pos = F.col(label) == F.lit(value)
        one = vectors.withColumn("_y", is_pos.cast("double")).withColumn(
            "_weight", F.when(is_pos, F.lit(pos)).otherwise(F.lit(neg)))
        shared = dict(labelCol="_y", weightCol="_weight", featuresCol="features", maxIter=max_iter,
                      regParam=1.0 / (c * (n_pos * pos + (n - n_pos) * neg)), standardization=False)
        model = (LogisticRegression(family="binomial", **shared) if kind == "logistic" else LinearSVC(**shared)).fit(one)
        weights.append(model.coefficients.toArray())
        bias.append(float(model.intercept))
    vectors.unpersist()
    return LinearModel(classes, np.array(weights), np.array(bias))


def fit_multinomial(vectors: DataFrame, label: str, c: float = 1.0, balanced: bool = False, max_iter: int = 1000
                    ) -> LinearModel:
    """Multinomial logistic regression on an MLlib vector column."""
    from lexispark.operators.encode import encode_labels

    classes = class_values(vectors, label)
    data = encode_labels(vectors, label, classes).withColumn("_y", F.col("label_idx").cast("double"))
    data = with_class_weights(data, label, "_weight") if balanced else data.withColumn("_weight", F.lit(1.0))
    data = data.select("_y", "_weight", "features").persist()
    total = data.agg(F.sum("_weight")).first()[0]
    model = LogisticRegression(
        family="multinomial", labelCol="_y", weightCol="_weight", featuresCol="features", maxIter=max_iter,
        regParam=1.0 / (c * total), elasticNetParam=0.0, standardization=False,
    ).fit(data)
    data.unpersist()
    return LinearModel(classes, model.coefficientMatrix.toArray(), model.interceptVector.toArray())


def predict_rows(model: LinearModel, rows: DataFrame, key: str, keep: Sequence[str] = (), out: str = "predicted"
                 ) -> DataFrame:
    """Predictions for rows in the layout ``idx, w`` (dense vectors included), scored in place."""
    scored = scored_rows(rows, model.weights.T, model.bias, (key, *keep))
    return scored.select(key, *keep, predicted(F.col("scores"), model.classes).alias(out))
