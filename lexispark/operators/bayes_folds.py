"""Complement naive Bayes of many candidates and folds, inside the row.

A document is one row: its terms, their counts, and for each of them the fold and the class it was counted under.  Only
sums by position and class, and counts of predictions, leave a task; vocabularies and models of bounded size are sent to
the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from lexispark.functions.arithmetic import literal_array
from lexispark.operators.rows import _flat, _slices, counted_rows, long_counts
from lexispark.operators.vocabulary import TfidfConfig
from lexispark.session import fits_broadcast, materialize

SCORE_DIGITS = 9


def class_position(label: Column, classes: Sequence) -> Column:
    """Position of a label in ``classes``, -1 for null."""
    return F.coalesce(F.array_position(literal_array(classes), label).cast("int") - 1, F.lit(-1))


def folded_rows(docs: DataFrame, key: str, label: str, fold: str, text: str, classes: Sequence, cfg: TfidfConfig) -> DataFrame:
    """``(key, terms, tf, ys, folds, roles)``, one row per key: ``ys`` and ``folds`` go with the terms, ``roles`` lists
    class and fold of each row of ``docs``.

    Rows of one key are one document; what they have in common is counted once for each class and fold.
    """
    placed = docs.select(F.col(key).alias("key"), class_position(F.col(label), classes).alias("y"), F.col(fold).cast("int").alias("fold"), text)
    counted = materialize(counted_rows(placed, text, cfg, ("key", "y", "fold")), "cv-counts")
    role = F.struct("y", "fold")
    single = counted.select("key", "terms", "tf", F.array_repeat("y", F.size("terms")).alias("ys"),
                            F.array_repeat("fold", F.size("terms")).alias("folds"), F.array(role).alias("roles"))
    again = materialize(counted.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").select(F.struct("key").alias("_key")), "cv-repeated")
    if not again.take(1):
        return single
    side = F.broadcast(again) if fits_broadcast(again) else again
    own = F.struct("key")  # a struct, so that a null key is found
    repeated = counted.withColumn("_key", own).join(side, "_key", "left_semi").drop("_key")
    terms = long_counts(repeated, ("key", "y", "fold")).groupBy("key", "y", "fold", "term").agg(F.sum("tf").alias("tf"))
    packed = terms.groupBy("key").agg(F.collect_list(F.struct("term", "tf", "y", "fold")).alias("t")).select(F.struct("key").alias("_key"), "t")
    roles = repeated.groupBy("key").agg(F.collect_list(role).alias("roles")).withColumn("_key", F.struct("key"))
    merged = roles.join(packed, "_key", "left").withColumn("t", F.coalesce("t", F.array().cast(packed.schema["t"].dataType))).select(
        "key", F.col("t.term").alias("terms"), F.col("t.tf").alias("tf"), F.col("t.y").alias("ys"), F.col("t.fold").alias("folds"), "roles")
    unique = single.withColumn("_key", own).join(side, "_key", "left_anti").select(*single.columns)
    return materialize(unique.unionByName(merged), "cv-rows")


@dataclass(frozen=True)
class Vocabularies:
    """Rank (from 0; -1 if absent) and idf of each known term in each vocabulary ``(term_set, held_out)``."""

    known: pa.Array
    rank: np.ndarray
    idf: np.ndarray

    @classmethod
    def of(cls, vocab: DataFrame, n_term_sets: int, n_folds: int) -> Vocabularies:
        table = vocab.select("term_set", "held_out", "term", "rank", "idf").toArrow()
        coded = table.column("term").combine_chunks().dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        of = tuple(table.column(c).to_numpy() for c in ("term_set", "held_out"))
        rank = np.full((n_term_sets, n_folds, len(coded.dictionary)), -1, dtype=np.int64)
        idf = np.zeros(rank.shape)
        rank[*of, at] = table.column("rank").to_numpy() - 1
        idf[*of, at] = table.column("idf").to_numpy()
        return cls(coded.dictionary, rank, idf)


class _Batch:
    """The known terms of some documents, end to end."""

    def __init__(self, batch: pa.RecordBatch, v: Vocabularies):
        terms, self.row = _flat(batch.column("terms"))
        tf, self.y, self.fold = (_flat(batch.column(c))[0].to_numpy(zero_copy_only=False) for c in ("tf", "ys", "folds"))
        at = pc.fill_null(pc.index_in(terms, value_set=v.known), -1).to_numpy(zero_copy_only=False)
        fits = at >= 0
        self.n, self.v, self.at, self.row, self.tf = len(batch), v, at[fits], self.row[fits], tf[fits].astype(np.float64)
        self.y, self.fold = self.y[fits], self.fold[fits]
        self.damped = 1.0 + np.log(self.tf)

    def weights(self, term_set: int, held_out: int, max_features: int, sublinear: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms within the vocabulary, their ranks and their weights in unit-length rows."""
        rank = self.v.rank[term_set, held_out][self.at]
        here = np.flatnonzero((rank >= 0) & (rank < max_features))
        raw = (self.damped if sublinear else self.tf)[here] * self.v.idf[term_set, held_out][self.at[here]]
        return here, rank[here], raw / np.sqrt(np.bincount(self.row[here], raw * raw, self.n))[self.row[here]]


def _batches(batches: Iterator[pa.RecordBatch], v: Vocabularies, cells: int) -> Iterator[tuple[pa.RecordBatch, _Batch]]:
    for whole in batches:
        lengths = pc.fill_null(pc.list_value_length(whole.column("terms")), 0).to_numpy(zero_copy_only=False)
        for a, b in _slices(lengths, cells):
            part = whole.slice(a, b - a)
            yield part, _Batch(part, v)


def fold_sums(rows: DataFrame, v: Vocabularies, features: Sequence[tuple[int, int, bool]], n_folds: int, n_classes: int) -> DataFrame:
    """``(feature_set, held_out, rank, counts, total)`` over the documents outside each fold; ``features`` lists
    ``(term_set, max_features, sublinear)``."""
    shared = rows.sparkSession.sparkContext.broadcast(v)
    widest = max(f[1] for f in features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(features), n_folds, widest, n_classes + 1))  # the last class: no label
        for _, b in _batches(batches, shared.value, 4):
            for i, (term_set, size, sublinear) in enumerate(features):
                for h in range(n_folds):
                    here, rank, w = b.weights(term_set, h, size, sublinear)
                    train = b.fold[here] != h
                    cell = rank[train] * (n_classes + 1) + b.y[here][train] % (n_classes + 1)
                    sums[i, h] += np.bincount(cell, w[train], widest * (n_classes + 1)).reshape(widest, -1)
        total = sums.sum(axis=3)
        i, h, rank = np.nonzero(total)
        if len(i):
            counts = pa.ListArray.from_arrays(pa.array(np.arange(len(i) + 1) * n_classes, pa.int32()), pa.array(sums[i, h, rank, :n_classes].ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(h, pa.int32()), pa.array(rank + 1, pa.int32()), counts, pa.array(total[i, h, rank])],
                ["feature_set", "held_out", "rank", "counts", "total"])

    parts = rows.mapInArrow(run, "feature_set int, held_out int, rank int, counts array<double>, total double")
    per_class = F.array(*[F.sum(F.col("counts")[c]) for c in range(n_classes)])
    return parts.groupBy("feature_set", "held_out", "rank").agg(per_class.alias("counts"), F.sum("total").alias("total"))


def fold_predictions(rows: DataFrame, v: Vocabularies, features: Sequence[tuple[int, int, bool]], theta: DataFrame,
                     candidates: Sequence[tuple[int, int]], n_folds: int, classes: Sequence, train_scores: bool) -> DataFrame:
    """``(candidate, part, fold, truth, guess, n)``: predictions of every model on its fold (``test``) and, with
    ``train_scores``, on the rows it was fitted on.

    ``theta(candidate, held_out, rank, theta)`` are the models, ``candidates`` lists ``(candidate, feature_set)``.
    """
    c = len(classes)
    widest = max(f[1] for f in features)
    groups = [[n for n, (_, i) in enumerate(candidates) if i == s] for s in range(len(features))]
    table = theta.select("candidate", "held_out", "rank", "theta").toArrow()
    number = {candidate: n for n, (candidate, _) in enumerate(candidates)}
    models = np.zeros((len(candidates), n_folds, widest, c))
    if table.num_rows:
        at = np.array([number[x] for x in table.column("candidate").to_pylist()])
        values = pc.list_flatten(table.column("theta").combine_chunks()).to_numpy(zero_copy_only=False).reshape(-1, c)
        models[at, table.column("held_out").to_numpy(), table.column("rank").to_numpy() - 1] = values
    stacked = [models[g].transpose(1, 2, 0, 3).reshape(n_folds, widest, len(g) * c) for g in groups]
    shared = rows.sparkSession.sparkContext.broadcast((v, stacked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, stacked = shared.value
        seen = np.zeros((len(candidates), n_folds, 2, c + 1, c), dtype=np.int64)
        for batch, b in _batches(batches, v, max(len(g) for g in groups) * c):
            roles, of = _flat(batch.column("roles"))
            truth, fold = (roles.field(x).to_numpy(zero_copy_only=False) for x in ("y", "fold"))
            known_key = batch.column("key").is_valid().to_numpy(zero_copy_only=False)
            for i, (term_set, size, sublinear) in enumerate(features):
                for h in range(n_folds):
                    here, rank, w = b.weights(term_set, h, size, sublinear)
                    if not train_scores:
                        own = b.fold[here] == h
                        here, rank, w = here[own], rank[own], w[own]
                    row = b.row[here]
                    scores = np.zeros((b.n, stacked[i].shape[2]))
                    first = np.flatnonzero(np.diff(row, prepend=-1))
                    if len(first):
                        scores[row[first]] = np.add.reduceat(stacked[i][h][rank] * w[:, None], first, axis=0)
                    scores[~known_key] = 0.0  # a row without a key is learnt from, but not found again
                    guess = np.round(scores.reshape(b.n, -1, c), SCORE_DIGITS).argmax(axis=2)
                    wanted = np.flatnonzero((fold == h) | train_scores)
                    part = (fold[wanted] != h).astype(np.int64)
                    for j, n in enumerate(groups[i]):
                        np.add.at(seen[n, h], (part, truth[wanted] % (c + 1), guess[of[wanted], j]), 1)
        n, h, part, truth, guess = np.nonzero(seen)
        if len(n):
            ids = np.array([candidate for candidate, _ in candidates])[n]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int32()) for x in (ids, part, h, truth, guess)), pa.array(seen[n, h, part, truth, guess])],
                ["candidate", "part", "fold", "truth", "guess", "n"])

    names = literal_array(classes)
    counted = rows.mapInArrow(run, "candidate int, part int, fold int, truth int, guess int, n long")
    return counted.groupBy("candidate", "part", "fold", "truth", "guess").agg(F.sum("n").alias("n")).select(
        "candidate", F.when(F.col("part") == 0, "test").otherwise("train").alias("part"), "fold",
        F.when(F.col("truth") < c, names[F.col("truth")]).alias("truth"), names[F.col("guess")].alias("guess"), "n")
