"""Quality by positive-unlabelled learning.

Trusted positives are known; all other web text is unlabelled and holds good and bad alike.  A classifier of positives
against unlabelled text gives the class prior: where it is surest of positives, the unlabelled share over the positive
share is least, and that is the estimate.  The score then minimises the non-negative unbiased risk: the risk of the
negatives is the unlabelled risk less the prior's share of positives, and never counts below zero.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexispark.llm.common import crc_fold, result_schema, spread_scan, texts_of

#: Bounds of the training sample: trusted positives and unlabelled texts.
POSITIVES, UNLABELLED = 4000, 8000
BINS = 10
STEPS = 400
RATE = 0.1
RIDGE = 1e-4
CONFIDENCE = 0.1
_MARKS = np.frombuffer(string.punctuation.encode(), dtype=np.uint8)
_OTHERS = 12
FEATURES = len(_MARKS) + _OTHERS


def features(text: str) -> np.ndarray:
    """Shares of marks, cases and repeats in the whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    out = np.zeros(FEATURES)
    if not raw:
        return out
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    words = text.split()
    lines = text.split("\n")
    n, n_words = len(raw), max(1, len(words))
    upper, lower, digits = seen[65:91].sum(), seen[97:123].sum(), seen[48:58].sum()
    out[: len(_MARKS)] = seen[_MARKS] / n
    out[len(_MARKS) :] = (
        np.log1p(n), upper / n, upper / max(1, upper + lower), digits / n, seen[128:].sum() / n, (seen[9:14].sum() + seen[32]) / n,
        len(set(words)) / n_words, sum(map(eq, words, words[1:])) / n_words, (n - n_words) / n_words,
        len(set(lines)) / len(lines), len(lines) / n, seen[_MARKS].sum() / n,
    )
    return out


@dataclass
class Scorer:
    """Bin edges of each feature and a weight for each bin."""

    edges: list[np.ndarray]
    weights: np.ndarray
    bias: float
    prior: float

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Position of each feature's bin in ``weights``."""
        return np.stack([np.searchsorted(e, x[:, k], side="right") + k * (BINS + 1) for k, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.weights[self.rows(x)].sum(1) + self.bias)))


def _descend(gradient, size: int) -> np.ndarray:
    w, m, s = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, STEPS + 1):
        g = gradient(w)
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return w


class Design:
    """Rows of a matrix of zeros and ones: the bins that are one, and a last column that always is."""

    def __init__(self, rows: np.ndarray, size: int):
        self.rows = np.hstack([rows, np.full((len(rows), 1), size)])
        self.shape = (len(rows), size + 1)

    def __len__(self) -> int:
        return len(self.rows)

    def every_second(self, first: int) -> Design:
        return Design(self.rows[first::2, :-1], self.shape[1] - 1)

    def times(self, w: np.ndarray) -> np.ndarray:
        return w[self.rows].sum(1)

    def mean(self, v: np.ndarray) -> np.ndarray:
        """Mean over rows of each row times its value."""
        return np.bincount(self.rows.ravel(), np.repeat(v, self.rows.shape[1]), self.shape[1]) / len(self)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def class_prior(p: Design, u: Design) -> float:
    """Share of positives among unlabelled rows, from held-back halves of both.

    A classifier is fitted on one half; on the other the ratio of the shares above each threshold is bounded from
    above, and the estimate is the ratio where that bound is least.
    """
    if len(p) < 2 or len(u) < 2:
        return 0.5
    fit_p, fit_u = p.every_second(0), u.every_second(0)

    def gradient(w: np.ndarray) -> np.ndarray:
        return fit_u.mean(_sigmoid(fit_u.times(w))) - fit_p.mean(_sigmoid(-fit_p.times(w))) + 2 * RIDGE * w

    w = _descend(gradient, p.shape[1])
    at_p, at_u = np.sort(p.every_second(1).times(w)), np.sort(u.every_second(1).times(w))
    levels = np.unique(at_p)
    above_p = 1 - np.searchsorted(at_p, levels, side="left") / len(at_p)
    above_u = 1 - np.searchsorted(at_u, levels, side="left") / len(at_u)
    slack = sum(np.sqrt(np.log(4 / CONFIDENCE) / (2 * n)) for n in (len(at_p), len(at_u)))
    best = int(np.argmin((above_u + slack) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Scorer:
    """A scorer from feature rows; without positives or unlabelled rows every score is a half."""
    both = np.concatenate([positive, unlabelled])
    edges = [np.unique(np.quantile(both[:, k], np.linspace(0, 1, BINS + 1)[1:])) if len(both) else np.zeros(0) for k in range(FEATURES)]
    # the share of rows at zero may hide small values: the least positive one is an edge too
    for k, e in enumerate(edges):
        some = both[:, k][both[:, k] > 0]
        edges[k] = np.unique(np.append(e[: BINS - 1], some.min())) if len(some) else e[:BINS]
    size = FEATURES * (BINS + 1)
    scorer = Scorer(edges, np.zeros(size), 0.0, prior or 0.5)
    if not len(positive) or not len(unlabelled):
        return scorer
    p, u = Design(scorer.rows(positive), size), Design(scorer.rows(unlabelled), size)
    prior = class_prior(p, u) if prior is None else prior

    def gradient(w: np.ndarray) -> np.ndarray:
        fp, fu = p.times(w), u.times(w)
        as_positive = -prior * p.mean(_sigmoid(-fp))
        negative = np.logaddexp(0, fu).mean()
        p_risk = prior * np.logaddexp(0, fp).mean()
        of_negative = u.mean(_sigmoid(fu)) - prior * p.mean(_sigmoid(fp))
        ridge = 2 * RIDGE * w
        # below zero the negatives are fitted beyond what they can be: step back
        return (as_positive + of_negative if negative >= p_risk else -of_negative) + ridge

    w = _descend(gradient, size + 1)
    scorer.weights, scorer.bias, scorer.prior = w[:-1], float(w[-1]), prior
    return scorer


def _feature_rows(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([features(t).tolist() for t in texts_of(batch.column(0))], pa.list_(pa.float64()))], ["x"])

    return spread_scan(rows.select("text")).mapInArrow(run, "x array<double>")


def _picked(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows, taken by the hash of their id."""
    n = rows.count()
    return rows if n <= most else rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * most / n)))


def _features_of(rows: DataFrame) -> np.ndarray:
    found = _feature_rows(rows).toArrow().column("x").combine_chunks()
    return found.flatten().to_numpy().reshape(-1, FEATURES)


def train(docs: DataFrame, labels: DataFrame, fold: int, folds: int, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Scorer:
    """Fit on rows outside ``fold``: trusted positives are labelled 1, unlabelled are all rows of ``docs``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(crc_fold("id", folds) != fold)
    trusted = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("id")).where(crc_fold("id", folds) != fold).distinct()
    # few ids go to the texts, not the texts to the ids
    positive = rows.join(F.broadcast(_picked(trusted, POSITIVES)), "id", "left_semi")
    return fit(_features_of(positive), _features_of(_picked(rows, UNLABELLED)))


def scores(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text", carried: dict[str, Column] | None = None) -> DataFrame:
    """``id`` and ``score`` of every row's whole text; null counts as empty, and empty texts get the model's score.

    Repeated rows stay; other columns are ignored but those in ``carried``, columns of ``docs`` under new names.
    """
    carried = carried or {}
    names = ["id", "score", *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in texts_of(batch.column(1))]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.score(x)), *batch.columns[2:]], names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(c.alias(n) for n, c in carried.items()))
    return spread_scan(rows).mapInArrow(run, result_schema(rows, "score double", carried))
