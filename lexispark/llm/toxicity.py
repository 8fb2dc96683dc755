"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word's input is a vector of its own plus the mean of the vectors of its letter groups, both found by hash, so words
that were never seen still have one.  The network reads windows of ``WINDOW`` words that
overlap the one before; all windows of a text are scored and the highest is the text's score.  Training is by multiple instances: of
a toxic text the highest window counts, of a clean one the two highest and two random ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lexispark.llm.common import crc_fold, result_schema, spread_scan, texts_of

WINDOW, STRIDE = 32, 24
WORDS = CHARS = 1 << 14
INPUT, HIDDEN, ATTENTION = 12, 8, 8
#: Bounds of the training sample: clean and toxic documents, and characters of a document.
TRAIN_DOCS = (3000, 1500)
#: The share of the loss that toxic texts have.
TOXIC_WEIGHT = 0.3
TRAIN_CHARS = 12_000
EPOCHS = 8
#: Small samples are gone through more often, until there are so many steps.
LEAST_STEPS = 300
#: Words and letter groups in fewer training texts have no vector.
RARE = 5
BATCH = 256
RATE = 0.01
#: Words of which a worker remembers the input; beyond it begins anew.
REMEMBERED = 100_000

#: Words or pairs taken at once where each has many letter groups.
AT_ONCE = 1 << 13
#: Texts whose windows are laid out at once.
TEXTS_AT_ONCE = 256

words_of = re.compile(r"\w+").findall


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets; letter group buckets of all words end to end; how many groups each word has."""
    some = [_word_features(words[a : a + AT_ONCE]) for a in range(0, max(1, len(words)), AT_ONCE)]
    return tuple(np.concatenate(x) for x in zip(*some))


def _word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words], dtype=np.int64)
    start = np.cumsum(size) - size
    with np.errstate(over="ignore"):
        place = np.arange(len(codes)) - np.repeat(start, size)
        power = np.uint64(0x9E3779B97F4A7C15) ** place.astype(np.uint64)
        whole = np.add.reduceat((codes + np.uint64(1)) * power, start) if len(words) else codes[:0]
        a, b, c = codes * np.uint64(0x9E3779B97F4A7C15), codes * np.uint64(0xC2B2AE3D27D4EB4F), codes * np.uint64(0x165667B19E3779F9)
        three = a[:-2] + (b[1:-1] ^ (c[2:] >> np.uint64(7)))
        four = (three[:-1] ^ (three[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + codes[3:]
    word = np.repeat(np.arange(len(words)), size)
    has3 = np.flatnonzero(word[:-2] == word[2:])
    has4 = np.flatnonzero(word[:-3] == word[3:]) if len(codes) > 3 else has3[:0]
    groups = np.concatenate([three[has3], four[has4]])
    owner = np.concatenate([word[has3], word[has4]])
    order = np.argsort(owner, kind="stable")

    def bucket(h: np.ndarray, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((((h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(40)).astype(np.int64) % n).astype(np.int16)

    return bucket(whole, WORDS), bucket(groups[order], CHARS), np.bincount(owner, minlength=len(words))


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions first[k] .. first[k] + size[k] - 1 of all k, end to end."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


def window_starts(n: int) -> np.ndarray:
    """Where the windows of a text of ``n`` words begin: every ``STRIDE`` words, and one that ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, dtype=np.int64)
    starts = np.arange(0, n - WINDOW + 1, STRIDE)
    return starts if starts[-1] == n - WINDOW else np.append(starts, n - WINDOW)


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid end to end: word positions of each window, which of them are there, and the window's text."""
    first = np.cumsum(lengths) - lengths
    starts = [window_starts(int(n)) for n in lengths if n]
    text = np.repeat(np.flatnonzero(lengths), [len(s) for s in starts])
    at = (np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64))[:, None] + np.arange(WINDOW)
    there = at < lengths[text][:, None]
    return np.where(there, at, 0) + first[text][:, None], there, text


@dataclass
class Network:
    """Parameters by name; ``forward`` gives logits, ``gradients`` also what the loss changes by."""

    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, seed: int = 10) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        p = {"E": normal(WORDS, INPUT, scale=0.1), "C": normal(CHARS, INPUT, scale=0.1)}
        for d in "fb":
            p |= {
                f"W{d}": normal(INPUT, 3 * HIDDEN, scale=INPUT**-0.5), f"b{d}": np.zeros(3 * HIDDEN, dtype=np.float32),
                f"U{d}": normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            }
        p |= {"A": normal(2 * HIDDEN, ATTENTION, scale=0.3), "a": np.zeros(ATTENTION, dtype=np.float32), "v": normal(ATTENTION, scale=0.3)}
        return cls(p | {"w": normal(2 * HIDDEN, scale=0.3), "c": np.zeros(1, dtype=np.float32)})

    def inputs(self, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        word, group, count = features
        first = np.cumsum(count) - count
        out = self.p["E"][word]
        for a in range(0, len(word), AT_ONCE):
            some = slice(a, a + AT_ONCE)
            end = first[a + AT_ONCE] if a + AT_ONCE < len(word) else len(group)
            out[some] += np.add.reduceat(self.p["C"][group[first[a] : end]], first[some] - first[a]) / count[some, None].astype(np.float32)
        return out

    def projected(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), 6 * HIDDEN), dtype=np.result_type(x, self.p["Wf"]))
        for d, at in (("f", 0), ("b", 3 * HIDDEN)):
            out[:, at : at + 3 * HIDDEN] = x @ self.p[f"W{d}"]
            out[:, at : at + 3 * HIDDEN] += self.p[f"b{d}"]
        return out

    def _run(self, gates: np.ndarray, there: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States of one direction, [step, window, hidden]; ``gates`` [step, window, 3 hidden] of the inputs."""
        steps = range(len(gates)) if d == "f" else range(len(gates) - 1, -1, -1)
        u, h = self.p[f"U{d}"], np.zeros((gates.shape[1], HIDDEN), dtype=gates.dtype)
        out = np.empty((*gates.shape[:2], HIDDEN), dtype=gates.dtype)
        full = there.all()
        for t in steps:
            hu = h @ u
            zr = 1 / (1 + np.exp(-(gates[t, :, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])))
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            if not full:
                z = z * there[t][:, None]
            n = np.tanh(gates[t, :, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, hu[:, 2 * HIDDEN :], zr[:, :HIDDEN], z, r, n))
            h = h + z * (n - h)
            out[t] = h
        return out

    def forward(self, projected: np.ndarray, there: np.ndarray, saved: dict | None = None) -> np.ndarray:
        """Logit of each window: ``projected`` [window, step, 6 hidden], ``there`` [window, step]."""
        gates, there = projected.transpose(1, 0, 2), there.T
        steps: dict[str, list | None] = {d: [] if saved is not None else None for d in "fb"}
        h = np.concatenate([self._run(gates[..., : 3 * HIDDEN], there, "f", steps["f"]), self._run(gates[..., 3 * HIDDEN :], there, "b", steps["b"])], axis=2)
        k = np.tanh(h @ self.p["A"] + self.p["a"])
        e = np.where(there, k @ self.p["v"], -1e9)
        e = np.exp(e - e.max(0))
        e /= e.sum(0)
        pooled = (h * e[..., None]).sum(0)
        if saved is not None:
            saved |= {"h": h, "k": k, "e": e, "pooled": pooled, "steps": steps, "there": there}
        return pooled @ self.p["w"] + self.p["c"][0]

    def gradients(self, features: tuple, index: np.ndarray, there: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted logistic loss of windows ``index`` (into the words of ``features``), and its gradients."""
        p, saved, x = self.p, {}, self.inputs(features)
        logit = self.forward(self.projected(x)[index], there, saved)
        loss = float((weight * (np.logaddexp(0, logit) - y * logit)).sum())
        d_logit = weight * (1 / (1 + np.exp(-logit)) - y)
        h, k, e = saved["h"], saved["k"], saved["e"]
        g = {"w": saved["pooled"].T @ d_logit, "c": np.array([d_logit.sum()])}
        d_pooled = d_logit[:, None] * p["w"]
        d_e = (h * d_pooled).sum(2)
        d_score = e * (d_e - (e * d_e).sum(0))
        d_k = d_score[..., None] * p["v"] * (1 - k * k)
        g |= {"v": np.einsum("twa,tw->a", k, d_score), "A": np.einsum("twh,twa->ha", h, d_k), "a": d_k.sum((0, 1))}
        d_h = e[..., None] * d_pooled + d_k @ p["A"].T
        d_gates = np.zeros((*index.T.shape, 6 * HIDDEN), dtype=x.dtype)
        for d, at in (("f", 0), ("b", 1)):
            u, carry = p[f"U{d}"], np.zeros((len(index), HIDDEN), dtype=x.dtype)
            g[f"U{d}"] = np.zeros_like(u)
            for t, before, hn, z_open, z, r, n in reversed(saved["steps"][d]):
                d_now = carry + d_h[t, :, at * HIDDEN : (at + 1) * HIDDEN]
                d_n = d_now * z * (1 - n * n)
                d_z = d_now * (n - before) * z * (1 - z_open)
                d_r = d_n * hn * r * (1 - r)
                d_hu = np.hstack([d_z, d_r, d_n * r])
                g[f"U{d}"] += before.T @ d_hu
                carry = d_now * (1 - z) + d_hu @ u.T
                d_gates[t, :, 3 * at * HIDDEN : 3 * (at + 1) * HIDDEN] = np.hstack([d_z, d_r, d_n])
        d_proj = np.zeros((len(x), 6 * HIDDEN), dtype=x.dtype)
        np.add.at(d_proj, index.T, d_gates)
        d_x = np.zeros_like(x)
        for d, at in (("f", 0), ("b", 1)):
            part = d_proj[:, 3 * at * HIDDEN : 3 * (at + 1) * HIDDEN]
            g |= {f"W{d}": x.T @ part, f"b{d}": part.sum(0)}
            d_x += part @ p[f"W{d}"].T
        word, group, count = features
        g |= {"E": np.zeros_like(p["E"]), "C": np.zeros_like(p["C"])}
        np.add.at(g["E"], word, d_x)
        np.add.at(g["C"], group, np.repeat(d_x / count[:, None].astype(x.dtype), count, axis=0))
        return loss, g


class Words:
    """Numbers for words, with the inputs of those numbers."""

    def __init__(self, network: Network):
        self.network, self.number, self.rows, self.used = network, {}, np.zeros((1024, 6 * HIDDEN), dtype=np.float32), 0

    def numbers(self, texts: list[list[str]]) -> np.ndarray:
        known = self.number
        if len(known) > REMEMBERED:
            known.clear()
            self.used = 0
        new = list(set().union(*texts) - known.keys())
        if new:
            need = self.used + len(new)
            if need > len(self.rows):
                self.rows = np.concatenate([self.rows, np.empty((need, 6 * HIDDEN), dtype=np.float32)])
            self.rows[self.used : need] = self.network.projected(self.network.inputs(word_features(new)))
            self.used = need
        known.update(zip(new, range(len(known), len(known) + len(new))))
        flat: list[int] = []
        for t in texts:
            flat.extend(map(known.__getitem__, t))
        return np.array(flat, dtype=np.int64)


def train(texts: list[str], toxic: list[int], seed: int = 10, epochs: int = EPOCHS) -> Network:
    """A network for texts marked 1 (toxic) or 0.  With no text, or none of one class, it is untrained."""
    network, rng = Network.new(seed), np.random.default_rng(seed)
    vocabulary: dict[str, int] = {}
    numbers, marks = [], []
    for t, m in zip(texts, toxic):
        own = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t.lower())]
        if own:
            numbers.append(np.array(own, dtype=np.int32))
            marks.append(m)
    marks = np.array(marks, dtype=np.float32)
    if not len(marks) or marks.min() == marks.max():
        return network
    word, group, count = features = word_features(list(vocabulary))
    del vocabulary
    first_group = np.cumsum(count) - count
    number, lengths = np.concatenate(numbers), np.array([len(n) for n in numbers])
    first_word = np.cumsum(lengths) - lengths
    laid = []
    for a in range(0, len(lengths), TEXTS_AT_ONCE):
        place, here, of = windows(lengths[a : a + TEXTS_AT_ONCE])
        laid.append((number[first_word[a] + place], here, a + of))
    at, there, text = (np.concatenate(x) for x in zip(*laid))
    del laid
    # the first choice of windows is by how much oftener a word or its letter groups occur in toxic texts
    in_text = [np.unique(n) for n in numbers]
    del numbers, number
    marked = np.repeat(marks.astype(np.int8), [len(n) for n in in_text])
    in_word = np.concatenate(in_text)
    del in_text
    by_word, by_group = np.zeros((2, WORDS)), np.zeros((2, CHARS))
    np.add.at(by_word, (marked, word[in_word]), 1)
    for a in range(0, len(in_word), AT_ONCE):
        some = in_word[a : a + AT_ONCE]
        np.add.at(by_group, (np.repeat(marked[a : a + AT_ONCE], count[some]), group[_ranges(first_group[some], count[some])]), 1)
    # what only a few texts have would be learnt by heart: it has no vector
    rare = {"E": by_word.sum(0) < RARE, "C": by_group.sum(0) < RARE}
    for k, v in rare.items():
        network.p[k][v] = 0
    evidence = [np.log((n[1] + 0.5) / marks.sum()) - np.log((n[0] + 0.5) / (1 - marks).sum()) for n in (by_word, by_group)]
    odds = evidence[0][word] + np.maximum.reduceat(evidence[1][group], first_group)
    score = np.concatenate([np.where(there[a : a + 2048], odds[at[a : a + 2048]], -np.inf).max(1) for a in range(0, len(at), 2048)])
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    step = 0
    a_round = -(-int((marks == 1).sum() + 4 * (marks == 0).sum()) // BATCH)
    epochs = max(epochs, -(-LEAST_STEPS // a_round))
    bounds = np.searchsorted(text, np.arange(len(lengths) + 1))
    for epoch in range(epochs):
        if epoch:
            rows = network.projected(network.inputs(features))
            score = np.concatenate([network.forward(rows[at[a : a + 2048]], there[a : a + 2048]) for a in range(0, len(at), 2048)])
            del rows
        chosen = []
        for k, mark in enumerate(marks):
            mine = np.arange(bounds[k], bounds[k + 1])
            best = mine[np.argsort(-score[mine], kind="stable")[: 1 if mark else 2]]
            chosen.append(best if mark else np.append(best, rng.choice(mine, 2)))
        chosen = rng.permutation(np.concatenate(chosen))
        y = marks[text[chosen]]
        weight = np.where(y == 1, TOXIC_WEIGHT / y.sum(), (1 - TOXIC_WEIGHT) / (1 - y).sum()) * len(y)
        for a in range(0, len(chosen), BATCH):
            some, mine = chosen[a : a + BATCH], slice(a, a + BATCH)
            used, local = np.unique(at[some], return_inverse=True)
            part = (word[used], group[_ranges(first_group[used], count[used])], count[used])
            _, g = network.gradients(part, local.reshape(len(some), WINDOW), there[some], y[mine], (weight[mine] / len(some)).astype(np.float32))
            step += 1
            rate = RATE * (1 - 0.9 * epoch / epochs)
            for k, v in network.p.items():
                if k in rare:
                    g[k][rare[k]] = 0
                m, s = moments[k]
                m *= 0.9
                m += 0.1 * g[k]
                s *= 0.999
                s += 0.001 * g[k] * g[k]
                v -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return network


def text_scores(texts: list[str], words: Words) -> np.ndarray:
    """Score of each text: the highest of its windows; 0 for a text without a word."""
    split = [words_of(t.lower()) for t in texts]
    lengths = np.array([len(s) for s in split], dtype=np.int64)
    number = words.numbers(split)
    at, there, text = windows(lengths)
    best = np.full(len(texts), -np.inf)
    for a in range(0, len(at), 2048):
        some = slice(a, a + 2048)
        logit = words.network.forward(words.rows[number[at[some]]], there[some])
        np.maximum.at(best, text[some], logit)
    return 1 / (1 + np.exp(-best))


def training_sample(docs: DataFrame, labels: DataFrame, fold: int, folds: int, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[list[str], list[int]]:
    """At most ``TRAIN_DOCS`` labelled texts of the two classes, of at most ``TRAIN_CHARS`` characters, outside ``fold``.

    The ids are chosen first, by their hash, and only they are sent to the texts.  Of an id that is marked both ways
    the mark is toxic.
    """
    return _within_bounds(tuple(r) for r in _sample(docs, labels, fold, folds, id_col, text_col, label_col).collect())


def _within_bounds(found: Iterable[tuple[int, int, str]]) -> tuple[list[str], list[int]]:
    texts, toxic, left = [], [], list(TRAIN_DOCS)
    for _, y, text in sorted(found):
        if left[y]:
            left[y] -= 1
            texts.append(text)
            toxic.append(y)
    return texts, toxic


def _sample(docs: DataFrame, labels: DataFrame, fold: int, folds: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``at`` (a hash of the id), ``y`` and ``text`` of the chosen ids."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)")
    marks = marks.where(crc_fold("id", folds) != fold).groupBy("id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chance = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    picked = F.lit(False)
    for y, n in sizes.items():
        picked = picked | ((F.col("y") == y) & (chance < int(1_000_000 * TRAIN_DOCS[y] / n)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text").between(1, TRAIN_CHARS))
    return rows.join(F.broadcast(marks.where(picked)), "id").select(F.xxhash64("id").alias("at"), "y", "text")


def trained(docs: DataFrame, labels: DataFrame, fold: int, folds: int, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Network:
    """``train`` on the ``training_sample``, in a task: the sample is bounded, and the driver gets the parameters only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns))]
        p = train(*_within_bounds(rows)).p
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(p)), pa.array([v.shape for v in p.values()], pa.list_(pa.int32())), pa.array([v.tobytes() for v in p.values()])], ["name", "shape", "cells"])

    sample = _sample(docs, labels, fold, folds, id_col, text_col, label_col)
    found = sample.repartition(1).mapInArrow(run, "name string, shape array<int>, cells binary").collect()
    if not found:
        return train([], [])
    return Network({r["name"]: np.frombuffer(r["cells"], dtype=np.float32).reshape(r["shape"]).copy() for r in found})


def scores(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text", carried: dict | None = None, text_in: bool = False) -> DataFrame:
    """``id`` and ``score`` of every row: the highest window of the whole text.

    With ``text_in`` the first carried column is a struct that holds the text under ``text_col``; it is sent to the
    tasks once.

    Null and empty texts and those without a word have score 0.  Repeated rows stay; other columns are ignored but
    those in ``carried``, columns of ``docs`` under new names.
    """
    carried = carried or {}
    names = ["id", "score", *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(network)
        for batch in batches:
            column = batch.column(1).field(text_col) if text_in else batch.column(1)
            sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            # the texts of a slice, not of the batch, are Python strings at a time
            cuts = [0, *(np.flatnonzero(np.diff(sizes >> 20)) + 1), len(column)]
            found = [text_scores(texts_of(column.slice(a, b - a)), words) for a, b in zip(cuts, cuts[1:]) if b > a]
            score = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), *batch.columns[1 if text_in else 2 :]], names)

    text = () if text_in else (F.col(text_col).alias("text"),)
    rows = docs.select(F.col(id_col).alias("id"), *text, *(c.alias(n) for n, c in carried.items()))
    return spread_scan(rows).mapInArrow(run, result_schema(rows, "score double", carried))
