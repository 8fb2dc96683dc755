"""Language of a text by mixture inference.

A language is a distribution over letter trigrams, learnt from labelled texts.  A text is a mixture: each word is
drawn from one language, and expectation-maximisation estimates the proportions from the words' likelihoods.  Which
languages are in the mixture is chosen by a penalised likelihood: languages join in the order of their proportion
while the gain exceeds the penalty for one more parameter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lexispark.llm.common import result_schema, spread_scan, texts_of
from lexispark.session import materialize

BUCKETS = 1 << 15
MAX_LANGUAGES = 256
ROUNDS = 8
CHARS_AT_ONCE = 1 << 20
SMOOTHING = 0.1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def words_of(text: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of a lower-cased text: trigram buckets, the first of each word, and the words' places in the text.

    A word is a run of letters; its trigrams take a blank before and after it.  The text goes in pieces of bounded
    size, cut between words, or inside a run of letters that is longer than a piece.
    """
    a = 0
    while a < len(text):
        b = min(len(text), a + CHARS_AT_ONCE)
        while b < len(text) and b > a + 1 and text[b - 1].isalpha():
            b -= 1
        if b == a + 1 and b < len(text):
            b = min(len(text), a + CHARS_AT_ONCE)
        codes = np.frombuffer(text[a:b].encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        letter = _letters()[codes]
        padded = np.full(len(codes) + 2, 32, dtype=np.int64)
        padded[1:-1][letter] = codes[letter]
        at = np.flatnonzero(letter)
        if len(at):
            mixed = (padded[at] * 0x9E3779B1 + padded[at + 1] * 0x85EBCA77 + padded[at + 2] * 0xC2B2AE3D) & 0xFFFFFFFF
            first = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1]))
            yield ((mixed ^ (mixed >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF) >> 17, first, a + at[first]
        a = b


def packed(texts: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Positions and lower-cased texts, in packs of bounded size (a longer text is a pack of its own)."""
    pack, size = [], 0
    for k, text in enumerate(texts):
        if pack and size + len(text) > CHARS_AT_ONCE:
            yield np.array(pack), [texts[p].lower() for p in pack]
            pack, size = [], 0
        pack.append(k)
        size += len(text) + 1
    if pack:
        yield np.array(pack), [texts[p].lower() for p in pack]


def trigram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Rows (lang, bucket, n) over all rows of ``docs``; summed within each task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                total = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                for _, pack in packed(texts):
                    for grams, _, _ in words_of("\n".join(pack)):
                        total += np.bincount(grams, minlength=BUCKETS)
        for lang, total in sums.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), type=pa.string()), pa.array(some.astype(np.int32)), pa.array(total[some])], ["lang", "bucket", "n"])

    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return spread_scan(rows).mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log probability of each trigram bucket in each of them.

    The model is languages x buckets, so its size doesn't grow with the corpus; languages are limited and an error
    tells when there are more.  Languages whose texts have no letter are left out.
    """
    counts = materialize(trigram_counts(docs, text_col, lang_col), "trigram-counts")
    langs = sorted(r[0] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.full((BUCKETS, len(langs)), SMOOTHING)
    place = {lang: k for k, lang in enumerate(langs)}
    for lang, bucket, n in counts.collect():
        table[bucket, place[lang]] += n
    return langs, np.log(table / table.sum(0)).astype(np.float32) if langs else table.astype(np.float32)


def word_likelihoods(texts: list[str], logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Likelihood of each word (row) in each language, relative to its best one, and the text the word is in."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    scores, places = [np.zeros((0, logs.shape[1]), dtype=np.float32)], [np.zeros(0, dtype=np.int64)]
    for grams, first, place in words_of("\n".join(texts)):
        scores.append(np.add.reduceat(logs[grams], first, axis=0))
        places.append(place)
    score = np.concatenate(scores)
    like = np.exp(score - score.max(1, keepdims=True)) if len(score) else score
    return np.maximum(like, np.float32(1e-30)), np.searchsorted(ends, np.concatenate(places), side="right")


def mixture(like: np.ndarray, text: np.ndarray, starts: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood of each text, by expectation-maximisation from ``share``; a zero stays zero.

    ``text`` is the row of ``share`` for each word, in order; ``starts`` the first word of each text.
    """
    size = np.diff(np.append(starts, len(like)))[:, None]
    for _ in range(rounds):
        joint = like * share[text]
        joint /= joint.sum(1, keepdims=True)
        share = np.add.reduceat(joint, starts, axis=0) / size
    return share, np.add.reduceat(np.log((like * share[text]).sum(1, dtype=np.float64)), starts)


def proportions(like: np.ndarray, text: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """The texts that have a word, and their proportions of all languages: zero for those outside the chosen set."""
    present, starts, text = np.unique(text, return_index=True, return_inverse=True)
    if not len(present):
        return present, np.zeros((0, like.shape[1]))
    k = like.shape[1]
    uniform = np.full((len(present), k), 1.0 / k, dtype=np.float32)
    full, _ = mixture(like, text, starts, uniform, ROUNDS)
    order = np.argsort(-full, axis=1, kind="stable")
    words = np.diff(np.append(starts, len(like)))
    cost = np.full(len(present), np.inf)
    out = np.zeros((len(present), k))
    going = np.arange(len(present))
    for size in range(1, k + 1):
        member = np.zeros((len(going), k), dtype=bool)
        np.put_along_axis(member, order[going, :size], True, axis=1)
        start = np.where(member, np.maximum(full[going], np.float32(1e-6)), 0).astype(np.float32)
        start /= start.sum(1, keepdims=True)
        mine = np.isin(text, going) if len(going) < len(present) else slice(None)
        some = np.searchsorted(going, text[mine])
        first = np.concatenate([[0], np.cumsum(words[going])[:-1]])
        share, fit_ = mixture(like[mine], some, first, start, ROUNDS // 2 if size > 1 else 0)
        now = -2 * fit_ + penalty * size * np.log(np.maximum(words[going], 2))
        better = now < cost[going]
        going = going[better]
        cost[going], out[going] = now[better], share[better]
        if not len(going):
            break
    return present, out


def identify(docs: DataFrame, langs: list[str], logs: np.ndarray, id_col: str = "doc_id", text_col: str = "text", penalty: float = 1.0, carried: dict[str, Column] | None = None) -> DataFrame:
    """``id``, ``lang_pred``, ``score`` (its proportion), ``languages`` and ``proportions`` of the chosen set.

    A null text, one without letters, and any text when no language was learnt get ``und`` and score 0.  Equal
    proportions go to the language that sorts first.  Repeated rows stay; extra columns are ignored; ``carried`` adds
    columns of ``docs`` under new names.
    """
    carried = carried or {}
    names = ["id", "lang_pred", "score", "languages", "proportions", *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [("und", 0.0, [], [])] * batch.num_rows
            for rows_, pack in packed(texts_of(batch.column(1))) if langs else ():
                like, text = word_likelihoods(pack, logs)
                for row, share in zip(*proportions(like, text, penalty)):
                    some = [k for k in np.argsort(-share, kind="stable") if share[k] > 0]
                    parts = [min(1.0, float(share[k])) for k in some]
                    found[rows_[row]] = (langs[some[0]], parts[0], [langs[k] for k in some], parts)
            pred, score, sets, parts = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.list_(pa.string())), pa.array(parts, pa.list_(pa.float64())), *batch.columns[2:]], names
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(c.alias(n) for n, c in carried.items()))
    return spread_scan(rows).mapInArrow(run, result_schema(rows, "lang_pred string, score double, languages array<string>, proportions array<double>", carried))
