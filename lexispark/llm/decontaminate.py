"""Benchmark decontamination: BM25 with block-max pruning over an inverted index of the test items.

The items are the index and every passage of the training text is a query.  An item's scores are taken relative to
its score against itself, so one threshold holds for items of all lengths.  Passages are answered many at a time:

1. a passage is dropped if in none of 64 coarse blocks of items the maxima of its rarer terms, and the most that
   common terms give an item there, add up to the threshold;
2. its terms are sorted by their maxima; those below the pivot together can't reach the threshold, so an item must
   hold a term from the pivot on, and only those postings are opened;
3. postings lie in blocks of items; a block is opened only if its maxima and the rest can reach the threshold;
4. what is left is scored in full.

Each step drops only what can't reach the threshold, so all items above it are found.  A match counts when both the
question and the answer are covered by runs of five words of the text around the passage.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexispark.llm.common import spread_scan, texts_of

K1, B = 1.2, 0.75
THRESHOLD = 0.5
COVERED = 0.8
SHINGLE = 5
BLOCK = 16
COARSE = 64
#: Words in a larger share of the items are common: they alone open nothing.
COMMON = 0.04
HALF = 32
#: Characters of test items in one index; more items make more indexes, each with a pass of its own.
SHARD_CHARS = 32_000_000
CHARS_AT_ONCE = 1 << 21
_words = re.compile(r"\w+").findall


def words_of(text: str) -> list[str]:
    return _words(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The answer is the last sentence; of one sentence, the last third of its words."""
    sentences = [w for w in (words_of(s) for s in text.replace("?", ".").replace("!", ".").replace("\n", ".").split(".")) if w]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = words_of(text)
    cut = max(1, len(words) * 2 // 3)
    return words[:cut], words[cut:]


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions first[k] .. first[k] + size[k] - 1 of all k, end to end."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


@dataclass
class Index:
    """Postings by term, with their maxima by block of items and overall."""

    ids: list
    parts: list[tuple[list[str], list[str]]]
    term: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        bags = [Counter(q + a) for q, a in self.parts]
        sizes = np.array([sum(b.values()) for b in bags], dtype=np.float64)
        # numbers go from rare to common words, so that the first ``rare`` of them are those in few items
        holds = Counter(w for bag in bags for w in bag)
        self.term.update((w, k) for k, w in enumerate(sorted(holds, key=lambda w: (holds[w], w))))
        self.rare = sum(n <= max(1, COMMON * len(bags)) for n in holds.values())
        item = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        term = np.array([self.term[w] for b in bags for w in b], dtype=np.int64)
        count = np.array([n for b in bags for n in b.values()], dtype=np.float64)
        df = np.bincount(term, minlength=len(self.term))
        idf = np.log1p((len(bags) - df + 0.5) / (df + 0.5))
        length = 1 - B + B * sizes / max(sizes.mean(), 1) if len(sizes) else sizes
        impact = idf[term] * count * (K1 + 1) / (count + K1 * length[item])
        own = np.bincount(item, impact, len(bags))
        impact = impact / own[item]
        order = np.lexsort((item, term))
        self.item, self.impact = item[order], impact[order]
        term = term[order]
        self.first = np.searchsorted(term, np.arange(len(self.term) + 1))
        self.most = np.maximum.reduceat(self.impact, self.first[:-1]) if len(self.impact) else self.impact
        block = self.item // BLOCK
        start = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])) if len(term) else term
        self.block, self.block_first = block[start], np.searchsorted(term[start], np.arange(len(self.term) + 1))
        self.block_most = np.maximum.reduceat(self.impact, start) if len(start) else self.impact
        few, group = term < self.rare, self.item * COARSE // max(len(bags), 1)
        self.coarse = np.zeros((self.rare, COARSE), dtype=np.float32)
        np.maximum.at(self.coarse, (term[few], group[few]), self.impact[few].astype(np.float32))
        # what the common words of an item can add at most, by coarse block
        common = np.bincount(self.item[~few], self.impact[~few], len(bags))
        self.common = np.zeros(COARSE, dtype=np.float32)
        np.maximum.at(self.common, np.arange(len(bags)) * COARSE // max(len(bags), 1), common.astype(np.float32))
        self.key = term * len(bags) + self.item
        self.n_blocks = len(bags) // BLOCK + 1
        longest = int(sizes.max()) if len(sizes) else 0
        # half a passage: an item of the longest size still lies to three quarters in one passage
        self.half = max(HALF, math.ceil(0.6 * longest))

    def retrieve(self, term: np.ndarray, half: np.ndarray, n_halves: int, last: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Passages, items and scores at or above ``threshold``.

        ``term`` and ``half``: the known words in order and the half passage each is in; passage k is the halves k and
        k + 1, or k alone if it is the ``last`` of its text.
        """
        none = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
        # a word counts once in a half passage; without any rare word the common ones may still be enough
        key = np.unique((half * self.rare + term)[term < self.rare])
        mass = np.zeros((n_halves, COARSE), dtype=np.float32)
        if len(key):
            in_half, few = np.divmod(key, self.rare)
            here = np.flatnonzero(np.concatenate([[True], in_half[1:] != in_half[:-1]]))
            mass[in_half[here]] = np.add.reduceat(self.coarse[few], here, axis=0)
            mass[:-1] += np.where(last[:-1, None], np.float32(0), mass[1:])
        passage = np.flatnonzero((mass + self.common).max(1) >= threshold - 1e-4)
        if not len(passage):
            return none
        begin = np.searchsorted(half, passage)
        size = np.searchsorted(half, passage + np.where(last[passage], 1, 2)) - begin
        width = len(self.term)
        pair = np.unique(np.repeat(np.arange(len(passage)), size) * width + term[_ranges(begin, size)])
        p, t = np.divmod(pair, width)
        order = np.lexsort((self.most[t], p))
        p, t = p[order], t[order]
        run = np.cumsum(self.most[t])
        first = np.searchsorted(p, np.arange(len(passage) + 1))
        run = run - np.repeat(np.append(0, run)[first[:-1]], np.diff(first))
        essential = run >= threshold - 1e-9
        rest = np.zeros(len(passage))
        np.maximum.at(rest, p[~essential], run[~essential])
        ep, et = p[essential], t[essential]
        n = self.block_first[et + 1] - self.block_first[et]
        at = _ranges(self.block_first[et], n)
        key, where = np.unique(np.repeat(ep, n) * self.n_blocks + self.block[at], return_inverse=True)
        ok = np.bincount(where, self.block_most[at], len(key)) + rest[key // self.n_blocks] >= threshold - 1e-9
        open_blocks = key[ok]
        if not len(open_blocks):
            return none
        use = np.isin(ep, open_blocks // self.n_blocks)
        ep, et = ep[use], et[use]
        n = self.first[et + 1] - self.first[et]
        at, owner = _ranges(self.first[et], n), np.repeat(ep, n)
        use = np.isin(owner * self.n_blocks + self.item[at] // BLOCK, open_blocks)
        at, owner = at[use], owner[use]
        n_items = len(self.ids)
        key, where = np.unique(owner * n_items + self.item[at], return_inverse=True)
        score = np.bincount(where, self.impact[at], len(key))
        ok = score + rest[key // n_items] >= threshold - 1e-9
        key, score = key[ok], score[ok]
        # the terms before the pivot, looked up for the items that are left
        low_p, low_t = p[~essential], t[~essential]
        first = np.searchsorted(low_p, np.arange(len(passage) + 1))
        owner, item = np.divmod(key, n_items)
        n = first[owner + 1] - first[owner]
        wanted = low_t[_ranges(first[owner], n)] * n_items + np.repeat(item, n)
        found = np.minimum(np.searchsorted(self.key, wanted), max(len(self.key) - 1, 0))
        score = score + np.bincount(np.repeat(np.arange(len(key)), n), np.where(self.key[found] == wanted, self.impact[found], 0), len(key))
        ok = score >= threshold - 1e-9
        return passage[owner[ok]], item[ok], score[ok]


def covered(part: list[str], item: list[str], at: int, around: list[str]) -> float:
    """Share of ``part``'s words (from position ``at`` of ``item``) that lie in a run of five words found around."""
    size = min(SHINGLE, len(item))
    there = {tuple(around[k : k + size]) for k in range(len(around) - size + 1)}
    hit = np.zeros(len(item), dtype=bool)
    for k in range(len(item) - size + 1):
        if tuple(item[k : k + size]) in there:
            hit[k : k + size] = True
    return float(hit[at : at + len(part)].mean()) if part else 1.0


def matches(texts: list[str], index: Index, threshold: float, least: float) -> Iterator[tuple[int, int, float, float, float, int]]:
    """(text, item, score, question covered, answer covered, first word of the passage), the best passage of each."""
    tokens = [words_of(t) for t in texts]
    flat: list[int] = []
    for words in tokens:
        flat.extend(map(index.term.get, words, repeat(-1)))
    term = np.array(flat, dtype=np.int64)
    length = np.array([len(w) for w in tokens], dtype=np.int64)
    halves = np.maximum(1, -(-length // index.half))
    start = np.cumsum(halves) - halves
    half = np.repeat(start, length) + _ranges(np.zeros(len(length), dtype=np.int64), length) // index.half
    last = np.zeros(halves.sum(), dtype=bool)
    last[start + halves - 1] = True
    known = term >= 0
    passage, item, score = index.retrieve(term[known], half[known], len(last), last, threshold)
    text = np.searchsorted(start, passage, side="right") - 1
    best: dict[tuple[int, int], tuple] = {}
    for k in np.argsort(-score, kind="stable"):
        here, it = int(text[k]), int(item[k])
        question, answer = index.parts[it]
        whole = question + answer
        first = int(passage[k] - start[here]) * index.half
        around = tokens[here][max(0, first - len(whole)) : first + 2 * index.half + len(whole)]
        q, a = covered(question, whole, 0, around), covered(answer, whole, len(question), around)
        if min(q, a) >= least and (here, it) not in best:
            best[here, it] = (here, it, float(score[k]), q, a, first)
    yield from (best[k] for k in sorted(best))


def _shards(items: DataFrame, shard_chars: int) -> Iterator[list]:
    """The items in parts whose size is bounded, by the hash of their text."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // shard_chars))
    for k in range(n):
        yield items.where(F.pmod(F.xxhash64("text", "id"), F.lit(n)) == k).orderBy("id", "text").collect()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    threshold: float = THRESHOLD, least: float = COVERED, shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """One row for each text and test item it holds: ``id``, ``item``, ``score``, ``question_overlap``,
    ``answer_overlap``, ``passage`` (its first word).

    Null and empty texts and items match nothing.  Repeated rows of either table give repeated matches; items of the
    same words are one in the index, so repeats don't make their words common.  Extra columns are ignored; an empty
    benchmark or table gives no rows.
    """
    rows = spread_scan(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    items = benchmark.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).where("text is not null")
    kinds = {c: d.schema["id"].dataType.simpleString() for c, d in (("id", rows), ("item", items))}
    schema = f"id {kinds['id']}, item {kinds['item']}, score double, question_overlap double, answer_overlap double, passage int"
    context, found = docs.sparkSession.sparkContext, None
    for shard in _shards(items, shard_chars):
        owners: dict[tuple, list] = {}
        for r in shard:
            question, answer = question_and_answer(r["text"])
            if question:
                owners.setdefault((tuple(question), tuple(answer)), []).append(r["id"])
        shared = context.broadcast(Index(list(owners.values()), [(list(q), list(a)) for q, a in owners]))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            ids = pa.array([i for own in index.ids for i in own])
            size = np.array([len(own) for own in index.ids], dtype=np.int64)
            first_id = np.cumsum(size) - size
            for batch in batches:
                texts = texts_of(batch.column(1))
                sizes = np.cumsum([len(t) for t in texts])
                for at in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes // CHARS_AT_ONCE)) + 1):
                    hits = list(matches([texts[k] for k in at], index, threshold, least)) if len(at) and index.ids else []
                    if hits:
                        text, item, score, q, a, first = map(np.array, zip(*hits))
                        each = np.repeat(np.arange(len(item)), size[item])
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(at[text[each]])), ids.take(pa.array(_ranges(first_id[item], size[item]))), *(pa.array(x[each]) for x in (score, q, a)), pa.array(first[each], pa.int32())],
                            ["id", "item", "score", "question_overlap", "answer_overlap", "passage"],
                        )

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found
