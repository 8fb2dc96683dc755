"""Spelling variants: words of a corpus that differ by one letter, grouped under the commonest form.

Words are counted with partial sums in each task.  Two words with one error between them share their first or their last
half, so halves bring candidates together.  Within such a group a bit-sliced index holds, for each position and letter,
the bitset of the words that have the letter there.  A query runs along its letters and keeps four sets, for all words
of the group at once: no error so far, one letter replaced, one letter more, one letter less.  The last two look the
letter up one position later or earlier.  Words may have no letter but a-z and U+00C0 to U+00FF, so Latin-1 has one byte
for each.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexispark.llm.common import block_rows, scan_groups, spread_scan
from lexispark.session import materialize

RUN = re.compile(rb"[a-z\xC0-\xFF]+")
#: One run in so many, by its checksum, loses a letter.
DAMAGED = 97
MIN_LETTERS = 5
MIN_COUNT = 3
#: A form has at least so many times the count of the word.
RATIO = 2
#: Distinct words a task counts before it hands them on.
HELD_WORDS = 200_000
BLOCK = 2048
#: Words that share one index, if their groups are small, and letters that it may have.
INDEXED = 512
CELLS = 4 << 20


def damaged_words(doc_id: object, text: str | None, damaged: int = DAMAGED) -> Counter:
    """Occurrences of each word of a text, as Latin-1 bytes, after the damage."""
    found = Counter(RUN.findall((text or "").encode("latin-1", "replace").lower()))
    before = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), b":"
    seed, out = zlib.crc32(before[1], before[0]), Counter()
    for run, n in found.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if h % damaged == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n`` of the words that have that many letters and occurrences.

    A null text has no words; a null id is written as nothing.  Repeated rows count each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in damaged_words(doc_id, text).items():
                    if len(word) >= min_letters:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    rows = spread_scan(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class SlicedIndex:
    """Bitsets over words (a list of Latin-1 bytes) by position and letter."""

    def __init__(self, words: list[bytes]):
        self.size = np.array([len(w) for w in words], dtype=np.int64)
        self.width = (len(words) + 63) // 64
        flat = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        self.first = np.cumsum(self.size) - self.size
        owner = np.repeat(np.arange(len(words)), self.size)
        self.code = (np.arange(len(flat)) - self.first[owner]) << 8 | flat
        self.codes, at = np.unique(self.code, return_inverse=True)
        # row 0 is for letters that no word has at the position
        self.sets = self._rows(len(self.codes) + 1, at + 1, owner)
        longest = int(self.size.max(initial=0))
        self.lengths = self._rows(longest + 3, self.size, np.arange(len(words)))
        # words that have the position at all
        self.having = np.bitwise_or.accumulate(self.lengths[::-1], axis=0)[::-1][1:]

    def _rows(self, n: int, row: np.ndarray, member: np.ndarray) -> np.ndarray:
        out = np.zeros(n * self.width, dtype=np.uint64)
        np.bitwise_or.at(out, row * self.width + (member >> 6), np.uint64(1) << (member & 63).astype(np.uint64))
        return out.reshape(n, self.width)

    def _at(self, code: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return self.sets[np.where(self.codes[at] == code, at + 1, 0)]

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) of the indexed words with exactly one error between them."""
        order = np.argsort(-self.size, kind="stable")
        size, first = self.size[order], self.first[order]
        n = len(order)
        zero = np.repeat(self.having[0][None, :], n, axis=0)
        replaced, less = np.zeros_like(zero), np.zeros_like(zero)
        more = zero.copy()
        found = np.zeros_like(zero)
        for i in range(int(size[0]) if n else 0):
            # the queries that have a letter here come first
            live = int(np.searchsorted(-size, -i, side="left"))
            code = self.code[first[:live] + i]
            here = self._at(code)
            # ``less`` has read one letter more than the word it stands for, ``more`` one letter less
            less[:live] = (less[:live] & self._at(code - (1 << 8))) | zero[:live] if i else zero[:live]
            replaced[:live] = (replaced[:live] & here) | (zero[:live] & self.having[i] & ~here)
            zero[:live] &= here
            more[:live] = (more[:live] & self._at(code + (1 << 8))) | (zero[:live] & self.having[i + 1])
            done = slice(int(np.searchsorted(-size, -(i + 1), side="left")), live)
            found[done] = (replaced[done] & self.lengths[i + 1]) | (more[done] & self.lengths[i + 2]) | (less[done] & self.lengths[i])
        q, w = np.nonzero(np.unpackbits(found.view(np.uint8), axis=1, bitorder="little"))
        return order[q], w


def _pieces(half: np.ndarray, starts: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole groups that share one index."""
    a, ends = 0, np.append(starts[1:], n)
    for start, end in zip(starts, ends):
        rows, letters = end - a, 2 * int(half[start]) + 2
        if start > a and (rows > INDEXED or rows * letters > CELLS):
            yield a, start
            a = start
    yield a, n


def _best_near(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
    """For each row of the groups that begin at ``starts``: how many near words they show, and the best of them.

    A pair is counted where it shares the half of its shorter word: by the first letters, or else by the last ones.
    """
    words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
    count = batch.column("n").to_numpy()
    half, last, own = (batch.column(c).to_numpy() for c in ("half", "last", "own"))
    diagonal = batch.column("lo").to_numpy() == batch.column("hi").to_numpy()
    size = np.array([len(w) for w in words])
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(words))))
    query, near = [], []
    for a, b in _pieces(half, starts, len(words)):
        if b - a < 2:
            continue
        q, w = SlicedIndex(words[a:b]).near()
        q, w = q + a, w + a
        ok = (group[q] == group[w]) & (diagonal[q] | (own[q] != own[w])) & (np.minimum(size[q], size[w]) // 2 == half[q])
        for k in np.flatnonzero(ok):
            x, y, h = words[q[k]], words[w[k]], half[q[k]]
            head = x[:h] == y[:h]
            ok[k] = (not head and x[-h:] == y[-h:]) if last[q[k]] else head
        query.append(q[ok])
        near.append(w[ok])
    q = np.concatenate(query) if query else np.zeros(0, dtype=np.int64)
    w = np.concatenate(near) if near else np.zeros(0, dtype=np.int64)
    text = np.array(words, dtype=object)
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[w], -count[w], q))
    q, w = q[order], w[order]
    begin = np.flatnonzero(np.diff(q, prepend=-1))
    decoded = lambda at: pa.array([text[k].decode("latin-1") for k in at], pa.string())
    counts = np.diff(np.append(begin, len(q)))
    return pa.RecordBatch.from_arrays(
        [decoded(q[begin]), pa.array(counts, pa.int64()), pa.array(count[w[begin]], pa.int64()), decoded(w[begin])], ["word", "n_near", "best_n", "best"]
    )


def near_words(counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word``, ``n_near``, ``best_n`` and ``best`` of each word of ``counts(word, n)`` that has a near word.

    Words need two letters at least, so that they have halves.
    """
    size = F.length("word")
    halves = F.array_distinct(F.array(F.floor(size / 2), F.floor((size - 1) / 2)))
    rows = counts.select("word", "n", F.explode(halves.cast("array<int>")).alias("half")).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("last"))
    rows = rows.where("half > 0")
    part = F.when(F.col("last") == 0, F.substr("word", F.lit(1), F.col("half"))).otherwise(F.right("word", F.col("half")))
    rows = rows.withColumn("bucket", F.xxhash64("half", "last", part))
    rows = block_rows(rows, "bucket", "word", block)
    found = scan_groups(rows.select("word", "n", "half", "last", "bucket", "own", "lo", "hi"), ["half", "bucket", "lo", "hi"], _best_near, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of ``forms(word, form)``: forms followed to the last, twice as far in each round."""
    done = None
    now = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = materialize(now.join(after, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not now.where("moved").take(1):
            return now.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of each frequent word of ``docs``.

    Words are near with one letter inserted, deleted or replaced between them.  A word's form is its near word of the
    largest count (ties: the first in code-point order) if that is at least ``ratio`` times its own; the root is where
    forms end.  Counts grow along forms, so they end.  A word without a form has itself as root.  No words, no rows.
    """
    counts = materialize(word_counts(docs, id_col, text_col), "word-counts")
    named = counts.join(near_words(counts, block), "word", "left")
    fits = F.col("best_n") >= ratio * F.col("n")
    named = named.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n"))
    named = materialize(named, "word-forms")
    last = roots(named.where("form is not null").select("word", "form"))
    return named.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
