"""Language-model scores by the likelihood of all segmentations into subwords.

A document is its words, lower-cased, and one end.  Each word is a lattice: every piece of an existing vocabulary that
fits between two of its letters is an arc.  The probability of a word is the sum over all paths of the product of
their pieces, found by forward recursion in log space, for all distinct words of a batch at once.  A piece can't
reach over the mark that begins a word, so the document's marginal probability is the product of those of its words.

The scores of the vocabulary are merge ranks; a Zipf law over the ranks turns them into probabilities.  Those weight the
segmentations of the training words, whose expected pieces (forward and backward) give the model's own, with the
vocabulary's as prior.  The base score is an add-one word model of the same training documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lexispark.llm.common import spread_scan
from lexispark.session import materialize

# The mark of a word's beginning, and how the vocabulary writes bytes.
MARK = "▁"
BYTE = "<0x{:02X}>"
#: Shift of the Zipf law over ranks, and the shares of bytes and of the end of a document in it.
SHIFT = 2.7
BYTE_SHARE = 1e-4
END_SHARE = 1e-3
#: Pieces that the vocabulary's own probabilities count for, beside those expected in training.
PRIOR_PIECES = 1000.0
ROUNDS = 2
#: Words with at least this part of all training tokens are looked up in the task: there are no more of them than its
#: inverse.  The others meet their counts in a join.
HOT_PART = 3e-6
HOT_LETTERS = 256
#: Rows of partial counts that a task holds before it puts equal words together, or hands them on.
HELD_WORDS = 1_000_000
#: Characters of words whose lattices are built together, and bytes of texts that are scored together.
TOGETHER = 1 << 16
SCORED_TOGETHER = 1 << 22


def words_of(texts: pa.Array) -> pa.ListArray:
    """The words of each text: runs of anything but the six ASCII white spaces, with A-Z in lower case."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    full = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    size = np.bincount(pc.list_parent_indices(lists).to_numpy()[full], minlength=len(lists))
    offsets = np.concatenate([[0], np.cumsum(size)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.filter(pa.array(full)))


@dataclass
class Vocabulary:
    """Pieces of an existing vocabulary, with the log probabilities (natural) that its scores give."""

    pieces: list[str]
    logs: np.ndarray
    byte_ids: np.ndarray
    end: int

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a sentencepiece model file with byte pieces."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        pieces = [model.id_to_piece(i) for i in ids]
        byte_ids = np.array([model.piece_to_id(BYTE.format(b)) for b in range(256)], dtype=np.int64)
        special = np.array([model.is_byte(i) or model.is_control(i) or model.is_unknown(i) for i in ids])
        if not special[byte_ids].all():
            raise ValueError("the vocabulary needs a piece for each byte")
        # a rule of the vocabulary's makers, such as runs of blanks, has no rank and comes last
        rank = -np.array([model.get_score(i) for i in ids])
        zipf = np.where(special, 0.0, 1 / (np.minimum(np.maximum(rank, 0), len(pieces)) + SHIFT))
        share = zipf / zipf.sum() * (1 - BYTE_SHARE - END_SHARE)
        share[byte_ids] = BYTE_SHARE / 256
        share[model.eos_id()] = END_SHARE
        with np.errstate(divide="ignore"):
            return cls(pieces, np.log(share), byte_ids, model.eos_id())

    def usable(self) -> dict[str, int]:
        """Pieces of text; control pieces and bytes are no text."""
        hidden = {*self.byte_ids.tolist(), self.end}
        return {p: i for i, p in enumerate(self.pieces) if i not in hidden and np.isfinite(self.logs[i])}


class Lattice:
    """Forward and backward sums over all segmentations of words."""

    def __init__(self, vocabulary: Vocabulary, logs: np.ndarray):
        self.vocabulary, self.logs = vocabulary, logs
        pieces = vocabulary.usable()
        letters = sorted({c for p in pieces for c in p})
        self.letters = np.array([ord(c) for c in letters], dtype=np.int64)
        code = {c: k for k, c in enumerate(letters)}
        # a tree of prefixes: state and letter give the next state, a state may be a piece
        step: dict[int, int] = {}
        piece_of = [-1]
        for p in pieces:
            state = 0
            for c in p:
                key = state * len(letters) + code[c]
                if key not in step:
                    step[key] = len(piece_of)
                    piece_of.append(-1)
                state = step[key]
            piece_of[state] = pieces[p]
        keys = np.array(list(step), dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.states = keys[order], np.array(list(step.values()), dtype=np.int64)[order]
        # what follows the root: most letters begin some piece
        self.from_root = np.full(len(letters) + 1, -1, dtype=np.int64)
        self.from_root[self.keys[self.keys < len(letters)]] = self.states[self.keys < len(letters)]
        self.piece_of = np.array(piece_of, dtype=np.int64)
        self.longest = max(map(len, pieces))

    def _arcs(self, chars: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and piece of each arc; ``chars`` of all words end to end, ``end`` the end of each one's word."""
        code = np.minimum(np.searchsorted(self.letters, chars), len(self.letters) - 1)
        code = np.where(self.letters[code] == chars, code, -1)
        state = self.from_root[code]
        at = np.flatnonzero(state >= 0)
        state = state[at]
        whole = self.piece_of[state] >= 0
        found = [(at[whole], at[whole] + 1, self.piece_of[state[whole]])]
        for k in range(1, self.longest):
            inside = at + k < end[at]
            at, state = at[inside], state[inside]
            c = code[at + k]
            key = state * len(self.letters) + c
            where = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = (c >= 0) & (self.keys[where] == key)
            at, state = at[ok], self.states[where[ok]]
            whole = self.piece_of[state] >= 0
            found.append((at[whole], at[whole] + k + 1, self.piece_of[state[whole]]))
        begin, stop, piece = (np.concatenate(x) for x in zip(*found))
        # a letter that is no piece itself is spelled in bytes
        spelled = np.ones(len(chars), dtype=bool)
        spelled[begin[stop == begin + 1]] = False
        spelled = np.flatnonzero(spelled)
        return np.concatenate([begin, spelled]), np.concatenate([stop, spelled + 1]), np.concatenate([piece, np.full(len(spelled), -1)])

    def run(self, words: list[str], counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each word and, given the words' counts, the expected number of each piece."""
        size = np.array([len(w) + 1 for w in words], dtype=np.int64)
        chars = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        first = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(words)), size)
        begin, stop, piece = self._arcs(chars, (first + size)[owner])
        spelled = np.flatnonzero(piece < 0)
        weight = np.where(piece >= 0, self.logs[piece], 0.0)
        spelling = [self.vocabulary.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))] for c in chars[begin[spelled]]]
        weight[spelled] = [self.logs[b].sum() for b in spelling]
        # a word of n letters has n + 1 places; its first is at its first letter plus the number of words before it
        word = owner[begin]
        source, target = begin + word, stop + word
        place = begin - first[word]
        order = np.argsort(place.astype(np.uint16 if len(chars) < 1 << 16 else np.int64), kind="stable")
        source, target, weight, place = source[order], target[order], weight[order], place[order]
        cuts = np.searchsorted(place, np.arange(int(size.max(initial=0)) + 1))
        start, final = first + np.arange(len(words)), first + np.arange(len(words)) + size
        forward = np.full(len(chars) + len(words), -np.inf)
        forward[start] = 0.0
        # arcs that begin at one place of a word end at distinct ones, so each step has its targets once
        for a, b in zip(cuts[:-1], cuts[1:]):
            forward[target[a:b]] = np.logaddexp(forward[target[a:b]], forward[source[a:b]] + weight[a:b])
        total = forward[final]
        if counts is None:
            return total, None
        backward = np.full(len(forward), -np.inf)
        backward[final] = 0.0
        # by the places that follow: arcs that end at one place of a word begin at distinct ones
        after = (final[word[order]] - target).astype(np.uint16 if len(chars) < 1 << 16 else np.int64)
        by_end = np.argsort(after, kind="stable")
        ends = np.searchsorted(after[by_end], np.arange(int(size.max(initial=0)) + 1))
        for a, b in zip(ends[:-1], ends[1:]):
            s, t, w = source[by_end[a:b]], target[by_end[a:b]], weight[by_end[a:b]]
            backward[s] = np.logaddexp(backward[s], backward[t] + w)
        share = np.exp(forward[source] + weight + backward[target] - total[word[order]]) * counts[word[order]]
        kinds = piece[order]
        known = kinds >= 0
        expected = np.bincount(kinds[known], share[known], len(self.logs))
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        for at, ids in zip(spelled, spelling):
            np.add.at(expected, ids, share[back[at]])
        return total, expected

    def pieces_of(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """Ranges of words whose lattices are built together."""
        size = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        cuts = [0, *(np.flatnonzero(np.diff(size // TOGETHER)) + 1).tolist(), len(words)]
        yield from ((a, b) for a, b in zip(cuts[:-1], cuts[1:]) if b > a)


@dataclass
class Model:
    """What training gives: ``counts(word, n, log)`` as stored, the commonest of them, the log probabilities of the pieces."""

    vocabulary: Vocabulary
    logs: np.ndarray
    counts: DataFrame
    hot: pa.Table
    documents: int
    tokens: int
    distinct: int


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` over all texts of ``docs``; tasks hand on partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for batch in batches:
            for _, texts in _slices(batch.column(0)):
                found = words_of(texts).flatten().value_counts()
                held.append(pa.table({"word": found.field(0), "n": found.field(1)}))
                if sum(t.num_rows for t in held) > HELD_WORDS:
                    held = [merged()]
                    if held[0].num_rows > HELD_WORDS // 2:
                        yield from held[0].to_batches()
                        held = []
        if held:
            yield from merged().to_batches()

    found = spread_scan(docs.select(F.col(text_col).alias("text"))).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def with_logs(words: DataFrame, vocabulary: Vocabulary, logs: np.ndarray) -> DataFrame:
    """``words(word, n)`` with the natural log probability ``log`` of each word, over all its segmentations."""
    lattice = Lattice(vocabulary, logs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            found = [lattice.run(names[a:b])[0] for a, b in lattice.pieces_of(names)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0), *found]))], ["word", "n", "log"])

    return spread_scan(words.select("word", "n")).mapInArrow(run, "word string, n long, log double")


def expected_pieces(counts: DataFrame, vocabulary: Vocabulary, logs: np.ndarray) -> np.ndarray:
    """How often each piece is expected in the words of ``counts(word, n)``, by the given probabilities."""
    lattice = Lattice(vocabulary, logs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(lattice.logs))
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(np.float64)
            for a, b in lattice.pieces_of(words):
                total += lattice.run(words[a:b], n[a:b])[1]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["piece", "expected"])

    rows = spread_scan(counts.select("word", "n")).mapInArrow(run, "piece long, expected double")
    # no more rows than the vocabulary has pieces
    found = rows.groupBy("piece").agg(F.sum("expected").alias("expected")).toArrow()
    out = np.zeros(len(logs))
    out[found.column("piece").to_numpy()] = found.column("expected").to_numpy()
    return out


def train(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", rounds: int = ROUNDS, hot_part: float = HOT_PART) -> Model:
    """Count the words of ``docs`` and fit the pieces' probabilities; null texts are empty documents."""
    counts = materialize(word_counts(docs, text_col), "training-words")
    n_docs = docs.count()
    sums = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, distinct = (sums[0] or 0) + n_docs, sums[1] + (n_docs > 0)
    logs = vocabulary.logs
    for _ in range(rounds):
        expected = expected_pieces(counts, vocabulary, logs)
        expected[vocabulary.end] = n_docs
        expected += PRIOR_PIECES * np.exp(vocabulary.logs)
        with np.errstate(divide="ignore"):
            logs = np.log(expected / expected.sum())
    counts = materialize(with_logs(counts, vocabulary, logs), "word-logs")
    hot = counts.where((F.col("n") >= max(1.0, hot_part * tokens)) & (F.length("word") <= HOT_LETTERS)).toArrow()
    return Model(vocabulary, logs, counts, hot, n_docs, tokens, distinct)


def _slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts that are taken together, and where they begin; a longer text is alone."""
    size, a = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), 0
    while a < len(size):
        b = a + max(1, int(np.searchsorted(np.cumsum(size[a:]), SCORED_TOGETHER, side="right")))
        yield a, texts.slice(a, b - a)
        a = b


def scores(docs: DataFrame, model: Model, carried: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The ``carried`` columns of each row with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Scores are log10 probabilities of the row's words and its end.  Repeated rows are scored each; null and empty texts
    have their end alone; an empty table gives no rows; without training documents the base score is 0 and the pieces
    have the vocabulary's own probabilities.
    """
    names = list(carried)
    source = docs.select(*(c.alias(f"c{k}") for k, c in enumerate(carried.values())), F.col(text_col).alias("text"))
    hot_words = model.hot.column("word").combine_chunks()
    hot_n, hot_log = (model.hot.column(c).to_numpy() for c in ("n", "log"))
    below = float(np.log10(model.tokens + model.distinct + 1))
    known_end = int(model.documents > 0)
    base_end = float(np.log10(model.documents + 1)) - below
    log_end = float(model.logs[model.vocabulary.end])

    columns = [*source.columns[:-1], "key", "n_tokens", "known", "base", "score", "rare"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_base = np.log10(hot_n + 1) - below
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start, texts in _slices(batch.column("text")):
                lists = words_of(texts)
                size = lists.value_lengths().to_numpy()
                coded = lists.flatten().dictionary_encode()
                n_words = max(len(coded.dictionary), 1)
                pair = np.repeat(np.arange(len(size)), size) * n_words + coded.indices.to_numpy()
                pair, k = np.unique(pair, return_counts=True)
                doc, word = np.divmod(pair, n_words)
                at = pc.fill_null(pc.index_in(coded.dictionary, hot_words), -1).to_numpy()[word]
                common = at >= 0
                doc_hot, at, k_hot = doc[common], at[common], k[common]

                def total(weights: np.ndarray) -> np.ndarray:
                    return np.bincount(doc_hot, weights, len(size))

                known = known_end + total(k_hot).astype(np.int64)
                out = [key + np.arange(len(size)), 1 + size.astype(np.int64), known, base_end + total(k_hot * hot_base[at]), log_end + total(k_hot * hot_log[at])]
                offsets = np.searchsorted(doc[~common], np.arange(len(size) + 1))
                rare = [coded.dictionary.take(pa.array(word[~common])), pa.array(k[~common])]
                rare = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(rare, ["word", "k"]))
                key += len(size)
                old = batch.slice(start, len(size)).columns[:-1]
                yield pa.RecordBatch.from_arrays([*old, *map(pa.array, out), rare], columns)

    added = "key long, n_tokens long, known long, base double, score double, rare array<struct<word: string, k: long>>"
    schema = T.StructType([*source.drop("text").schema, *T.StructType.fromDDL(added)])
    # written once, so a row's key is the same for both of its readers
    rows = materialize(spread_scan(source).mapInArrow(run, schema), "scored")
    rare = rows.select("key", F.explode("rare").alias("r")).select("key", "r.word", "r.k")
    new = rare.select("word").distinct().join(model.counts, "word", "left_anti").withColumn("n", F.lit(0).cast("long"))
    new = materialize(with_logs(new, model.vocabulary, model.logs), "new-words")
    rare = rare.join(model.counts.unionByName(new), "word").groupBy("key").agg(
        F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("k") * (F.log10(F.col("n") + 1) - below)).alias("rare_base"),
        F.sum(F.col("k") * F.col("log")).alias("rare_log"),
    )
    rows = rows.drop("rare").join(rare, "key", "left")

    def both(common: str, others: str) -> Column:
        return F.col(common) + F.coalesce(F.col(others), F.lit(0))

    return rows.select(
        *(F.col(f"c{k}").alias(n) for k, n in enumerate(names)), "n_tokens", both("known", "rare_known").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        both("base", "rare_base").alias("base_score"), (both("score", "rare_log") / F.lit(float(np.log(10)))).alias("score"),
    )
