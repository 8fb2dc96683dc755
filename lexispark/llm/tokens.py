"""Token counts of a byte-level BPE, by rank-synchronous merging of ragged arrays.

All pre-tokens that a batch brings for the first time are laid end to end in one array of symbols.  In a round each
sequence finds its pair of the lowest rank and merges every occurrence of it at once; sequences without a pair that
merges leave the array.  A merge makes a symbol that only later ranks use, so this gives what merging one pair at a
time gives.  What survives is the number of tokens of the pre-token; a document's count is a sum of those.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from lexispark.llm.common import spread_scan, texts_of

#: Pre-tokens of which a worker remembers the count; beyond it begins anew.
REMEMBERED = 1_000_000
# The published pre-token pattern of this family of vocabularies, with \s spelled out as White_Space.
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Merges:
    """Merge table of a byte-level BPE file; counts the symbols that are left of byte sequences."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"] or model["ignore_merges"]:
            raise ValueError("only byte-level BPE files without normaliser are counted")
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens with strip or word rules are not supported")
        symbols: dict[str, int] = byte_letters()
        left, right, made = [], [], []
        for pair in model["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left.append(symbols[a])
            right.append(symbols[b])
            made.append(symbols.setdefault(a + b, len(symbols)))
        self.size = len(symbols)
        keys = np.array(left, dtype=np.int64) * self.size + np.array(right, dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), np.array(made, dtype=np.int64)
        # pairs of single bytes, which every piece begins with
        self.first = np.full((256, 256), len(made), dtype=np.int64)
        for a, b, r in zip(left, right, range(len(made))):
            if a < 256 and b < 256:
                self.first[a, b] = r
        self.split = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.made))

    def survivors(self, pieces: list[bytes]) -> np.ndarray:
        """How many symbols are left of each piece when nothing merges any more."""
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        out = lengths.copy()
        live = np.flatnonzero(lengths > 1)
        if not len(live):
            return out
        symbols = np.frombuffer(b"".join(pieces[k] for k in live), dtype=np.uint8).astype(np.int64)
        sizes, none = lengths[live], len(self.made)
        rank = np.full(len(symbols), none, dtype=np.int64)
        rank[:-1] = self.first[symbols[:-1], symbols[1:]]
        rank[np.cumsum(sizes) - 1] = none
        while len(live):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(rank, starts)
            at = np.flatnonzero((rank == np.repeat(lowest, sizes)) & (rank < none))
            # in a run of overlapping pairs (a a a) every other one merges, from the left
            if len(at):
                run = np.concatenate([[True], np.diff(at) != 1])
                offset = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
                at = at[offset % 2 == 0]
            symbols[at] = self.made[rank[at]]
            last = np.zeros(len(symbols), dtype=bool)
            last[starts[1:] - 1] = last[-1] = True
            last[at] = last[at + 1]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            left = np.add.reduceat(keep.astype(np.int64), starts)
            done = (lowest == none) | (left == 1)
            out[live[done]] = left[done]
            keep &= np.repeat(~done, sizes)
            fresh = np.zeros(len(symbols), dtype=bool)
            fresh[at] = True
            symbols, rank, last, fresh = symbols[keep], rank[keep], last[keep], fresh[keep]
            live, sizes = live[~done], left[~done]
            # only pairs with a new symbol have to be looked up again
            fresh[:-1] |= fresh[1:]
            new = np.flatnonzero(fresh)
            inner = new[~last[new]]
            rank[new] = none
            rank[inner] = self._rank(symbols[inner], symbols[inner + 1])
        return out


_loaded: dict[str, tuple] = {}


def counter(path: str):
    """A function from texts to their token counts; remembers counts of chunks between calls.

    A space before a word begins a pre-token, so a text is cut at its spaces and a chunk (a space and what follows)
    is counted on its own; a chunk that occurred before costs one look-up.  That holds unless white space precedes a
    space that white space or the end follows, or a special token's string occurs: such texts are cut into pre-tokens
    as a whole.
    """
    if path not in _loaded:
        _loaded[path] = (Merges(path), {})
    merges, known = _loaded[path]
    pieces_of = regex.compile(PRETOKEN).findall
    whole_runs = regex.compile(r"\p{White_Space} (?:\p{White_Space}|\Z)").search

    def learn(words: list[str]) -> None:
        # a word, or a word and one mark: the mark is a pre-token and a token of its own
        marked = [w for w in words if w[-1:] in (",", ".") and w[:-1].isalpha()]
        single = {w for w in words if w.isalpha()}
        single.update(w[:-1] for w in marked)
        single = list(single - known.keys())
        known.update(zip(single, merges.survivors([(" " + w).encode("utf-8") for w in single]).tolist()))
        known.update((w, known[w[:-1]] + 1) for w in marked)
        rest = [w for w in words if w not in known]
        pieces = [pieces_of(" " + w) for w in rest]
        distinct = list(set().union(*pieces))
        counts = dict(zip(distinct, merges.survivors([p.encode("utf-8") for p in distinct]).tolist()))
        known.update((w, sum(map(counts.__getitem__, p))) for w, p in zip(rest, pieces))

    def count(texts: list[str]) -> np.ndarray:
        totals, tails, odd, odd_of = np.zeros(len(texts), dtype=np.int64), [], [], []
        for k, text in enumerate(texts):
            parts = [text]
            if merges.split is not None and any(s in text for s in merges.special):
                parts = merges.split.split(text)
                totals[k] = len(parts) - 1
            for part in parts:
                if whole_runs(part):
                    pieces = pieces_of(part)
                else:
                    head, *tail = part.split(" ")
                    tails.append((k, tail))
                    pieces = pieces_of(head)
                odd.extend(pieces)
                odd_of.extend([k] * len(pieces))
        if len(known) > REMEMBERED:
            known.clear()
        learn(list(set().union(*(t for _, t in tails)) - known.keys()))
        for k, tail in tails:
            totals[k] += sum(map(known.__getitem__, tail))
        np.add.at(totals, np.array(odd_of, dtype=np.int64), merges.survivors([p.encode("utf-8") for p in odd]))
        return totals

    return count


def token_counts(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every row.

    ``tokenizer`` is the path of the file on every executor (None: the public byte-level file of the machine).  No
    begin, end or added tokens; a special token's string inside a text is that one token.  Null counts as empty: 0
    tokens.  Repeated rows stay; extra columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        count = counter(path)
        for batch in batches:
            column = batch.column(1)
            n_bytes = pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64)
            n = np.zeros(batch.num_rows, dtype=np.int64)
            # in pieces of some megabytes, so that a batch of long texts needs no more memory than one of short ones
            for at in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(np.cumsum(n_bytes) >> 22)) + 1):
                if len(at):
                    n[at] = count(texts_of(column.slice(at[0], len(at))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes), pa.array(n), pa.array(n > limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return spread_scan(source).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
