"""How text filters interact: what each removes alone, after others, and over all orders.

A document is measured by a byte transducer.  Each byte has a class; a table gives, for the state and the class, the next
state and what is emitted: a word begins, a word ends, a capital, a code point, a symbol.  The state after a byte follows
from the byte's class alone, so one pass of table lookups over all bytes of many documents does what a loop would.  The
word spans go into one open-addressing table: a slot is taken by the first span that claims it, and a later span of
the same hash is the same word only if its document, its length and its bytes are equal.

The audit never needs the texts again.  Documents become counts by part, set of failed filters and labels; all orders
of the filters follow from those.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lexispark.llm.common import spread_scan
from lexispark.session import fits_broadcast, materialize

SYMBOLS = b"#$%&*|"
#: Bytes of texts that are measured together; a longer text is measured alone.
TOGETHER = 4 << 20
#: Bytes of a word up to which eight are hashed and compared at a time for all words at once.
SHORT = 64
#: All orders are listed, so their number has to be bounded.
MAX_FILTERS = 6

# Classes of bytes, states, and what is emitted.
BLANK, CAPITAL, SYMBOL, PLAIN, LEAD, TAIL, BETWEEN = range(7)
OUTSIDE, INSIDE = range(2)
BEGINS, ENDS, IS_CAPITAL, IS_POINT, IS_SYMBOL = 1, 2, 4, 8, 16
#: Never part of UTF-8: stands between two texts.
SEPARATOR = 0xFF


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    classes = np.full(256, PLAIN, dtype=np.uint8)
    classes[[0x20, *range(0x09, 0x0E)]] = BLANK
    classes[ord("A") : ord("Z") + 1] = CAPITAL
    classes[list(SYMBOLS)] = SYMBOL
    classes[0x80:0xC0] = TAIL
    classes[0xC0:0xFF] = LEAD
    classes[SEPARATOR] = BETWEEN
    step, emit = np.zeros((2, 7), dtype=np.uint8), np.zeros((2, 7), dtype=np.uint8)
    points = {CAPITAL: IS_CAPITAL, SYMBOL: IS_SYMBOL, PLAIN: 0, LEAD: 0}
    for state in (OUTSIDE, INSIDE):
        for kind in range(7):
            blank = kind in (BLANK, BETWEEN)
            step[state, kind] = OUTSIDE if blank else INSIDE
            word = (ENDS if state == INSIDE else 0) if blank else (BEGINS if state == OUTSIDE else 0)
            emit[state, kind] = word | (IS_POINT if kind == BLANK or kind in points else 0) | points.get(kind, 0)
    if (step[0] != step[1]).any():
        raise AssertionError("the state has to follow from the last byte")
    return classes, step[0], emit


CLASSES, NEXT, EMIT = _tables()
MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
MEASURES = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def _emissions(data: np.ndarray) -> np.ndarray:
    """What the transducer emits at each byte; ``data`` begins a text and ends with a separator."""
    out, before = np.empty(len(data), dtype=np.uint8), OUTSIDE
    for a in range(0, len(data), TOGETHER):
        kind = CLASSES[data[a : a + TOGETHER]]
        state = NEXT[kind]
        came = np.concatenate([[before], state[:-1]]).astype(np.uint8)
        out[a : a + TOGETHER] = EMIT[came, kind]
        before = state[-1]
    return out


def _eight(windows: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Up to eight bytes from each position, as one number."""
    return np.ascontiguousarray(windows[at]).view("<u8")[:, 0] & MASKS[np.minimum(left, 8)]


def _hashes(data: np.ndarray, windows: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        live, at = np.flatnonzero(size <= SHORT), 0
        while len(live):
            h[live] = (h[live] ^ _eight(windows, start[live] + at, size[live] - at)) * np.uint64(0xBF58476D1CE4E5B9)
            h[live] ^= h[live] >> np.uint64(29)
            at += 8
            live = live[size[live] > at]
    for k in np.flatnonzero(size > SHORT):
        h[k] = xxhash.xxh64_intdigest(data[start[k] : start[k] + size[k]].tobytes())
    return h


def _equal(data: np.ndarray, windows: np.ndarray, start: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether spans ``a`` and ``b``, of equal size each, hold the same bytes."""
    ok = np.ones(len(a), dtype=bool)
    live, at = np.flatnonzero(size[a] <= SHORT), 0
    while len(live):
        x, y = a[live], b[live]
        same = _eight(windows, start[x] + at, size[x] - at) == _eight(windows, start[y] + at, size[y] - at)
        ok[live] = same
        at += 8
        live = live[same & (size[x] > at)]
    for k in np.flatnonzero(size[a] > SHORT):
        x, y, n = start[a[k]], start[b[k]], size[a[k]]
        ok[k] = np.array_equal(data[x : x + n], data[y : y + n])
    return ok


def first_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Positions of one span for each distinct (group, bytes); ``data`` has eight spare bytes after the last span."""
    size = end - start
    windows = np.lib.stride_tricks.sliding_window_view(data, 8)
    h = _hashes(data, windows, start, size)
    bits = max(4, int(2 * len(start)).bit_length())
    with np.errstate(over="ignore"):
        key = (h ^ (group.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0x94D049BB133111EB)
    slot = (key >> np.uint64(64 - bits)).astype(np.int64)
    owner_of = np.full(1 << bits, -1, dtype=np.int64)
    open_, found = np.arange(len(start)), []
    while len(open_):
        at = slot[open_]
        free = owner_of[at] < 0
        owner_of[at[free]] = open_[free]
        owner = owner_of[at]
        own = owner == open_
        found.append(open_[own])
        open_, owner = open_[~own], owner[~own]
        alike = (h[owner] == h[open_]) & (size[owner] == size[open_]) & (group[owner] == group[open_])
        again = np.zeros(len(open_), dtype=bool)
        again[alike] = _equal(data, windows, start, size, open_[alike], owner[alike])
        open_ = open_[~again]
        slot[open_] = (slot[open_] + 1) & ((1 << bits) - 1)
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def measure_texts(texts: list[bytes]) -> np.ndarray:
    """One row of ``MEASURES`` for each text."""
    if not texts:
        return np.zeros((0, len(MEASURES)), dtype=np.int64)
    mark = bytes([SEPARATOR])
    data = np.frombuffer(mark.join(texts) + mark + bytes(8), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    first = ends - [len(t) + 1 for t in texts]
    emitted = _emissions(data[:-8])
    out = np.zeros((len(texts), len(MEASURES)), dtype=np.int64)
    for k, flag in ((0, BEGINS), (2, IS_CAPITAL), (3, IS_POINT), (4, IS_SYMBOL)):
        out[:, k] = np.add.reduceat((emitted & flag) > 0, first, dtype=np.int64)
    start, end = np.flatnonzero(emitted & BEGINS), np.flatnonzero(emitted & ENDS)
    text = np.searchsorted(ends, start, side="right")
    out[:, 1] = np.bincount(text[first_spans(data, start, end, text)], minlength=len(texts))
    return out


def measures(docs: DataFrame, carried: dict[str, Column], text_col: str = "text") -> DataFrame:
    """The ``carried`` columns of each row of ``docs`` and the ``MEASURES`` of its text (longs).

    Words are maximal runs without ASCII white space, compared as written; capitals are A-Z; symbols are ``SYMBOLS``;
    null text counts as empty.  Rows are kept as they are, repeated ones too; an empty table gives no rows.
    """
    names = list(carried)
    rows = docs.select(*(c.alias(f"c{k}") for k, c in enumerate(carried.values())), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    columns = [*rows.columns[:-1], *MEASURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, a = batch.column("text").to_pylist(), 0
            while a < len(texts):
                b, held = a + 1, len(texts[a])
                while b < len(texts) and held + len(texts[b]) <= TOGETHER:
                    held, b = held + len(texts[b]), b + 1
                found = measure_texts(texts[a:b])
                old = [batch.column(k).slice(a, b - a) for k in range(len(columns) - len(MEASURES))]
                yield pa.RecordBatch.from_arrays([*old, *map(pa.array, found.T)], columns)
                a = b

    schema = rows.drop("text").schema
    for m in MEASURES:
        schema = schema.add(m, "long")
    found = spread_scan(rows).mapInArrow(run, schema)
    return found.select(*(F.col(f"c{k}").alias(n) for k, n in enumerate(names)), *MEASURES)


def failing(conditions: dict[str, Column]) -> Column:
    """The set of filters a row fails, as bits in the order given."""
    bits = [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions.values())]
    return sum(bits[1:], bits[0]).cast("int")


def default_conditions() -> dict[str, Column]:
    """When a measured row fails each filter that looks at its own text."""
    c = F.col
    return {
        "A": c("n_words") < 200,
        "B": 100 * c("n_distinct") < 50 * c("n_words"),
        "C": 100 * c("n_capitals") > 2 * c("n_points"),
        "D": c("n_symbols") > 0,
    }


def failures(
    docs: DataFrame, labels: DataFrame, conditions: dict[str, Column], copies: str | None = "E",
    id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
) -> DataFrame:
    """``part``, ``failed`` (bits in the order of ``conditions``, then ``copies``), ``n``, ``n_good`` and ``n_toxic``.

    ``copies`` names the filter that a row fails if a smaller id has the same text anywhere in the table (by SHA-256);
    None leaves it out.  A null id is no smaller than any and never fails it.  A null part is the empty string.  A row is
    good or toxic if any of ``labels(doc_id, quality, toxic)`` with its id says so.  Repeated rows count each.
    """
    carried = {"part": F.coalesce(F.col(part_col).cast("string"), F.lit("")), "id": F.col(id_col).cast("long")}
    if copies is not None:
        carried["digest"] = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    rows = measures(docs, carried, text_col).withColumn("failed", failing(conditions))
    keys = [c for c in ("part", "digest", "failed") if c in rows.columns]
    # repeated rows are one row from here on, and copies are one row of each part before they are shuffled again
    rows = rows.groupBy(*keys, "id").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    marks = materialize(marks.where("id is not null and (good or toxic)"), "marked-ids")
    rows = rows.join(F.broadcast(marks) if fits_broadcast(marks) else marks, "id", "left").na.fill(False, ["good", "toxic"])
    counts = F.sum("n").alias("n")
    if copies is not None:
        first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first")
        unnamed = F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("unnamed")
        rows = materialize(rows.groupBy(*keys, "good", "toxic").agg(counts, first, unnamed), "copies-by-part")
        least = rows.groupBy("digest").agg(F.min("first.id").alias("least"))
        rows = rows.join(least, "digest")
        passing = F.col("unnamed") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
        bit = 1 << len(conditions)
        split = F.array(F.struct(passing.alias("n"), F.lit(0).alias("bit")), F.struct((F.col("n") - passing).alias("n"), F.lit(bit).alias("bit")))
        rows = rows.select("part", "failed", "good", "toxic", F.explode(split).alias("s")).where("s.n > 0")
        rows = rows.select("part", (F.col("failed") + F.col("s.bit")).alias("failed"), "good", "toxic", F.col("s.n").alias("n"))
    return rows.groupBy("part", "failed").agg(
        counts, F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("n_good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("n_toxic")
    )


def audit(failed: DataFrame, letters: str) -> DataFrame:
    """One row for each part, order of the filters and step, from ``failures``.

    Columns ``part``, ``filter_order``, ``step`` (from 1) and, for the filter of that step: ``kept``, ``removed``,
    ``redundant`` (fails it, removed earlier), ``unique_fails`` (fails it alone), ``good_lost``, ``toxic_lost`` and
    ``shapley`` (removed by it, summed over all orders).  What a step does depends on its filter and the set before it
    only, so each such pair is counted once.  No rows give no rows.
    """
    if not 1 <= len(letters) <= MAX_FILTERS or len(set(letters)) != len(letters):
        raise ValueError(f"1 to {MAX_FILTERS} distinct filters are needed")
    bit = {c: 1 << k for k, c in enumerate(letters)}
    orders = [(o, k + 1, bit[c], sum(bit[x] for x in o[:k])) for o in map("".join, permutations(letters)) for k, c in enumerate(o)]
    steps = F.array(*(F.struct(F.lit(f).alias("own"), F.lit(s).alias("before")) for f, s in sorted({o[2:] for o in orders})))
    rows = failed.select("*", F.explode(steps).alias("s")).select("*", "s.own", "s.before")
    hit, gone = F.col("failed").bitwiseAND(F.col("own")) != 0, F.col("failed").bitwiseAND(F.col("before")) != 0
    here = hit & ~gone

    def total(which: Column, n: str, name: str) -> Column:
        return F.sum(F.when(which, F.col(n)).otherwise(0)).cast("long").alias(name)

    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    rows = rows.groupBy("part", "own", "before").agg(
        total(~hit & ~gone, "n", "kept"), total(here, "n", "removed"), total(hit & gone, "n", "redundant"),
        total(F.col("failed") == F.col("own"), "n", "unique_fails"), total(here, "n_good", "good_lost"), total(here, "n_toxic", "toxic_lost"),
    )
    # a set of j filters stands before the filter in j! orders, the others after it in (k - 1 - j)!
    ways = F.element_at(F.array(*(F.lit(factorial(j) * factorial(len(letters) - 1 - j)) for j in range(len(letters)))), F.bit_count("before") + 1)
    rows = rows.groupBy("part", "own").agg(F.sum(F.col("removed") * ways).cast("long").alias("shapley"), F.collect_list(F.struct("before", *names)).alias("sets"))
    rows = rows.select("part", "own", "shapley", F.explode("sets").alias("s")).select("part", "own", "shapley", "s.*")
    listed = failed.sparkSession.createDataFrame(orders, "filter_order string, step int, own int, before int")
    return rows.join(F.broadcast(listed), ["own", "before"]).select("part", "filter_order", "step", *names, "shapley")


def interaction_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``audit`` of the four default filters and the filter of copies over ``docs``."""
    conditions = default_conditions()
    return audit(failures(docs, labels, conditions, "E", id_col, text_col, part_col), "".join(conditions) + "E")
