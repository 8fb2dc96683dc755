"""Features inside the row: a document is one row from its terms to its scores.

Terms are counted, weighted, brought to unit length and scored where the document lies.  The vocabulary and the class
weights are of bounded size and go to the tasks; all that is shuffled is the aggregate by term.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from lexispark.operators.vocabulary import TfidfConfig, terms_column
from lexispark.session import BROADCAST_ROWS

# Terms, or terms times classes, that a task works on at a time.
AT_ONCE = 1 << 18


def fits_row(cfg: TfidfConfig) -> bool:
    """Whether the vocabulary is bounded and small enough to be sent to the tasks."""
    return cfg.max_features is not None and cfg.max_features <= BROADCAST_ROWS


def _schema(df: DataFrame, kept: Sequence[str], added: str) -> T.StructType:
    return T.StructType([*(df.schema[c] for c in kept), *T.StructType.fromDDL(added)])


def _slices(lengths: np.ndarray, cells: int = 1) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``AT_ONCE`` cells; a longer row is alone."""
    a, total = 0, np.concatenate([[0], np.cumsum(lengths * cells)])
    while a < len(lengths):
        b = max(a + 1, int(np.searchsorted(total, total[a] + AT_ONCE, side="right")) - 1)
        yield a, b
        a = b


def _flat(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The values of a list column end to end, and the row of each; null lists are empty."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return pc.list_flatten(column), np.repeat(np.arange(len(column)), lengths)


def _lists(values: pa.Array, row: np.ndarray, n: int) -> pa.Array:
    """Lists by row from values sorted by it."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), values)


def counted_rows(docs: DataFrame, text: str, cfg: TfidfConfig = TfidfConfig(), keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., terms array<string>, tf array<long>)``: each document's distinct terms with their counts."""
    source = docs.select(*keep, terms_column(F.col(text), cfg).alias("terms"))
    names = [*keep, "terms", "tf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in _slices(pc.fill_null(pc.list_value_length(whole.column("terms")), 0).to_numpy(zero_copy_only=False)):
                batch = whole.slice(a, b - a)
                terms, row = _flat(batch.column("terms"))
                coded = terms.dictionary_encode()
                size = max(1, len(coded.dictionary))
                pairs, tf = np.unique(row * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
                of = pairs // size
                found = [_lists(coded.dictionary.take(pa.array(pairs % size)), of, len(batch)), _lists(pa.array(tf.astype(np.int64)), of, len(batch))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names)

    return source.mapInArrow(run, _schema(source, keep, "terms array<string>, tf array<long>"))


def long_counts(counted: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``(keep..., term, tf)`` of counted rows."""
    return counted.select(*keep, F.explode(F.arrays_zip("terms", "tf")).alias("_t")).select(
        *keep, F.col("_t.terms").alias("term"), F.col("_t.tf").alias("tf"))


def weighted_rows(counted: DataFrame, vocab: DataFrame, cfg: TfidfConfig = TfidfConfig(), keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., idx array<int>, w array<double>)``: TF-IDF rows of unit length, positions in order of rank.

    Position 0 is the most frequent term.  Documents without a known term get empty arrays.
    """
    if not fits_row(cfg):
        raise ValueError(f"the vocabulary is not bounded by {BROADCAST_ROWS} terms")
    table = vocab.select("term", "rank", "idf").toArrow()
    shared = counted.sparkSession.sparkContext.broadcast(
        (table.column("term").combine_chunks(), table.column("rank").to_numpy().astype(np.int64) - 1, table.column("idf").to_numpy()))
    sublinear, source, names = cfg.sublinear_tf, counted.select(*keep, "terms", "tf"), [*keep, "idx", "w"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank, idf = shared.value
        for batch in batches:
            terms, row = _flat(batch.column("terms"))
            tf = _flat(batch.column("tf"))[0].to_numpy(zero_copy_only=False).astype(np.float64)
            at = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False)
            fits = at >= 0
            at, row, tf = at[fits], row[fits], tf[fits]
            raw = (1.0 + np.log(tf) if sublinear else tf) * idf[at]
            order = np.lexsort((rank[at], row))
            row, idx, raw = row[order], rank[at][order], raw[order]
            w = raw / np.sqrt(np.bincount(row, raw * raw, len(batch)))[row]
            found = [_lists(pa.array(idx.astype(np.int32)), row, len(batch)), _lists(pa.array(w), row, len(batch))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names) - 2], *found], names)

    return source.mapInArrow(run, _schema(source, keep, "idx array<int>, w array<double>"))


def swept_rows(rows: DataFrame, sizes: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """``(size, keep..., idx, w)``: the rows for the first ``size`` terms of the vocabulary alone, for each size, brought to
    unit length again."""
    source, names = rows.select(*keep, "idx", "w"), ["size", *keep, "idx", "w"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, row = _flat(batch.column("idx"))
            at, w = at.to_numpy(zero_copy_only=False), _flat(batch.column("w"))[0].to_numpy(zero_copy_only=False)
            for size in sizes:
                fits = at < size
                of, v = row[fits], w[fits]
                v = v / np.sqrt(np.bincount(of, v * v, len(batch)))[of]
                found = [_lists(pa.array(at[fits]), of, len(batch)), _lists(pa.array(v), of, len(batch))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(batch), size, dtype=np.int64)), *batch.columns[:-2], *found], names)

    schema = T.StructType([T.StructField("size", T.LongType()), *source.schema])
    return source.mapInArrow(run, schema)


def truncated(rows: DataFrame, size: int) -> DataFrame:
    """``swept_rows`` for one size, with all other columns of ``rows``."""
    return swept_rows(rows, [size], [c for c in rows.columns if c not in ("idx", "w")]).drop("size")


def long_weights(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``(keep..., rank, w)`` of weighted rows; ``rank`` starts at 1."""
    return rows.select(*keep, F.explode(F.arrays_zip("idx", "w")).alias("_t")).select(
        *keep, (F.col("_t.idx") + 1).alias("rank"), F.col("_t.w").alias("w"))


def sparse_product(idx: pa.Array, w: pa.Array, theta: np.ndarray) -> np.ndarray:
    """Rows times ``theta(feature, class)``, a bounded number of cells at a time."""
    out = np.zeros((len(idx), theta.shape[1]))
    for a, b in _slices(pc.fill_null(pc.list_value_length(idx), 0).to_numpy(zero_copy_only=False), theta.shape[1]):
        at, row = _flat(idx.slice(a, b - a))
        cells = theta[at.to_numpy(zero_copy_only=False)] * _flat(w.slice(a, b - a))[0].to_numpy(zero_copy_only=False)[:, None]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        if len(first):
            out[a + row[first]] = np.add.reduceat(cells, first, axis=0)
    return out


def scored_rows(rows: DataFrame, theta: np.ndarray, bias: Sequence[float] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., scores)`` of rows ``(idx, w)`` for ``theta(feature, class)``; an empty row gets the bias."""
    start = np.zeros(theta.shape[1]) if bias is None else np.asarray(bias, dtype=float)
    shared = rows.sparkSession.sparkContext.broadcast((np.ascontiguousarray(theta), start))
    source, names = rows.select(*keep, "idx", "w"), [*keep, "scores"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        theta, start = shared.value
        for batch in batches:
            scores = sparse_product(batch.column("idx"), batch.column("w"), theta) + start
            offsets = pa.array(np.arange(len(batch) + 1) * theta.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names) - 1], pa.ListArray.from_arrays(offsets, pa.array(scores.ravel()))], names)

    return source.mapInArrow(run, _schema(source, keep, "scores array<double>"))


def theta_matrix(theta: DataFrame, n_features: int, n_classes: int) -> np.ndarray:
    """``theta(rank, theta)`` as a matrix (feature, class); features without a row get 0."""
    table = theta.select("rank", "theta").toArrow()
    out = np.zeros((n_features, n_classes))
    if table.num_rows:
        out[table.column("rank").to_numpy() - 1] = pc.list_flatten(table.column("theta")).to_numpy().reshape(-1, n_classes)
    return out
