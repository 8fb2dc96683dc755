"""What the operators of this package share: columns by name, groups of bounded size, forests and components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lexispark.session import fits_broadcast, materialize

PAIRS_AT_ONCE = 2_000_000
#: Buckets above the block size up to which their sizes are written into the plan.
HOT_BUCKETS = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(id_col: str, folds: int):
    """The fold of a row: crc32 of its id written as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def result_schema(rows: DataFrame, computed: str, carried: Iterable[str]) -> T.StructType:
    """``id`` as in ``rows``, the computed columns, and the carried ones as in ``rows``."""
    return T.StructType([rows.schema["id"], *T.StructType.fromDDL(computed), *(rows.schema[c] for c in carried)])


def spread_scan(df: DataFrame) -> DataFrame:
    """For work that is heavy per byte: a table of fewer splits than there are cores is dealt out evenly."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def block_rows(rows: DataFrame, bucket: str, member: str, block: int, across: bool = True) -> DataFrame:
    """Split the buckets of ``rows`` so that no group has more than about ``2 * block`` rows.

    A bucket of ``n`` rows gets ``ceil(n / block)`` blocks; each pair of blocks is one group, and a row goes to
    all groups of its block.  Adds ``own`` (the row's block), ``lo`` and ``hi`` (the pair).  Only buckets above
    ``block`` rows are copied at all, so the rows grow by the number of blocks of the hot ones alone.  Without
    ``across`` a row goes to the group of its own block only, which differs from bucket to bucket.
    """
    hot = materialize(
        rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block), "hot-buckets"
    )
    if not hot.take(1):
        return rows.withColumns({"own": F.lit(0), "lo": F.lit(0), "hi": F.lit(0)})
    found = [] if across else hot.limit(HOT_BUCKETS + 1).collect()
    if found and len(found) <= HOT_BUCKETS:
        # the rows of all other buckets are not joined
        sizes = F.create_map(*(F.lit(x) for r in found for x in r))
        dealt = rows.withColumn("_n", F.when(F.col(bucket).isin([r[0] for r in found]), sizes[F.col(bucket)]))
    else:
        dealt = rows.join(F.broadcast(hot) if fits_broadcast(hot) else hot, bucket, "left")
    dealt = dealt.withColumn("_b", F.coalesce(F.ceil(F.col("_n") / block), F.lit(1)).cast("int"))
    if not across:
        dealt = dealt.withColumn("own", F.pmod(F.xxhash64(F.lit(7), F.col(bucket), F.col(member)), F.col("_b")).cast("int"))
        return dealt.withColumns({"lo": F.col("own"), "hi": F.col("own")}).drop("_n", "_b")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64(F.lit(7), F.col(member)), F.col("_b")).cast("int"))
    dealt = dealt.withColumn("_y", F.explode(F.sequence(F.lit(0), F.col("_b") - 1)))
    return dealt.withColumns({"lo": F.least("own", "_y"), "hi": F.greatest("own", "_y")}).drop("_n", "_b", "_y")


def scan_groups(rows: DataFrame, keys: list[str], fn: Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """Bring equal ``keys`` together and hand ``fn`` batches of whole groups with the groups' first positions.

    Groups arrive sorted, so a batch holds many small ones; only the last, unfinished group is carried over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            batch = wide_strings(batch)
            whole = batch if rest is None or not rest.num_rows else joined_batches([rest, batch])
            if not whole.num_rows:
                continue
            starts = _starts(whole, keys)
            rest = whole.slice(starts[-1])
            if starts[-1]:
                yield fn(whole.slice(0, starts[-1]), starts[:-1])
        if rest is not None and rest.num_rows:
            yield fn(rest, np.zeros(1, dtype=np.int64))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def wide_strings(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with 64-bit offsets in its string columns, so that a group may hold more than 2 GB of text."""
    wide = [c.cast(pa.large_string()) if pa.types.is_string(c.type) else c for c in batch.columns]
    return pa.RecordBatch.from_arrays(wide, batch.schema.names)


def joined_batches(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """All rows of the batches in one; an error rather than a second chunk."""
    chunks = pa.Table.from_batches(batches).combine_chunks().to_batches()
    if len(chunks) != 1 or chunks[0].num_rows != sum(b.num_rows for b in batches):
        raise ValueError("a group does not fit one batch")
    return chunks[0]


def _starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    new = np.zeros(batch.num_rows, dtype=bool)
    new[0] = True
    for k in keys:
        v = batch.column(k).to_numpy(zero_copy_only=False)
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def group_pairs(starts: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (i, j), j before i, within the groups that begin at ``starts``; in pieces of bounded size."""
    first = np.repeat(starts, np.diff(np.append(starts, n)))
    rank = np.arange(n) - first
    ends = np.cumsum(rank)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS_AT_ONCE, side="right")))
        r = rank[a:b]
        i = np.repeat(np.arange(a, b), r)
        if len(i):
            j = np.repeat(first[a:b], r) + np.arange(len(i)) - np.repeat(np.cumsum(r) - r, r)
            yield i, j
        a = b


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links that span the same components as the links (i, j) among ``n`` members, fewer than ``n`` of them.

    In each round every component takes its first link to another one (Boruvka's rounds), so among links sorted by
    distance the shortest are taken.  Also returns the positions of those links.
    """
    label, at = np.arange(n), np.arange(len(i))
    kept = [at[:0]]
    while len(at):
        a, b = label[i[at]], label[j[at]]
        cross = a != b
        at, a, b = at[cross], a[cross], b[cross]
        if not len(at):
            break
        pick, order = np.full(n, len(at)), np.arange(len(at))
        np.minimum.at(pick, a, order)
        np.minimum.at(pick, b, order)
        e = np.unique(pick[pick < len(at)])
        kept.append(at[e])
        root = np.arange(n)
        while True:
            low = np.minimum(root[a[e]], root[b[e]])
            np.minimum.at(root, a[e], low)
            np.minimum.at(root, b[e], low)
            root = root[root]
            if (root[a[e]] == root[b[e]]).all():
                break
        label = root[label]
    at = np.concatenate(kept)
    return i[at], j[at], at


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``edges(a, b)``: columns ``node``, ``component``.

    Alternating large and small stars: a link is moved to the smallest neighbour of its end until all that is
    left are stars.  Each round is two aggregates with partial sums and two joins; it is written to the shared
    folder, so a lost executor costs the tasks of one round.  Nodes without a link don't appear.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges.distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select("a", F.col("m").alias("b")).unionByName(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = materialize(small.distinct(), "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    leaves = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return leaves.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
