"""Embedding near-duplicates: signs of random hyperplanes in several tables, exact cosines, components.

Each table's key is the signs of ``bits`` hyperplanes.  Vectors that share a key in some table are compared by their
cosine in double precision; a pair that meets in several tables counts in the first of them only.  At a cosine of 0.93
a sign differs with probability 0.12, so 32 tables of 16 bits miss about one pair in a hundred there, and one in a
million at 0.98; the test measures it.  Copies are one class and are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexispark.llm.common import block_rows, connected_components, forest, group_pairs, scan_groups, spread_scan
from lexispark.session import materialize

TABLES = 32
BITS = 16
BLOCK = 512
SEED = 20


def hyperplanes(dim: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, tables * bits))


def signatures(vectors: np.ndarray, planes: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """The key of each vector in each table."""
    signs = (vectors @ planes >= 0).reshape(len(vectors), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _with_keys(classes: DataFrame, tables: int, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            dims = lists.value_lengths().to_numpy()
            keys = np.zeros((batch.num_rows, tables), dtype=np.int32)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                block = lists.take(pa.array(at)).flatten().to_numpy().astype(np.float64).reshape(len(at), dim)
                keys[at] = signatures(block, hyperplanes(int(dim), tables, bits), tables, bits)
            offsets = pa.array(np.arange(0, batch.num_rows * tables + 1, tables, dtype=np.int32))
            keyed = pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, keyed], [*batch.schema.names, "keys"])

    return spread_scan(classes).mapInArrow(run, "node long, label long, embedding array<double>, n long, keys array<int>")


def _links(keyed: DataFrame, least_cosine: float, block: int) -> DataFrame:
    """Rows (a, b, n): with b, a link that keeps components; without, ``n`` rows linked to class ``a``."""
    rows = keyed.select("node", "label", F.size("embedding").alias("dim"), F.posexplode("keys").alias("t", "key"))
    rows = rows.select("node", F.xxhash64("label", "dim", "t", "key").alias("bucket"), "t")
    # most buckets hold one class and need no vector
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("bucket")
    rows = materialize(rows.join(shared, "bucket"), "shared-buckets")
    rows = block_rows(rows, "bucket", "node", block)
    rows = rows.join(keyed.select("node", "label", "embedding", "n", "keys"), "node")

    def compare(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        size = batch.num_rows
        node, own, label, t, n = (batch.column(c).to_numpy() for c in ("node", "own", "label", "t", "n"))
        diagonal = batch.column("lo").to_numpy() == batch.column("hi").to_numpy()
        lists, keys = batch.column("embedding"), batch.column("keys")
        dims = lists.value_lengths().to_numpy()
        flat, first = lists.flatten().to_numpy(), np.cumsum(dims) - dims
        length = np.sqrt(np.add.reduceat(flat * flat, first)) if size else np.zeros(0)
        keys = keys.flatten().to_numpy().reshape(size, -1)
        added = np.zeros(size, dtype=np.int64)
        found = [(np.zeros(0, dtype=np.int64),) * 2]
        for all_i, all_j in group_pairs(starts, size):
            for a in range(0, len(all_i), 1 << 17):
                i, j = all_i[a : a + (1 << 17)], all_j[a : a + (1 << 17)]
                # a bucket is a hash: keep to equal labels, sizes and keys
                use = (diagonal[i] | (own[i] != own[j])) & (label[i] == label[j]) & (dims[i] == dims[j]) & (t[i] == t[j])
                i, j = i[use], j[use]
                cosine = np.empty(len(i))
                for dim in np.unique(dims[i]):
                    at = dims[i] == dim
                    span = np.arange(dim)
                    cosine[at] = np.einsum("pd,pd->p", flat[first[i[at], None] + span], flat[first[j[at], None] + span])
                ok = cosine >= least_cosine * length[i] * length[j]
                i, j = i[ok], j[ok]
                same = keys[i] == keys[j]
                new = same.any(1) & (same.argmax(1) == t[i])
                i, j = i[new], j[new]
                np.add.at(added, i, n[j])
                np.add.at(added, j, n[i])
                found.append(forest(size, i, j)[:2])
        i, j, _ = forest(size, *(np.concatenate(f) for f in zip(*found)))
        some = np.flatnonzero(added)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([node[i], node[some]])),
                pa.array(np.concatenate([node[j], node[some]]), mask=np.arange(len(i) + len(some)) >= len(i)),
                pa.array(np.concatenate([np.zeros(len(i), dtype=np.int64), added[some]])),
            ],
            ["a", "b", "n"],
        )

    return scan_groups(rows, ["bucket", "lo", "hi"], compare, "a long, b long, n long")


def near_duplicate_vectors(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
    least_cosine: float = 0.93, tables: int = TABLES, bits: int = BITS, block: int = BLOCK,
) -> DataFrame:
    """``id``, ``n_links`` (other vectors linked directly), ``component`` (smallest id reachable) and ``kept``.

    Vectors are compared when their labels are equal and not null (``label_col`` None: all with all).  Null, empty and
    zero vectors, vectors with null or non-finite components, of a null label or with a null id link with nothing.
    Repeated rows count as vectors of their own; two different vectors of one id are one node.  Extra columns are
    ignored; an empty table gives no rows.
    """
    label = F.col(label_col).cast("long") if label_col else F.lit(0).cast("long")
    rows = table.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(fine & F.col("label").isNotNull() & F.col("id").isNotNull(), F.lit(False))
    rows = rows.withColumn("usable", usable)
    classes = rows.where("usable").groupBy("label", "embedding").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n"))
    keyed = materialize(_with_keys(classes.select("node", "label", "embedding", "n"), tables, bits), "vector-keys")
    found = materialize(_links(keyed, least_cosine, block), "vector-links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("linked")).withColumnRenamed("a", "node")
    parts = connected_components(found.where("b is not null").select("a", "b"))
    classes = keyed.select("node", "label", "embedding", "n").join(counts, "node", "left").join(parts, "node", "left")
    classes = classes.select(
        "label", "embedding", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("links"), F.coalesce("component", "node").alias("root")
    )
    alone = rows.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    linked = rows.where("usable").join(classes, ["label", "embedding"]).select("id", F.col("links").alias("n_links"), F.col("root").alias("component"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(False)))
