"""Exact k nearest neighbours under cosine distance.

The join follows the pivot scheme of distributed kNN joins (Lu et al., PVLDB 5(10), 2012).
Training rows are grouped around a few pivots, and groups are packed into tiles.  A first pass
compares each query with the tile of its own group, which bounds its k-th similarity; by the
triangle inequality the second pass then visits only tiles, and in them only groups, that can
still hold a better row.  A task compares two tiles of bounded size, a dense block of them at a
time, and returns at most k rows per query, never its pairs.  What is shuffled is each row once
for each tile of the other side.

Equal vectors are compared once: only the first k rows (by label, then key) of a vector
can be among the k nearest, and equal queries share one result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from lexispark.functions.arithmetic import l2_normalized
from lexispark.functions.hashing import seeded_key
from lexispark.operators.ranking import spread_join
from lexispark.session import bounded_broadcast, materialize

BLOCK_ROWS = 1024
QUERIES_AT_ONCE = 1024
MAX_PIVOTS = 256
# Rows, and numbers in them, of one side of a tile: what a task holds of it, sparse.
TILE_ROWS = 1 << 17
TILE_VALUES = 10_000_000
CELLS_AT_ONCE = 1 << 21
# Numbers in the dense form of one block, or of all pivots; wide vectors get smaller blocks.
MAX_DENSE_CELLS = 16_000_000
SIM_DIGITS = 9
ZERO_DISTANCE = 1e-9
# Slack for the bounds; it covers the rounding of similarities and of the angles.
SLACK = 1e-7
# Group of the training rows without any feature: their similarity to everything is 0.
EMPTY_CELL = -1


def dense_rows(df: DataFrame, vector: str) -> DataFrame:
    """Unit-length rows in the sparse layout ``idx, w`` from an array column."""
    unit = l2_normalized(F.col(vector))
    has_length = F.exists(F.col(vector), lambda x: x != 0)
    return (
        df.withColumn("w", F.when(has_length, unit).otherwise(F.array().cast("array<double>")))
        .withColumn("idx", F.when(F.size("w") > 0, F.sequence(F.lit(0), F.size("w") - 1))
                    .otherwise(F.array().cast("array<int>")))
    )


def _vector_key() -> Column:
    return F.md5(F.to_json(F.struct("idx", "w")).cast("binary"))


def _matrix(idx: pd.Series, w: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(idx), dim))
    if len(idx):
        lengths = idx.map(len).to_numpy()
        if lengths.sum():
            out[np.repeat(np.arange(len(idx)), lengths), np.concatenate(idx.to_numpy())] = np.concatenate(w.to_numpy())
    return out


def _pivot_sims(rows: pd.DataFrame, pivots: np.ndarray) -> np.ndarray:
    """Similarity of each row to each pivot, without a dense form of the rows."""
    out = np.zeros((len(rows), len(pivots)))
    for i, (idx, w) in enumerate(zip(rows["idx"], rows["w"])):
        if len(idx):
            out[i] = pivots[:, idx] @ w
    return out


def _distinct_train(train: DataFrame, key: str, label: str, k: int) -> DataFrame:
    """One row per vector with the ``labels`` and ``ids`` of its first ``k`` rows."""
    first = Window.partitionBy("vec").orderBy(label, key)
    return (
        train.select("idx", "w", label, key, _vector_key().alias("vec"))
        .withColumn("_rn", F.row_number().over(first))
        .where(F.col("_rn") <= k)
        .groupBy("vec")
        .agg(
            F.any_value("idx").alias("idx"),
            F.any_value("w").alias("w"),
            F.sort_array(F.collect_list(F.struct(F.col(label).alias("label"), F.col(key).alias("id")))).alias("members"),
        )
        .select("vec", "idx", "w", F.col("members.label").alias("labels"), F.col("members.id").alias("ids"))
    )


def _cells(train: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Nearest pivot of each training vector and the angle to it."""
    schema = T.StructType([*train.schema.fields, T.StructField("cell", T.IntegerType()),
                           T.StructField("angle", T.DoubleType())])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            empty = (pdf["idx"].map(len) == 0).to_numpy()
            if len(pivots):
                sims = _pivot_sims(pdf, pivots)
                cell, best = sims.argmax(axis=1), sims.max(axis=1)
            else:
                cell, best = np.zeros(len(pdf), int), np.zeros(len(pdf))
            yield pdf.assign(
                cell=np.where(empty, EMPTY_CELL, cell).astype("int32"),
                angle=np.where(empty, 0.0, np.arccos(np.clip(best, -1.0, 1.0))),
            )

    return train.mapInPandas(assign, schema)


def _values(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a list column end to end, and where each row begins."""
    flat = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(flat), 0).to_numpy(zero_copy_only=False)
    return pc.list_flatten(flat).to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


class _Side:
    """Rows of one side of a tile, sparse; only a block of them at a time is made dense."""

    def __init__(self, table: pa.Table):
        self.idx, self.start = _values(table.column("idx"))
        self.w = _values(table.column("w"))[0]

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.start)

    def at(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the numbers of ``rows``, and the position in ``rows`` of each."""
        lengths = self.lengths[rows]
        owner = np.repeat(np.arange(len(rows)), lengths)
        return np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(self.start[rows], lengths), owner

    def dense(self, rows: np.ndarray, dim: int, kind: type) -> np.ndarray:
        out = np.zeros((len(rows), dim), dtype=kind)
        at, owner = self.at(rows)
        out[owner, self.idx[at]] = self.w[at]
        return out


def _exact(asked: np.ndarray, q: np.ndarray, side: _Side, rows: np.ndarray) -> np.ndarray:
    """Similarity in double precision of the pairs ``(asked[q], rows)``, a bounded number of cells at a time."""
    out = np.zeros(len(q))
    cells = np.cumsum(side.lengths[rows])
    for part in np.split(np.arange(len(q)), np.flatnonzero(np.diff(cells // CELLS_AT_ONCE)) + 1):
        at, owner = side.at(rows[part])
        out[part] = np.bincount(owner, asked[q[part][owner], side.idx[at]] * side.w[at], len(part))
    return np.round(out, SIM_DIGITS)


def _tile_top(queries: pa.Table, rows: pa.Table, centres: np.ndarray, radius: np.ndarray, dim: int, k: int,
              block_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, row, sim)`` of the ``k`` best rows of one tile for each query, by similarity and first label and key,
    if they are no worse than the query's bound ``kth``.

    Blocks are compared in single precision; whatever its rounding leaves open is computed in double precision.
    ``centres`` and ``radius`` belong to the cells 0, 1, ...; rows of the cell ``EMPTY_CELL`` have no feature.
    """
    asked, side = _Side(queries), _Side(rows)
    first = pa.table({c: pc.list_element(rows.column(f"{c}s").combine_chunks(), 0) for c in ("label", "id")})
    order = pc.sort_indices(first, [("label", "ascending"), ("id", "ascending")], null_placement="at_end").to_numpy().astype(np.int64)
    place = np.empty(len(order), dtype=np.int64)  # order of the rows by their first label and key
    place[order] = np.arange(len(order))
    cell, limit = rows.column("cell").to_numpy(), queries.column("kth").to_numpy()
    blocks = []
    for c in np.unique(cell):
        own = order[cell[order] == c]
        blocks += [(c, own[a : a + block_rows]) for a in range(0, len(own), block_rows)]
    longest = max(int(asked.lengths.max()), int(side.lengths.max()))
    eps = (longest + 8) * 2.0**-22 + 10.0**-SIM_DIGITS
    cells = np.unique(cell[cell != EMPTY_CELL])
    found = []
    step = max(1, min(QUERIES_AT_ONCE, MAX_DENSE_CELLS // (4 * dim)))
    near = np.zeros((len(limit), len(cells)))
    for a in range(0, len(limit), step):
        some = np.arange(a, min(a + step, len(limit)))
        near[some] = asked.dense(some, dim, np.float64) @ centres[cells].T
    # queries of one block are near the same cell, so that their bounds close early
    turn = np.argsort(near.argmax(axis=1), kind="stable") if len(cells) else np.arange(len(limit))
    for a in range(0, len(turn), step):
        some = turn[a : a + step]
        exact = asked.dense(some, dim, np.float64)
        single = exact.astype(np.float32)
        closest = np.cos(np.maximum(0.0, np.arccos(np.clip(near[some], -1.0, 1.0)) - radius[cells]))
        closest[asked.lengths[some] == 0] = np.inf  # no angle: every cell counts
        reach = dict(zip(cells, closest.T))
        reach[EMPTY_CELL] = np.zeros(len(some))
        sims, best = np.full((len(some), k), -np.inf), np.full((len(some), k), -1)
        by_mean = dict(zip(cells, near[some].mean(axis=0)))
        for c, block in sorted(blocks, key=lambda b: -by_mean.get(b[0], -2.0)):
            bound = np.maximum(limit[some], sims[:, -1])
            live = np.flatnonzero(reach[c] >= bound - SLACK)
            if not len(live):
                continue
            rough = (single if len(live) == len(some) else single[live]) @ side.dense(block, dim, np.float32).T
            hit = np.flatnonzero(rough.max(axis=1) >= bound[live] - eps)
            if not len(hit):
                continue
            live, rough = live[hit], rough[hit]
            least = bound[live]
            if len(block) > k:
                least = np.maximum(least, np.partition(rough, len(block) - k, axis=1)[:, len(block) - k] - eps)
            q, at = np.nonzero(rough >= (least - eps)[:, None])
            q, at = live[q], block[at]
            sim = _exact(exact, q, side, at)
            held_q, held = np.nonzero(best[live] >= 0)
            q = np.concatenate([q, live[held_q]])
            at = np.concatenate([at, best[live][held_q, held]])
            sim = np.concatenate([sim, sims[live][held_q, held]])
            ranked = np.lexsort((place[at], -sim, q))
            q, at, sim = q[ranked], at[ranked], sim[ranked]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            top = rank < k
            sims[q[top], rank[top]], best[q[top], rank[top]] = sim[top], at[top]
        q, rank = np.nonzero((best >= 0) & (sims >= limit[some][:, None]))
        found.append((some[q], best[q, rank], sims[q, rank]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _tile_join(tiles: DataFrame, asked: DataFrame, centres: np.ndarray, radius: np.ndarray, dim: int, k: int,
               block_rows: int, part_rows: int) -> DataFrame:
    """Compare each query of ``asked(vec, idx, w, kth, tiles)`` with the training rows of its tiles.

    A tile with many queries is compared in parts, and its training rows go to each of them.  A row of either side is
    sent once for each tile of the other, never once for each block.
    """
    spark = tiles.sparkSession
    # a fixed number of partitions: a tile is little data but much arithmetic, so small ones must not be merged
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    sent = asked.withColumn("tile", F.explode("tiles")).drop("tiles")
    load = materialize(asked.select(F.explode("tiles").alias("tile")).groupBy("tile").agg(F.count("*").alias("_n")), "knn-load")
    load = bounded_broadcast(load.select("tile", F.ceil(F.col("_n") / F.lit(float(part_rows))).cast("int").alias("_parts")), load.count())
    sent = sent.join(load, "tile").withColumn("part", F.pmod(F.xxhash64("vec"), F.col("_parts")).cast("int"))
    rows = tiles.join(load, "tile").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    labels, ids = tiles.schema["labels"], tiles.schema["ids"]
    schema = T.StructType([T.StructField("vec", T.StringType()), T.StructField("sim", T.DoubleType()), labels, ids])
    kinds = [to_arrow_type(f.dataType) for f in (labels, ids)]
    shared = spark.sparkContext.broadcast((centres, radius))

    def compare(q: pa.Table, t: pa.Table) -> pa.Table:
        if q.num_rows and t.num_rows:
            at, row, sim = _tile_top(q, t, *shared.value, dim, k, block_rows)
            found = [q.column("vec").take(pa.array(at)), pa.array(sim), *(t.column(c).take(pa.array(row)) for c in ("labels", "ids"))]
        else:
            found = [pa.array([], pa.string()), pa.array([], pa.float64()), *(pa.array([], kind) for kind in kinds)]
        return pa.table(found, names=["vec", "sim", "labels", "ids"])

    place = [n, "tile", "part"]
    found = (
        sent.select("tile", "part", "vec", "idx", "w", "kth").repartition(*place).groupBy("tile", "part")
        .cogroup(rows.select("tile", "part", "cell", "idx", "w", "labels", "ids").repartition(*place).groupBy("tile", "part"))
        .applyInArrow(compare, schema)
    )
    members = F.explode(F.arrays_zip(F.col("labels").alias("label"), F.col("ids").alias("id"))).alias("m")
    return _best(found.select("vec", "sim", members).select("vec", "sim", "m.label", "m.id"), k)


def _best(candidates: DataFrame, k: int) -> DataFrame:
    """The ``k`` first candidates of each query; tasks drop the others before the shuffle."""
    order = Window.partitionBy("vec").orderBy(F.desc("sim"), "label", "id")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _packed(sizes: dict[int, tuple[int, int]], tile_rows: int) -> dict[int, tuple[int, int]]:
    """First tile and number of tiles of each cell, given its rows and numbers; small cells share a tile."""
    out, tile, rows, values = {}, -1, 0, 0
    for cell in sorted(sizes):
        n, v = sizes[cell]
        parts = max(ceil(n / tile_rows), ceil(v / TILE_VALUES))
        if tile < 0 or parts > 1 or rows + n > tile_rows or values + v > TILE_VALUES:
            tile, rows, values = tile + 1, 0, 0
        out[cell] = (tile, parts)
        if parts > 1:
            tile, rows, values = tile + parts - 1, tile_rows, TILE_VALUES
        else:
            rows, values = rows + n, values + v
    return out


def _tile_sizes(asked: tuple[int, int], n_train: int, tile_rows: int, cores: int) -> tuple[int, int]:
    """Rows of a tile of queries, given their rows and numbers, and of training rows.

    Small tables are cut on both sides, as far as all cores get work with the fewest copies; large ones by the limits.
    """
    n, values = max(1, asked[0]), asked[1]
    tiles = ceil(sqrt(2 * cores * n_train / n))
    parts = max(ceil(2 * cores / max(1, tiles)), ceil(n / tile_rows), ceil(values / TILE_VALUES))
    return max(QUERIES_AT_ONCE, ceil(n / parts)), min(tile_rows, max(BLOCK_ROWS, ceil(n_train / max(1, min(tiles, 2 * cores)))))


def _nearest(train: DataFrame, queries: DataFrame, key: str, label: str, dim: int, k: int, block_rows: int,
             seed: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(vec, sim, label, id, rank)`` for distinct query vectors ``(vec, idx, w)``."""
    if k < 1:
        raise ValueError("k must be positive")
    distinct = materialize(_distinct_train(train, key, label, k), "knn-train")
    block_rows = max(1, min(block_rows, MAX_DENSE_CELLS // dim))
    n_pivots = max(1, min(MAX_PIVOTS, MAX_DENSE_CELLS // dim, ceil(distinct.count() / block_rows)))
    chosen = (
        distinct.where(F.size("idx") > 0).orderBy(seeded_key(seed, "vec")).limit(n_pivots).select("idx", "w")
        .toArrow().to_pandas()
    )
    pivots = _matrix(chosen["idx"], chosen["w"], dim)

    celled = materialize(_cells(distinct, pivots), "knn-cells")
    stats = {r["cell"]: r for r in celled.groupBy("cell").agg(
        F.count("*").alias("n"), F.sum(F.size("idx")).alias("v"), F.max("angle").alias("radius")).collect()}
    asked_size = queries.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("idx")), F.lit(0)).alias("v")).first()
    part_rows, tile_rows = _tile_sizes((asked_size["n"], asked_size["v"]), sum(r["n"] for r in stats.values()), tile_rows,
                                       train.sparkSession.sparkContext.defaultParallelism)
    where = _packed({c: (r["n"], r["v"]) for c, r in stats.items()}, tile_rows)
    first_tile, n_tiles_of = (F.element_at(F.create_map(*[F.lit(int(x)) for c, t in where.items() for x in (c, t[i])]), F.col("cell"))
                              for i in (0, 1)) if where else (F.lit(0), F.lit(1))
    tiles = celled.withColumn("tile", (first_tile + F.pmod(F.xxhash64("vec"), n_tiles_of)).cast("int"))
    n_tiles = max((t + parts for t, parts in where.values()), default=0)
    live = np.array(sorted(c for c in stats if c != EMPTY_CELL), dtype=int)
    radius = np.zeros(len(pivots))
    radius[live] = [stats[c]["radius"] for c in live]
    centres = pivots if len(pivots) else np.zeros((0, dim))

    def home_tiles(vec: pd.Series, sims: np.ndarray) -> np.ndarray:
        if not len(live):
            return np.zeros(len(vec), dtype=np.int32)
        spans = np.array([where[c] for c in live])[sims[:, live].argmax(axis=1)]
        return (spans[:, 0] + vec.str[:8].map(lambda x: int(x, 16)).to_numpy() % spans[:, 1]).astype(np.int32)

    def homes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            home = home_tiles(pdf["vec"], _pivot_sims(pdf, centres))
            yield pdf.assign(kth=-2.0, tiles=[[t] for t in home])

    asked = "vec string, idx array<int>, w array<double>, kth double, tiles array<int>"
    limits = (centres, radius, dim, k, block_rows, part_rows)
    first = _tile_join(tiles, materialize(queries.mapInPandas(homes, asked), "knn-homes"), *limits)
    first = materialize(first, "knn-first")
    if n_tiles <= 1:
        return first

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sims = _pivot_sims(pdf, centres)
            kth = pdf["kth"].to_numpy()
            closest = np.cos(np.maximum(0.0, np.arccos(np.clip(sims, -1.0, 1.0)) - radius))
            reach = closest >= kth[:, None] - SLACK
            reach |= (pdf["idx"].map(len) == 0).to_numpy()[:, None]  # no angle: every group counts
            seen = np.zeros((len(pdf), n_tiles), dtype=bool)
            for c in live:
                seen[:, where[c][0] : sum(where[c])] |= reach[:, [c]]
            if EMPTY_CELL in where:
                seen[:, where[EMPTY_CELL][0]] |= kth <= SLACK
            seen[np.arange(len(pdf)), home_tiles(pdf["vec"], sims)] = False
            yield pdf.assign(tiles=[np.flatnonzero(s).astype(np.int32) for s in seen])

    kth = first.where(F.col("rank") == k).select("vec", F.col("sim").alias("kth"))
    bounded = queries.join(kth, "vec", "left").select("vec", "idx", "w", F.coalesce("kth", F.lit(-2.0)).alias("kth"))
    later = _tile_join(tiles, materialize(bounded.mapInPandas(visits, asked), "knn-visits"), *limits)
    return materialize(_best(first.drop("rank").unionByName(later.drop("rank")), k), "knn-nearest")


def _distinct_queries(test: DataFrame) -> DataFrame:
    grouped = test.select(_vector_key().alias("vec"), "idx", "w").groupBy("vec")
    return materialize(grouped.agg(F.any_value("idx").alias("idx"), F.any_value("w").alias("w")), "knn-queries")


def knn_neighbours(train: DataFrame, test: DataFrame, key: str, label: str, dim: int, k: int = 2,
                   block_rows: int = BLOCK_ROWS, seed: int = 0, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(key, neighbour, label, distance, rank)`` of the ``k`` nearest training rows.

    ``train`` and ``test`` hold unit-length rows in the layout ``idx, w``.
    """
    near = _nearest(train, _distinct_queries(test), key, label, dim, k, block_rows, seed, tile_rows)
    near = near.withColumnsRenamed({"id": "_id", "label": "_label"})
    return spread_join(test.select(key, _vector_key().alias("vec")), near, ["vec"], [key], "inner").select(
        key,
        F.col("_id").alias("neighbour"),
        F.col("_label").alias(label),
        (F.lit(1.0) - F.col("sim")).alias("distance"),
        "rank",
    )


def vote(neighbours: DataFrame, key: str, label: str, weighting: str = "distance", out: str = "predicted") -> DataFrame:
    """Label with the most votes; ties go to the smaller label.

    With ``distance`` a neighbour counts ``1 / distance``, unless some distance is 0:
    then those neighbours count 1 and the others nothing.
    """
    if weighting == "uniform":
        voted = neighbours.withColumn("_v", F.lit(1.0))
    else:
        zero = F.col("distance") < ZERO_DISTANCE
        any_zero = F.max(zero).over(Window.partitionBy(key))
        voted = neighbours.withColumn(
            "_v", F.when(any_zero, zero.cast("double")).otherwise(F.lit(1.0) / F.col("distance")))
    return (
        voted.groupBy(key, label).agg(F.round(F.sum("_v"), SIM_DIGITS).alias("_votes"))
        .groupBy(key).agg(F.min_by(label, F.struct(-F.col("_votes"), F.col(label))).alias(out))
    )


def knn_predict(train: DataFrame, test: DataFrame, key: str, label: str, dim: int, k: int = 2,
                weighting: str = "distance", keep: tuple[str, ...] = (), block_rows: int = BLOCK_ROWS, seed: int = 0,
                out: str = "predicted", tile_rows: int = TILE_ROWS) -> DataFrame:
    """``(key, keep..., predicted)``; the vote is taken once per distinct vector."""
    near = _nearest(train, _distinct_queries(test), key, label, dim, k, block_rows, seed, tile_rows)
    near = near.withColumn("distance", F.lit(1.0) - F.col("sim"))
    votes = vote(near, "vec", "label", weighting, out)
    asked = test.select(key, *keep, _vector_key().alias("vec"))
    return spread_join(asked, votes, ["vec"], [key], "inner").select(key, *keep, out)
