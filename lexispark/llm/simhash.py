"""SimHash near-duplicates, found with the pigeonring principle.

A fingerprint is cut into a ring of segments.  If two fingerprints differ in at most ``t`` bits over ``m`` segments,
some segment starts a chain whose differences stay within the proportional budget at every length: at most
``l * t / m`` in its first ``l`` segments.  Two searches are built on that:

* ``ring_links`` (64 bits, few differing bits): no link is lost.  Two rings are nested: an equal 16-bit segment out of
  four, and an equal 12-bit segment out of the four that the other 48 bits make.  Their 28 bits are the join key, so
  buckets stay small up to billions of fingerprints; the chains of both rings are tested before the full distance.
* ``similar_documents`` (many lanes, a similarity of 0.8): at that similarity no equal segment is certain, but each of
  ``16 * lanes / 4`` segments gives a chance.  Rows carry the next 64 bits of the ring, on which the chain is
  tested; only the pairs that pass are compared over the whole width.  A candidate is not yet a link: a forest of
  unverified ones would lose true pairs that close a cycle of false ones, so what a dense block holds beyond its forest
  is compared again until verified links join it or no pair is left.

Equal fingerprints are one node, so copies are never compared.  A bucket is split into bounded blocks, and each block
gives a spanning forest of its verified links, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lexispark.llm.common import block_rows, connected_components, forest, group_pairs, scan_groups, spread_scan
from lexispark.session import fits_broadcast, materialize

BLOCK = 1024
SEED = 42
CHUNK = 1 << 16
#: Bits of 64 that two texts may differ in before they are no longer linked, in the narrow search.
NARROW_BITS = 3
#: Candidate pairs a row up to which a group of the wide search hands on all of its pairs.
DENSE = 4
#: Shingle sets that a task keeps while it verifies pairs.
SETS = 1024
#: What a row is compared by, besides its node and component.
MEMBER = ("bucket", "tail", "own", "lo", "hi")
GROUP = ["bucket", "lo", "hi"]


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included; A-Z lower-cased, words split at ASCII white space."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    shingles = map(b" ".join, zip(*(parts[k:] for k in range(words)))) if len(parts) > words else (b" ".join(parts),)
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64)


def bit_majority(h: np.ndarray) -> int:
    """The fingerprint: a bit is 1 if it is set in over half of the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, len(h), CHUNK):
        ones += np.unpackbits(h[a : a + CHUNK].astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


def lane_hashes(h: np.ndarray, lane: int) -> np.ndarray:
    """The hashes of another lane: lane 0 are ``h``, others are ``h`` mixed with the lane's number."""
    if not lane:
        return h
    with np.errstate(over="ignore"):
        x = h + np.uint64(lane) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, lanes: int = 1) -> DataFrame:
    """One row per row of ``docs``: ``id`` and ``bits`` (array of ``lanes`` longs).  Null text is empty: all zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, lanes), dtype=np.uint64)
            for r in range(batch.num_rows):
                h = shingle_hashes(batch.column(1)[r].as_py() or "", words)
                for lane in range(lanes if len(h) else 0):
                    out[r, lane] = bit_majority(lane_hashes(h, lane))
            flat = pa.array(out.reshape(-1).view(np.int64))
            offsets = pa.array(np.arange(0, batch.num_rows * lanes + 1, lanes, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], ["id", "bits"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return spread_scan(source).mapInArrow(run, "id long, bits array<long>")


def set_fingerprints(docs: DataFrame, words: int, lanes: int) -> DataFrame:
    """``id``, ``digest`` (of the text), ``node`` (of the set of its shingles) and ``bits`` of rows ``docs(id, text)``.

    Each shingle has one vote, however often the text repeats it, as in a similarity of sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, out = np.zeros(batch.num_rows, dtype=np.uint64), np.zeros((batch.num_rows, lanes), dtype=np.uint64)
            for r in range(batch.num_rows):
                h = np.unique(shingle_hashes(batch.column(2)[r].as_py() or "", words))
                nodes[r] = _set_digest(h)
                for lane in range(lanes if len(h) else 0):
                    out[r, lane] = bit_majority(lane_hashes(h, lane))
            offsets = pa.array(np.arange(0, batch.num_rows * lanes + 1, lanes, dtype=np.int32))
            bits = pa.ListArray.from_arrays(offsets, pa.array(out.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(nodes.view(np.int64)), bits], ["id", "digest", "node", "bits"])

    return spread_scan(docs.select("id", F.xxhash64("text").alias("digest"), "text")).mapInArrow(run, "id long, digest long, node long, bits array<long>")


def _set_digest(distinct: np.ndarray) -> int:
    """One number for a set of shingles, from their sorted hashes."""
    return xxhash.xxh3_64_intdigest(distinct.tobytes())


def _ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int16)


def _chain(x: np.ndarray, width: int, ring: int, total: int) -> np.ndarray:
    """Whether the chain of segments after an equal one at the top of ``ring`` bits stays within its budgets."""
    m = ring // width
    ok, seen = np.ones(len(x), dtype=bool), np.zeros(len(x), dtype=np.int16)
    for length in range(2, m + 1):
        shift = np.uint64(ring - length * width)
        seen = seen + _ones((x >> shift) & np.uint64((1 << width) - 1))
        ok &= seen * m <= length * total
    return ok


def _rotl(x: np.ndarray, by: np.ndarray, width: int) -> np.ndarray:
    by = by.astype(np.uint64)
    mask = np.uint64((1 << width) - 1) if width < 64 else ~np.uint64(0)
    return np.where(by == 0, x, ((x << by) | (x >> (np.uint64(width) - by))) & mask)


def ring_links(nodes: DataFrame, max_bits: int = NARROW_BITS, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` that span the components of fingerprints ``nodes(bits long)`` within ``max_bits`` of 64."""
    if not 0 <= max_bits <= 3:
        raise ValueError("four segments find links of at most 3 differing bits")
    bits = F.col("bits")

    def rotated(by: int):
        return F.shiftleft(bits, by).bitwiseOR(F.shiftrightunsigned(bits, 64 - by)) if by else bits

    keys = []
    for outer in range(4):
        turned = rotated(16 * outer)
        head, ring = F.shiftrightunsigned(turned, 48), turned.bitwiseAND(F.lit((1 << 48) - 1))
        for inner in range(4):
            part = F.shiftrightunsigned(ring, 36 - 12 * inner).bitwiseAND(F.lit(0xFFF))
            keys.append(F.shiftleft(head, 12).bitwiseOR(part).bitwiseOR(F.lit((outer * 4 + inner) << 28)))
    rows = nodes.select("bits", F.explode(F.array(*keys)).alias("bucket"))
    rows = block_rows(rows, "bucket", "bits", block)

    def links(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        n = batch.num_rows
        v = batch.column("bits").to_numpy().view(np.uint64)
        table = batch.column("bucket").to_numpy() >> 28
        own = batch.column("own").to_numpy()
        diagonal = batch.column("lo").to_numpy() == batch.column("hi").to_numpy()
        found = [(np.zeros(0, dtype=np.int64),) * 2]
        for i, j in group_pairs(starts, n):
            use = diagonal[i] | (own[i] != own[j])
            i, j = i[use], j[use]
            x, t = v[i] ^ v[j], table[i]
            turned = _rotl(x, 16 * (t // 4), 64)
            ok = _chain(turned, 16, 64, max_bits)
            i, j, x, t, turned = i[ok], j[ok], x[ok], t[ok], turned[ok]
            ok = _chain(_rotl(turned & np.uint64((1 << 48) - 1), 12 * (t % 4), 48), 12, 48, max_bits)
            i, j, x = i[ok], j[ok], x[ok]
            ok = _ones(x) <= max_bits
            found.append(forest(n, i[ok], j[ok])[:2])
        i, j, _ = forest(n, *(np.concatenate(f) for f in zip(*found)))
        s = v.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(s[i]), pa.array(s[j])], ["a", "b"])

    return scan_groups(rows, ["bucket", "lo", "hi"], links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, max_bits: int = NARROW_BITS) -> DataFrame:
    """``id``, ``fingerprint`` (16 hexadecimal digits) and ``component`` (smallest id reachable) of every row.

    Fingerprints link at ``max_bits`` or fewer differing bits.  Null or empty texts have fingerprint zero and link
    like any other.  A row with a null id takes part; it never names a component unless all ids of it are null (then
    the component is null).  Repeated rows stay repeated; extra columns are ignored; an empty table gives no rows.
    """
    marked = fingerprints(docs, id_col, text_col, words).select("id", F.col("bits")[0].alias("bits"))
    marked = materialize(marked, "fingerprints")
    nodes = materialize(marked.groupBy("bits").agg(F.min("id").alias("rep")), "distinct-fingerprints")
    linked = connected_components(ring_links(nodes.select("bits"), max_bits))
    named = _component_ids(nodes, "bits", linked)
    return marked.join(named, "bits").select(
        "id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component"
    )


def _component_ids(nodes: DataFrame, key: str, linked: DataFrame) -> DataFrame:
    """Smallest id of each node's component; ``nodes(key, rep)``, ``linked(node, component)``."""
    rooted = nodes.join(linked.withColumnRenamed("node", key), key, "left")
    rooted = materialize(rooted.select(key, "rep", F.coalesce("component", key).alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    return rooted.join(least, "root").select(key, "component")


def _segments(nodes: DataFrame, lanes: int, part: tuple[int, int] | None = None) -> DataFrame:
    """One row per 16-bit segment of ``nodes(node, component, bits array<long>)``, with the 64 bits that follow it in the ring.

    ``part`` is a range of lanes (None: all).
    """
    per_lane = 4
    pieces = []
    for lane in range(*(part or (0, lanes))):
        this, after = F.col("bits")[lane], F.col("bits")[(lane + 1) % lanes]
        for s in range(per_lane):
            by = 16 * (s + 1)
            head = F.shiftrightunsigned(this, 48 - 16 * s).bitwiseAND(F.lit(0xFFFF))
            tail = after if by == 64 else F.shiftleft(this, by).bitwiseOR(F.shiftrightunsigned(after, 64 - by))
            pieces.append(F.struct(head.bitwiseOR(F.lit((lane * per_lane + s) << 16)).cast("int").alias("bucket"), tail.alias("tail")))
    return nodes.select("node", "component", F.explode(F.array(*pieces)).alias("p")).select("node", "component", "p.bucket", "p.tail")


def _chained(batch: pa.RecordBatch, starts: np.ndarray, budget: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows of distinct components whose chains stay within ``budget`` bits a segment, and the bits they differ in."""
    tail = batch.column("tail").to_numpy().view(np.uint64)
    component, own = batch.column("component").to_numpy(), batch.column("own").to_numpy()
    diagonal = batch.column("lo").to_numpy() == batch.column("hi").to_numpy()
    for i, j in group_pairs(starts, batch.num_rows):
        use = (diagonal[i] | (own[i] != own[j])) & (component[i] != component[j])
        i, j = i[use], j[use]
        x, seen = tail[i] ^ tail[j], np.zeros(len(i), dtype=np.int64)
        for length in range(2, 6):
            seen = seen + _ones((x >> np.uint64(80 - 16 * length)) & np.uint64(0xFFFF))
            ok = seen <= length * budget
            i, j, x, seen = i[ok], j[ok], x[ok], seen[ok]
        yield i, j, seen


def wide_candidates(rows: DataFrame, budget: float, forests: bool = True) -> DataFrame:
    """Pairs ``(a, b)`` that the groups of ``rows`` (of ``_segments``, in blocks) have to be compared by, and the groups that are
    not settled by them (``bucket``, ``lo``, ``hi``; ``a`` and ``b`` null).

    A group of at most ``DENSE`` pairs a row gives all of them.  A denser one gives a spanning forest of its pairs to
    leading nodes (none without ``forests``) and itself, in one row: its rows are found again by that, when the forest has
    been verified.  Every block of a bucket but its first gives itself as well, for the pairs across blocks.
    """

    def run(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        n = batch.num_rows
        size = np.diff(np.append(starts, n))
        group, passed = np.repeat(np.arange(len(starts)), size), np.zeros(len(starts), dtype=np.int64)
        found, node = [(np.zeros(0, dtype=np.int64),) * 3], batch.column("node").to_numpy()

        def thin(i: np.ndarray, j: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, ...]:
            many = (passed > DENSE * size)[group[i]]
            few, rest = (i[~many], j[~many], seen[~many]), (i[many], j[many], seen[many])
            return tuple(np.concatenate(x) for x in zip(few, _to_leaders(node, *rest, 2.5 * budget))) if forests else few

        for i, j, seen in _chained(batch, starts, budget):
            passed += np.bincount(group[i], minlength=len(starts))
            found.append(thin(i, j, seen))
        i, j, _ = thin(*(np.concatenate(f) for f in zip(*found)))
        left = passed > DENSE * size
        if forests:
            left |= batch.column("own").to_numpy()[starts] > 0
        groups = batch.select(GROUP).take(pa.array(starts[left]))
        pairs = [pa.array(np.maximum(node[i], node[j])), pa.array(np.minimum(node[i], node[j])), *(pa.nulls(len(i), c.type) for c in groups.columns)]
        rest = [*[pa.nulls(groups.num_rows, pa.int64())] * 2, *groups.columns]
        return pa.RecordBatch.from_arrays([pa.concat_arrays([x, y]) for x, y in zip(pairs, rest)], ["a", "b", *GROUP])

    return scan_groups(rows.select("node", "component", *MEMBER), GROUP, run, "a long, b long, bucket int, lo int, hi int")


def _within(pairs: DataFrame, nodes: DataFrame, max_bits: int) -> DataFrame:
    """The pairs ``(a, b)`` that differ in at most ``max_bits`` of the whole width, and the bits they differ in."""
    side = nodes.select("node", "bits")
    pairs = pairs.join(side.select(F.col("node").alias("a"), F.col("bits").alias("x")), "a")
    pairs = pairs.join(side.select(F.col("node").alias("b"), F.col("bits").alias("y")), "b")
    apart = F.aggregate(F.zip_with("x", "y", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, d: s + d)
    return pairs.select("a", "b", apart.alias("apart")).where(F.col("apart") <= max_bits)


def _of(rows: DataFrame, keys: DataFrame, by: list[str]) -> DataFrame:
    """The rows of these ``keys``."""
    return rows.join(F.broadcast(keys) if fits_broadcast(keys) else keys, by, "left_semi")


def _named(rows: DataFrame, linked: DataFrame | None) -> DataFrame:
    """``rows`` with the component of each node so far."""
    if linked is None:
        return rows.withColumn("component", F.col("node"))
    return rows.drop("component").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _open_rows(rows: DataFrame, keys: DataFrame, by: list[str]) -> DataFrame:
    """The rows of the groups in ``keys`` that are not one component."""
    rows = materialize(_of(rows, materialize(keys.distinct(), "wide-left"), by), "wide-members")
    split = rows.groupBy(*by).agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select(*by)
    return materialize(_of(rows, materialize(split, "wide-split"), by), "wide-open")


def _dense_links(rows: DataFrame, budget: float, words: int, similarity: float) -> DataFrame:
    """Links that span the open groups: each pair is compared by its shingle sets where its texts are together.

    Nothing is left out: a pair is passed over only if verified links join its ends already.
    """

    def run(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        for start, end in zip(starts, np.append(starts[1:], batch.num_rows)):
            part = batch.slice(start, end - start)
            sets = [_shingle_set(t.as_py(), words) for t in part.column("text")]
            size = np.array([len(p) for p in sets])
            node, component = part.column("node").to_pylist(), part.column("component").to_pylist()
            root = {c: c for c in component}

            def find(c: int) -> int:
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            for i, j, _ in _chained(part, np.zeros(1, dtype=np.int64), budget):
                ok = np.minimum(size[i], size[j]) >= similarity * np.maximum(size[i], size[j])
                for x, y in zip(i[ok].tolist(), j[ok].tolist()):
                    u, v = find(component[x]), find(component[y])
                    if u != v and _similar(sets[x], sets[y], similarity):
                        root[u] = v
                        a.append(node[x])
                        b.append(node[y])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return scan_groups(rows.select("node", "component", *MEMBER, "text"), GROUP, run, "a long, b long")


def _shingle_set(text: str | None, words: int) -> frozenset:
    return frozenset(shingle_hashes(text or "", words).tolist())


def _similar(p: frozenset, q: frozenset, similarity: float) -> bool:
    shared = len(p & q)
    return shared >= similarity * (len(p) + len(q) - shared)


def _to_leaders(node: np.ndarray, i: np.ndarray, j: np.ndarray, apart: np.ndarray, near: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A spanning forest of the links that ties rows to the smallest node they may link to, ``near`` ones first.

    The same node leads its copies in every segment and every pair of blocks it is in, so the links of all of them are
    the same few and merge.
    """
    n = len(node)
    order = np.lexsort((np.maximum(node[i], node[j]), np.minimum(node[i], node[j]), apart > near))
    i, j, apart = i[order], j[order], apart[order]
    a, b, at = forest(n, i, j)
    return a, b, apart[at]


def _jaccard(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose sets of word shingles have at least this similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a text of a hot template is in many pairs
        shingles = lru_cache(SETS)(lambda text: _shingle_set(text, words))
        for batch in batches:
            keep = [_similar(shingles(x.as_py()), shingles(y.as_py()), similarity) for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))

    pairs = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
    pairs = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _parts(lanes: int) -> list[tuple[int, int]]:
    """Ranges of lanes that are compared one after the other: one lane, some, the rest."""
    cuts = sorted({0, min(1, lanes), min(4, lanes), lanes})
    return list(zip(cuts[:-1], cuts[1:]))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8, lanes: int = 16, block: int = BLOCK) -> DataFrame:
    """``id``, ``digest`` (of the text), ``component`` and ``first`` (digest of the component's text of the smallest id)
    of every row, for word-shingle similarities from ``similarity`` up.

    Two sets of Jaccard similarity s have about the cosine 2s / (1 + s), and a SimHash bit differs with the probability
    angle / pi.  Over ``64 * lanes`` bits, distances up to three standard deviations above what ``similarity`` gives are
    compared by the shingle sets, and link if those have that similarity; no link rests on fingerprints alone.  Texts of
    the same set are one node.  Rows with a null id are not compared and keep a null component; other cases are as in
    ``near_duplicates``.
    """
    total = 64 * lanes
    differs = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    max_bits = int(total * differs + 3 * (total * differs * (1 - differs)) ** 0.5)
    budget = max_bits / (total // 16)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    marked = materialize(set_fingerprints(rows, words, lanes), "wide-fingerprints")
    named = marked.where("id is not null").groupBy("node").agg(F.min(F.struct("id", "digest")).alias("r"), F.first("bits").alias("bits"))
    nodes = materialize(named.select("node", F.col("r.id").alias("rep"), F.col("r.digest").alias("digest"), "bits"), "wide-nodes")

    def texts_of_nodes(asked: DataFrame) -> DataFrame:
        # ids go to the texts while they are few, so that only texts that are compared are shuffled
        asked = materialize(nodes.join(asked.distinct(), "node", "left_semi").select("node", F.col("rep").alias("id"), "digest"), "wide-asked")
        found = rows.withColumn("digest", F.xxhash64("text")).join(F.broadcast(asked) if fits_broadcast(asked) else asked, ["id", "digest"])
        return found.groupBy("node").agg(F.first("text").alias("text"))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = materialize(_within(pairs.distinct(), nodes, max_bits).select("a", "b"), "wide-links")
        texts = texts_of_nodes(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        return _jaccard(pairs, texts, words, similarity)

    def compared(segments: DataFrame, links: DataFrame | None, forests: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
        """All verified links after these segments, the components they make, and the groups that are left."""
        found = materialize(wide_candidates(segments, budget, forests), "wide-candidates")
        new = materialize(verified(found.where("b is not null").select("a", "b")), "wide-verified")
        links = new if links is None else links.unionByName(new)
        return links, materialize(connected_components(links), "wide-components"), found.where("b is null").select(*GROUP)

    # near copies meet in most segments; those that the first lanes join are one component when the others are compared.
    # A row is compared in its own block of a bucket at first: what the blocks join needs no comparison across them
    links = linked = left = None
    for part in _parts(lanes):
        segments = block_rows(_segments(_named(nodes, linked), lanes, part), "bucket", "node", block, across=False)
        links, linked, dense = compared(segments, links, True)
        left = dense if left is None else left.unionByName(dense)
    segments = _open_rows(_segments(_named(nodes, linked), lanes), left.select("bucket"), ["bucket"])
    if segments.take(1):
        segments = materialize(block_rows(segments, "bucket", "node", block), "wide-blocks")
        links, linked, left = compared(segments, links, False)
        segments = _open_rows(_named(segments, linked), left, GROUP)
        if segments.take(1):
            texts = texts_of_nodes(segments.select("node"))
            links = links.unionByName(materialize(_dense_links(segments.join(texts, "node"), budget, words, similarity), "wide-dense"))
            linked = connected_components(links)
    rooted = nodes.join(linked, "node", "left").select("node", "rep", "digest", F.coalesce("component", "node").alias("root"))
    rooted = materialize(rooted, "wide-rooted")
    least = rooted.groupBy("root").agg(F.min(F.struct("rep", "digest")).alias("first"))
    named = rooted.join(least, "root").select("node", F.col("first.rep").alias("component"), F.col("first.digest").alias("first"))
    known = F.col("id").isNotNull()
    return marked.join(named, "node", "left").select("id", "digest", *(F.when(known, F.col(c)).alias(c) for c in ("component", "first")))
