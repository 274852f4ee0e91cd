"""SimHash near-duplicates: exact pairs through vantage-point trees, then components.

A fingerprint takes the majority of each bit over the XXH64 values of the word
shingles. Equal fingerprints are one point. A vantage-point tree, fitted on a
bounded sample, cuts the points into shards by their Hamming distance to the
vantage points: the near side keeps distances up to ``radius``, the far side
those above it, and points up to ``bits`` beyond the radius also stand on the
near side. By the triangle inequality two points within ``bits`` then meet in
at least one shard. A shard is searched by a tree of the same kind and hands on
a spanning forest of its links, never all pairs.

Memory: a shard holds 8 bytes a point. Points that all lie within a few bits of
each other cannot be cut by any vantage point; such a shard is cut into hashed
blocks, and every pair of blocks is a group of its own, compared in tiles of
TILE x TILE. Its time grows with the square of its *distinct* fingerprints,
spread over tasks; the memory of a task does not grow.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import int64s, slices, text_hash, texts, without
from opslake.llm.components import components
from opslake.sources.scratch import saved, shared_dir

SEED = 42
TILE = 1024
_CHUNK = 1 << 16


def fingerprint(text: bytes, words: int = 3) -> int:
    """64-bit SimHash of the shingles of ``words`` words; 0 without words.

    A-Z are lower-cased, words are cut at ASCII white space. Fewer words than a
    shingle: the whole sequence is the one shingle. Repeats count.
    """
    w = text.lower().split()
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _CHUNK):  # bounded however long the text is
        stop = min(n, start + _CHUNK)
        grams = map(join, zip(*(w[start + k : stop + k] for k in range(words)), strict=True)) if len(w) >= words else [join(w)]
        h = np.array([digest(g, SEED) for g in grams], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for k in range(0, len(bits), 255):  # sums of 255 bits fit a byte, which is quick
            ones += np.add.reduce(bits[k : k + 255], axis=0, dtype=np.uint8)
    return sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp is the fingerprint as a signed long. A NULL text is an empty one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(fps)], names=["doc_id", "text_hash", "fp"])

    rows = texts(docs, id_col, text_col, text_hash(text_col).alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@dataclass
class Tree:
    """Inner nodes in order; a child below 0 is shard -child - 1."""

    vantage: np.ndarray
    radius: np.ndarray
    near: np.ndarray
    far: np.ndarray

    def shards(self, points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``points``, shard) of each point and shard that it stands in."""
        if not len(self.vantage):
            return np.arange(len(points)), np.zeros(len(points), np.int64)
        at, to, todo = [], [], [(0, np.arange(len(points)))]
        while todo:
            node, index = todo.pop()
            if not len(index):
                continue
            d = np.bitwise_count(points[index] ^ self.vantage[node])
            for child, keep in ((self.near[node], d <= self.radius[node] + bits), (self.far[node], d > self.radius[node])):
                if child < 0:
                    at.append(index[keep])
                    to.append(np.full(len(at[-1]), -child - 1))
                else:
                    todo.append((int(child), index[keep]))
        return np.concatenate(at), np.concatenate(to)


def _cut(points: np.ndarray, rng: np.random.Generator, bits: int) -> tuple[np.uint64, int, np.ndarray, np.ndarray] | None:
    """A vantage point of ``points`` with the radius that makes the larger side smallest; None if no cut helps."""
    best = None
    for v in points[rng.integers(0, len(points), 4)]:
        d = np.bitwise_count(points ^ v)
        below = np.cumsum(np.bincount(d, minlength=65 + bits))
        larger = np.maximum(below[bits : 65 + bits], len(points) - below[:65])
        r = int(np.argmin(larger))
        if best is None or larger[r] < best[0]:
            best = (larger[r], v, r, d)
    larger, v, r, d = best
    return None if larger > 0.85 * len(points) else (v, r, d <= r + bits, d > r)


def fit_tree(sample: np.ndarray, total: int, shard_points: int, bits: int, seed: int = SEED) -> Tree:
    """Tree over a sample of ``total`` points whose shards hold about ``shard_points``.

    A node is cut until its share of the sample says that it is small enough, or
    until no vantage point cuts it. Any sample gives exact pairs; a poor one
    gives uneven shards.
    """
    rng, share = np.random.default_rng(seed), total / max(1, len(sample))
    vantage, radius, near, far = [], [], [], []
    todo, shards = [(sample, None)], 0
    while todo:
        points, link = todo.pop()
        cut = _cut(points, rng, bits) if len(points) * share > shard_points and len(points) >= 16 else None
        if cut is None:
            shards += 1
            child = -shards
        else:
            child = len(vantage)
            v, r, inner, outer = cut
            vantage.append(v), radius.append(r), near.append(-1), far.append(-1)
            todo += [(points[inner], (near, child)), (points[outer], (far, child))]
        if link:
            link[0][link[1]] = child
    return Tree(np.array(vantage, np.uint64), np.array(radius, np.int64), np.array(near, np.int64), np.array(far, np.int64))


def _roots(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    r = parent[x]
    while (parent[r] != r).any():
        r = parent[r]
    return r


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the pairs; the smaller position becomes the root."""
    while len(a):
        ra, rb = _roots(parent, a), _roots(parent, b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def forest(points: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (point, root) that span the components of ``points`` (distinct) at ``bits`` or fewer differing bits."""
    points = np.sort(points)
    parent, rng = np.arange(len(points)), np.random.default_rng(SEED)
    todo = [np.arange(len(points))]
    while todo:
        index = todo.pop()
        cut = _cut(points[index], rng, bits) if len(index) > TILE else None
        if cut is not None:
            todo += [index[cut[2]], index[cut[3]]]
            continue
        for i in range(0, len(index), TILE):
            rows = index[i : i + TILE]
            for j in range(i, len(index), TILE):
                cols = index[j : j + TILE]
                a, b = np.nonzero(np.bitwise_count(points[rows][:, None] ^ points[cols][None, :]) <= bits)
                apart = rows[a] < cols[b]
                _join(parent, rows[a[apart]], cols[b[apart]])
    root = _roots(parent, np.arange(len(points))) if len(points) else parent
    moved = root != np.arange(len(points))
    return points[moved], points[root[moved]]


def links(points: DataFrame, bits: int = 3, shard_points: int = 131_072, sample: int = 65_536, block: int = 524_288) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp``, enough to span all components.

    ``sample`` is the expected number of points, chosen by a hash, on which the
    tree is fitted (about 0.5 MB on the driver); every point is indexed. Shards
    of more than ``block`` points are searched as pairs of blocks.
    """
    total = points.count()
    grain = 1 << 20
    share = min(grain, -(-sample * grain // max(1, total)))
    some = points.select("fp").where(F.pmod(F.xxhash64("fp"), F.lit(grain)) < share)
    chosen = np.sort(some.toArrow().column("fp").to_numpy().astype(np.int64).view(np.uint64))
    tree = fit_tree(chosen, total, shard_points, bits)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = int64s(batch, "fp")
            at, shard = tree.shards(fps.view(np.uint64), bits)
            yield pa.record_batch([pa.array(fps[at]), pa.array(shard.astype(np.int64))], names=["fp", "shard"])

    dealt = points.select("fp").mapInArrow(deal, "fp long, shard long")
    # At most one row for every 16 points of the sample.
    parts = {r.shard: -(-r["count"] // block) for r in dealt.groupBy("shard").count().where(F.col("count") > block).collect()}

    def pair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, shard = int64s(batch, "fp"), int64s(batch, "shard")
            n = np.array([parts.get(k, 1) for k in shard.tolist()], np.int64)
            own = ((fps.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % n
            for other in range(int(n.max(initial=1))):
                at = np.flatnonzero((other < n) & ((own != other) | (n == 1)))
                low, high = np.minimum(own[at], other), np.maximum(own[at], other)
                yield pa.record_batch([pa.array(x) for x in (fps[at], shard[at], low, high)], names=["fp", "shard", "low", "high"])

    def search(table: pa.Table) -> pa.Table:
        a, b = forest(table.column("fp").to_numpy().astype(np.int64).view(np.uint64), bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    groups = dealt.mapInArrow(pair, "fp long, shard long, low long, high long")
    return groups.groupBy("shard", "low", "high").applyInArrow(search, "a long, b long")


def near_duplicates(
    docs: DataFrame, words: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None
) -> DataFrame:
    """(doc_id, text_hash, fp, component_id), one row per row of ``docs``.

    component_id: smallest id among all documents reachable over links of
    ``bits`` or fewer differing bits, the document itself included. Texts
    without words (NULL, empty) have fingerprint 0 and link like any other.
    Repeated rows give repeated rows. A NULL id is never smallest; a component
    of NULL ids alone has a NULL component_id. An empty table gives none.
    Extra columns do not matter.
    """
    folder = folder or shared_dir(docs.sparkSession)
    prints = saved(fingerprints(docs, words, id_col, text_col), f"{folder}/prints")
    points = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), f"{folder}/points")
    roots = components(links(points, bits), folder).withColumnRenamed("node", "fp")
    named = points.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(named.select("fp", "root").join(least, "root"), "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_one(
    docs: DataFrame, words: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None
) -> DataFrame:
    """The documents with one of each group of ``near_duplicates`` left: the one with the smallest id. All columns stay.

    Rows that repeat the id of the one that stays, if in the same group, are
    kept too; run exact deduplication first to remove them. Rows with a NULL id
    stay only in a group of NULL ids.
    """
    found = near_duplicates(docs, words, bits, id_col, text_col, folder)
    gone = found.where("doc_id != component_id or (doc_id is null and component_id is not null)")
    return without(docs, gone, id_col, text_col)
