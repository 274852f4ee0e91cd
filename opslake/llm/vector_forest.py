"""Near-duplicate vectors by a forest of random-projection trees with spill overlap.

Equal vectors are one point. A tree cuts points at the median of their
projections on a random direction; points near the cut stand on both sides
(spill), so close points seldom part. Leaves of many trees are searched whole,
and cosines are verified in double precision. A link counts where the pair
first meets, in the smallest leaf that holds both, so links are counted once
and pairs are never listed: a leaf hands on the number of links of its points
and a spanning forest.

Fitting. All points start in one leaf per tree. In a round, leaves of more than
``leaf_points`` points are cut as deep as a bounded sample of their points
allows, and every point is routed on; rounds end when no leaf can be cut. A
point carries the list of its leaves, so a round is one pass without a shuffle.

A leaf that no direction cuts, since its points all lie within the spill of each
other, is cut into hashed blocks, and every pair of blocks is a group of its
own: its links are counted exactly, in time that grows with the square of its
distinct vectors, in bounded memory per task.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import int64s
from opslake.llm.components import components
from opslake.llm.simhash import _join, _roots
from opslake.sources.scratch import saved, shared_dir

SEED = 42
TILE = 512
_PAIRS = 1 << 15


@dataclass(frozen=True)
class Shape:
    """Of a forest. ``sample_bytes`` bounds the vectors on the driver, in expectation; ``block`` the points of a dealt block."""

    similarity: float = 0.9
    trees: int = 5
    leaf_points: int = 1024
    spill: float = 0.4
    sample_bytes: int = 16 << 20
    block: int = 2048

    def margin(self, dim: int) -> float:
        """Half the overlap: ``spill`` times the deviation of the projected distance of two vectors at the bar."""
        return self.spill * math.sqrt(2 * (1 - self.similarity) / dim)


@dataclass
class Tree:
    """Inner nodes in order; a child below 0 is leaf -child - 1 of the tree."""

    direction: np.ndarray
    cut: np.ndarray
    children: np.ndarray
    margin: float

    def leaves(self, unit: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, places in ``unit``) of every leaf that a point reaches."""
        todo = [(0, np.arange(len(unit)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                yield -node - 1, at
                continue
            x = unit[at] @ self.direction[node] - self.cut[node]
            low, high = self.children[node].tolist()
            todo += [(low, at[x <= self.margin]), (high, at[x > -self.margin])]


def fit_tree(unit: np.ndarray, total: int, shape: Shape, seed: list[int]) -> tuple[Tree | None, int]:
    """(tree over a sample ``unit`` of ``total`` points, its number of leaves); no tree where no direction cuts."""
    rng, share, margin = np.random.default_rng(seed), total / max(1, len(unit)), shape.margin(unit.shape[1])
    direction, cuts, children, leaves = [], [], [], 0
    todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(unit)), -1, 0)]
    while todo:
        at, parent, side = todo.pop()
        best = None
        if len(at) * share > shape.leaf_points and len(at) >= 16:
            for _ in range(3):
                d = rng.standard_normal(unit.shape[1])
                d /= np.linalg.norm(d)
                x = unit[at] @ d
                x -= (middle := np.median(x))
                low, high = x <= margin, x > -margin
                larger = max(low.sum(), high.sum())
                if best is None or larger < best[0]:
                    best = larger, d, middle, at[low], at[high]
        if best is None or best[0] > 0.85 * len(at):
            leaves += 1
            node = -leaves
        else:
            node = len(cuts)
            _, d, middle, low, high = best
            direction.append(d), cuts.append(middle), children.append([0, 0])
            todo += [(low, node, 0), (high, node, 1)]
        if parent >= 0:
            children[parent][side] = node
    if not cuts:
        return None, 1
    return Tree(np.array(direction), np.array(cuts), np.array(children, np.int64), margin), leaves


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by a power of two first, so that no square overflows or vanishes."""
    v = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each vector length."""
    dims = batch.column(batch.schema.get_field_index("vector")).value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(dims).tolist():
        yield dim, batch.filter(pa.array(dims == dim))


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


def leaf_sizes(placed: DataFrame, above: int) -> dict[int, int]:
    """Points of every leaf that holds more than ``above``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, n = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            yield pa.record_batch([pa.array(leaf), pa.array(n)], names=["leaf", "n"])

    counts = placed.select("leaves").mapInArrow(run, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n"))
    return {r.leaf: r.n for r in counts.where(F.col("n") > above).collect()}


def _route(placed: DataFrame, trees: dict[int, tuple[Tree, int]]) -> DataFrame:
    """Every point moves on from the leaves that have a tree (and the number of its first leaf)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(batch):
                unit = unit_vectors(_matrix(part.column(1), dim))
                lists = part.column(3)
                owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                leaf = lists.flatten().to_numpy()
                cut = np.isin(leaf, list(trees))
                at, to = [owner[~cut]], [leaf[~cut]]
                for old in np.unique(leaf[cut]).tolist():
                    tree, first = trees[old]
                    rows = owner[leaf == old]
                    for new, places in tree.leaves(unit[rows]):
                        at.append(rows[places])
                        to.append(np.full(len(places), first + new))
                at, to = np.concatenate(at), np.concatenate(to)
                order = np.lexsort((to, at))
                offsets = np.searchsorted(at[order], np.arange(part.num_rows + 1))
                yield pa.record_batch([*part.columns[:3], _lists(offsets, to[order])], names=["point", "vector", "size", "leaves"])

    return placed.mapInArrow(run, "point long, vector array<double>, size long, leaves array<long>")


def grow(points: DataFrame, shape: Shape, folder: str) -> DataFrame:
    """(point, vector, size, leaves) of ``points`` (point, vector, size): the leaves of each point in all trees, ascending."""
    dims = {r.dim: r.n for r in points.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).collect()}
    first = {dim: k * shape.trees for k, dim in enumerate(sorted(dims))}
    free = len(first) * shape.trees
    starts = F.create_map(*[F.lit(x) for pair in first.items() for x in pair]) if first else None
    base = F.element_at(starts, F.size("vector")).cast("long") if first else F.lit(0).cast("long")
    placed = points.select("point", "vector", "size", F.sequence(base, base + shape.trees - 1).alias("leaves"))
    fixed: set[int] = set()
    for step in range(64):
        large = {k: n for k, n in leaf_sizes(placed, shape.leaf_points).items() if k not in fixed}
        if not large:
            break
        chosen = _sample(placed, large, shape)
        trees = {}
        for leaf, unit in chosen.items():
            tree, leaves = fit_tree(unit, large[leaf], shape, [SEED, step, leaf])
            if tree is not None:
                trees[leaf] = tree, free
                free += leaves
            else:
                fixed.add(leaf)
        if not trees and not any(k not in chosen and k not in fixed for k in large):
            break
        if trees:
            placed = saved(_route(placed, trees), f"{folder}/placed-{step}")
    return placed


def _sample(placed: DataFrame, large: dict[int, int], shape: Shape) -> dict[int, np.ndarray]:
    """Unit vectors of points of the largest leaves of ``large``, chosen by a hash, 32 or so at least of a leaf."""
    widest = placed.agg(F.max(F.size("vector"))).first()[0]
    room = max(64, shape.sample_bytes // (8 * widest))
    wanted = set(sorted(large, key=lambda k: (-large[k], k))[: max(1, room // 64)])
    # Each point of a wanted leaf is taken by itself, so that small leaves are not starved by large ones.
    each = max(64, room // len(wanted))
    share = {k: min(1.0, each / large[k]) for k in wanted}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            leaf = lists.flatten().to_numpy()
            luck = ((int64s(batch, "point").view(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)).astype(np.float64) / (1 << 53)
            bar = np.array([share.get(k, 0.0) for k in leaf.tolist()])
            at = np.flatnonzero(luck[owner] < bar)
            yield pa.record_batch([pa.array(leaf[at]), batch.column(1).take(pa.array(owner[at]))], names=["leaf", "vector"])

    got = placed.select("point", "vector", "leaves").mapInArrow(run, "leaf long, vector array<double>").toArrow().sort_by("leaf").combine_chunks()
    leaf = got.column("leaf").to_numpy()
    out = {}
    for k in np.unique(leaf).tolist():
        a, b = np.searchsorted(leaf, [k, k + 1])
        rows = got.column("vector").combine_chunks().slice(a, b - a)
        out[k] = unit_vectors(_matrix(rows, len(rows[0])))
    return out


def _met_before(leaves: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the points ``a`` and ``b`` share one of the listed leaves (rows padded with -1)."""
    x, y = leaves[a], leaves[b]
    return ((x[:, :, None] == y[:, None, :]) & (x[:, :, None] >= 0)).any(axis=(1, 2))


def search_leaf(table: pa.Table, similarity: float) -> pa.Table:
    """(point, root, links) of the points of a leaf, or of a pair of its blocks, that have links first met here."""
    leaf, low, high = (table.column(c)[0].as_py() for c in ("leaf", "low", "high"))
    own = table.column("own").to_numpy()
    order = np.argsort(own, kind="stable")
    split = int((own == low).sum())
    point, size = (table.column(c).to_numpy()[order] for c in ("point", "size"))
    vectors = table.column("vector").combine_chunks().take(pa.array(order))
    unit = unit_vectors(_matrix(vectors, len(vectors[0])))
    lists = table.column("leaves").combine_chunks().take(pa.array(order))
    lengths = lists.value_lengths().to_numpy()
    earlier = np.full((len(point), int(lengths.max())), -1, np.int64)
    owner = np.repeat(np.arange(len(point)), lengths)
    flat = lists.flatten().to_numpy()
    earlier[owner, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.where(flat < leaf, flat, -1)
    earlier = earlier[:, : max(1, int((earlier >= 0).sum(axis=1).max()))]

    parent, links = np.arange(len(point)), np.zeros(len(point), np.int64)
    rows, cols = (np.arange(len(point)),) * 2 if low == high else (np.arange(split), np.arange(split, len(point)))
    for i in range(0, len(rows), TILE):
        r = rows[i : i + TILE]
        for j in range(i if low == high else 0, len(cols), TILE):
            c = cols[j : j + TILE]
            a, b = np.nonzero(unit[r] @ unit[c].T >= similarity)
            a, b = r[a], c[b]
            a, b = a[a < b], b[a < b]
            for k in range(0, len(a), _PAIRS):
                x, y = a[k : k + _PAIRS], b[k : k + _PAIRS]
                new = ~_met_before(earlier, x, y)
                x, y = x[new], y[new]
                np.add.at(links, x, size[y])
                np.add.at(links, y, size[x])
                _join(parent, x, y)
    at = np.flatnonzero(links)
    return pa.table({"point": point[at], "root": point[_roots(parent, at)], "links": links[at]})


def linked(placed: DataFrame, shape: Shape) -> DataFrame:
    """(point, root, links): per group of a search, points with their number of links and a link that spans."""
    parts = {k: -(-n // shape.block) for k, n in leaf_sizes(placed, 2 * shape.block).items()}

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            leaf = lists.flatten().to_numpy()
            n = np.array([parts.get(k, 1) for k in leaf.tolist()], np.int64)
            hashed = (int64s(batch, "point").view(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            own = hashed.astype(np.int64)[owner] % n
            for other in range(int(n.max(initial=1))):
                at = np.flatnonzero(other < n)
                for a in range(0, len(at), 8192):
                    k = at[a : a + 8192]
                    keys = [leaf[k], np.minimum(own[k], other), np.maximum(own[k], other), own[k]]
                    yield pa.record_batch(
                        [*map(pa.array, keys), *(c.take(pa.array(owner[k])) for c in batch.columns)],
                        names=["leaf", "low", "high", "own", "point", "vector", "size", "leaves"],
                    )

    kinds = "leaf long, low long, high long, own long, point long, vector array<double>, size long, leaves array<long>"
    groups = placed.mapInArrow(deal, kinds).groupBy("leaf", "low", "high")
    return groups.applyInArrow(lambda t: search_leaf(t, shape.similarity), "point long, root long, links long")


def near_duplicates(vectors: DataFrame, shape: Shape = Shape(), id_col: str = "vec_id", vector_col: str = "embedding", folder: str | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    n_links counts the other rows found with a cosine of ``shape.similarity`` or
    more, component_id is the smallest id reachable over links, the row itself
    included; kept says that it is the row's own. Vectors that are NULL, empty,
    zero or hold NULL or non-finite components have no links, and vectors of
    different lengths never link. Equal vectors always link; repeated rows are
    vectors of their own, which share an id. A NULL id is never smallest: its
    row is never kept, and a component of NULL ids alone has a NULL
    component_id. An empty table gives no row; extra columns do not matter.
    """
    folder = folder or shared_dir(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.coalesce(~odd & F.exists("vector", lambda x: x != 0), F.lit(False))
    hashed = rows.where(sound).withColumn("hash", F.xxhash64("vector"))
    grouped = hashed.groupBy("hash", "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))
    points = saved(grouped.withColumn("point", F.monotonically_increasing_id()), f"{folder}/points")
    found = saved(linked(grow(points.select("point", "vector", "size"), shape, folder), shape), f"{folder}/linked")
    roots = components(found.select(F.col("point").alias("a"), F.col("root").alias("b")), folder).withColumnRenamed("node", "point")
    links = found.groupBy("point").agg(F.sum("links").alias("links"))
    named = points.join(roots, "point", "left").join(links, "point", "left").withColumn("root", F.coalesce("root", "point"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(least, "root").select("hash", "vector", "component_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    good = hashed.join(classes, ["hash", "vector"]).select("vec_id", "n_links", "component_id", kept)
    alone = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    return good.union(alone)
