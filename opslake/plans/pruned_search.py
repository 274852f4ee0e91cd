"""Exact nearest vectors with pivots: cells of vectors that cannot hold a match are not met.

On unit vectors the angle is a metric. A few pivots are chosen far apart from a
bounded sample; a vector belongs to the cell of its nearest pivot and its ring
around it, and a table keeps, for each cell and every pivot, the least and
largest angle of the cell's vectors. For a question the gaps between its own
angles and those intervals bound its score with any vector of the cell, and the
k-th best score with the sample bounds the k-th best of all from below. A cell
whose bound is less is skipped, so the result is exact.

Vectors are written once by cell and shuffled once, only those of cells that
some question meets. A cell is cut into parts of bounded size, and many
questions of a cell into blocks; a task holds one part and one block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from opslake.operators.ranking import top_k_per_group
from opslake.plans.retrieval import CHUNK_VECTORS, MATCH_LIMIT, _by_length, _nearest
from opslake.sources.scratch import saved, shared_dir

# Sampled vectors (expected), pivots and rings per number of entries, questions of a block.
SAMPLE, PIVOTS, RINGS, QUESTION_BLOCK = 4096, 64, 8, 65_536
SLACK = 1e-9  # for rounding in bounds
_DIM, _PIVOT = 1 << 24, 1 << 8


def far_apart(unit: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` rows, each the one farthest from those before it."""
    chosen, best = [0], unit @ unit[0]
    while len(chosen) < min(n, len(unit)):
        k = int(np.argmin(best))
        if best[k] > 1 - 1e-12:
            break
        chosen.append(k)
        best = np.maximum(best, unit @ unit[k])
    return unit[chosen]


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


@dataclass
class Pivots:
    """Of one number of entries: the sample, the pivots, and the inner borders of the rings of each pivot."""

    sample: np.ndarray
    points: np.ndarray
    borders: np.ndarray

    @classmethod
    def fit(cls, unit: np.ndarray, pivots: int, rings: int) -> Pivots:
        points = far_apart(unit, pivots)
        theta = angles(unit, points)
        own, borders = theta.argmin(axis=1), np.full((len(points), rings - 1), np.pi)
        for p in range(len(points)):
            held = theta[own == p, p]
            if len(held):
                borders[p] = np.quantile(held, np.arange(1, rings) / rings)
        return cls(unit, points, borders)

    def cells(self, theta: np.ndarray) -> np.ndarray:
        """Cell within the table of vectors with these angles to the pivots."""
        own = theta.argmin(axis=1)
        ring = (theta[np.arange(len(own)), own][:, None] > self.borders[own]).sum(axis=1)
        return own * _PIVOT + ring


@dataclass
class Index:
    """``cells``: (vec_id, vector, cell), written once. ``sizes``: vectors of a cell; ``low``, ``high``: angles of a cell to the pivots."""

    cells: DataFrame
    pivots: dict[int, Pivots]
    sizes: dict[int, int]
    low: dict[int, np.ndarray]
    high: dict[int, np.ndarray]


def _usable(rows: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    """(``name``, vector array<double>) without NULL vectors and entries."""
    v = F.col(vector).cast("array<double>")
    ok = F.col(vector).isNotNull() & ~F.exists(v, lambda x: x.isNull())
    return rows.where(ok).select(F.col(key).alias(name), v.alias("vector"))


def build_index(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", sample: int = SAMPLE, pivots: int = PIVOTS, rings: int = RINGS,
    folder: str | None = None,
) -> Index:
    """Choose pivots from about ``sample`` vectors and place every vector in its cell."""
    folder = folder or shared_dir(vectors.sparkSession)
    rows = _usable(vectors, vec_id, embedding, "vec_id").select(F.col("vec_id").cast("bigint").alias("vec_id"), "vector")
    total, grain = rows.count(), 1 << 30
    share = min(grain, -(-sample * grain // max(1, total)))
    some = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(grain)) < share).toArrow()
    found = {d: Pivots.fit(unit, pivots, rings) for d, (_, _, unit) in sorted(_by_length(some, 0, 1).items())} if some.num_rows else {}

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for d, (at, _, unit) in _by_length(table, 0, 1).items():
                cell = found[d].cells(angles(unit, found[d].points)) if d in found else np.zeros(len(at), np.int64)
                part = batch.take(pa.array(at))
                yield pa.record_batch([*part.columns, pa.array(d * _DIM + cell)], names=["vec_id", "vector", "cell"])

    cells = saved(rows.mapInArrow(place, "vec_id bigint, vector array<double>, cell bigint"), f"{folder}/cells")

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, own = pa.Table.from_batches([batch]), batch.column(2).to_numpy()
            for d, (at, _, unit) in _by_length(table, 0, 1).items():
                theta = angles(unit, found[d].points) if d in found else np.zeros((len(at), 1))
                for c in np.unique(own[at]).tolist():
                    held = theta[own[at] == c]
                    n = held.shape[1]
                    yield pa.record_batch(
                        [pa.array(np.full(n, c)), pa.array(np.arange(n)), pa.array(np.full(n, len(held))), pa.array(held.min(axis=0)), pa.array(held.max(axis=0))],
                        names=["cell", "pivot", "n", "low", "high"],
                    )

    kinds = "cell bigint, pivot bigint, n bigint, low double, high double"
    stats = cells.mapInArrow(measure, kinds).groupBy("cell", "pivot").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    table = stats.toArrow().sort_by([("cell", "ascending"), ("pivot", "ascending")]).combine_chunks()
    cell, n, low, high = (table.column(c).to_numpy() for c in ("cell", "n", "low", "high"))
    starts = np.flatnonzero(np.diff(cell, prepend=-1))
    spans = list(zip(starts, [*starts[1:], len(cell)]))
    of = lambda x: {int(cell[a]): x[a:b] for a, b in spans}
    return Index(cells, found, {int(cell[a]): int(n[a]) for a, _ in spans}, of(low), of(high))


def choose_cells(index: Index, queries: DataFrame, k: int, query_id: str, query_embedding: str) -> DataFrame:
    """(query, vector, floor, cell): the cells that each question has to meet, and the score that a match must reach."""
    cells = np.array(sorted(index.sizes), np.int64)
    by_dim = {d: cells[cells // _DIM == d] for d in np.unique(cells // _DIM).tolist()}
    low = {d: np.stack([index.low[c] for c in own.tolist()]) for d, own in by_dim.items()}
    high = {d: np.stack([index.high[c] for c in own.tolist()]) for d, own in by_dim.items()}
    kind, pivots = dict(queries.dtypes)[query_id], index.pivots
    schema = f"query {kind}, vector array<double>, floor double, cell bigint"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                for d, (at, _, unit) in _by_length(pa.Table.from_batches([part]), 0, 1).items():
                    if d not in by_dim:
                        continue
                    floor, bound = np.full(len(at), -2.0), np.full((len(at), len(by_dim[d])), 2.0)
                    if d in pivots:
                        p = pivots[d]
                        if len(p.sample) >= k:
                            floor = np.partition(unit @ p.sample.T, -k, axis=1)[:, -k] - SLACK
                        theta, gap = angles(unit, p.points), np.zeros(bound.shape)
                        for j in range(theta.shape[1]):
                            t = theta[:, j][:, None]
                            np.maximum(gap, np.maximum(low[d][:, j] - t, t - high[d][:, j]), out=gap)
                        bound = np.cos(gap) + SLACK
                    q, c = np.nonzero(bound >= floor[:, None])
                    rows = part.take(pa.array(at[q]))
                    columns = [*rows.columns, pa.array(floor[q]), pa.array(by_dim[d][c])]
                    yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(columns, arrow)], schema=arrow)

    return _usable(queries, query_id, query_embedding, "query").mapInArrow(choose, schema)


def meetings(index: Index, chosen: DataFrame, questions: int) -> tuple[int, int]:
    """(pairs of a question and a vector that are compared, pairs that are skipped)."""
    met = sum(index.sizes[r.cell] * r.n for r in chosen.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect())
    return met, questions * sum(index.sizes.values()) - met


def pruned_topk(
    vectors: DataFrame, queries: DataFrame, k: int = MATCH_LIMIT, vec_id: str = "vec_id", embedding: str = "embedding",
    query_id: str = "query_id", query_embedding: str = "embedding", folder: str | None = None, index: Index | None = None,
    chunk: int = CHUNK_VECTORS, block: int = QUESTION_BLOCK,
) -> DataFrame:
    """(query_id, vec_id, score, rank), with the rows of ``retrieval.cosine_topk``.

    Pass an ``index`` of the vectors to ask them again. Rules for NULL, empty,
    zero and ragged vectors and for equal scores are those of ``cosine_topk``.
    """
    folder = folder or shared_dir(vectors.sparkSession)
    index = index or build_index(vectors, vec_id, embedding, folder=folder)
    chosen = saved(choose_cells(index, queries, k, query_id, query_embedding), f"{folder}/chosen")
    asked = {r.cell: r.n for r in chosen.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per cell at most
    shares = [(c, -(-index.sizes[c] // chunk), -(-n // block)) for c, n in sorted(asked.items())]
    sizes = vectors.sparkSession.createDataFrame(shares, "cell bigint, parts bigint, blocks bigint")
    every = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n))
    left = chosen.join(sizes, "cell").select("cell", own("query", "blocks").alias("block"), F.explode(every("parts")).alias("part"), "query", "vector", "floor")
    right = index.cells.join(sizes, "cell").select("cell", F.explode(every("blocks")).alias("block"), own("vec_id", "parts").alias("part"), "vec_id", "vector")
    kind = dict(queries.dtypes)[query_id]
    schema = f"_query {kind}, _vector bigint, score double"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        q, v = _by_length(asked, 3, 4), _by_length(held, 3, 4)
        found = [_nearest(*q[d], *v[d], k) for d in q if d in v]
        row, vector, score = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
        keep = score >= asked.column(5).to_numpy()[row] if found else np.zeros(0, bool)
        ids = asked.column(3).combine_chunks().take(pa.array(row[keep].astype(np.int64)))
        return pa.Table.from_arrays([ids.cast(arrow.field(0).type), pa.array(vector[keep], pa.int64()), pa.array(score[keep], pa.float64())], schema=arrow)

    on = ("cell", "block", "part")
    met = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(meet, schema)
    named = met.select(F.col("_query").alias(query_id), F.col("_vector").alias(vec_id), "score")
    return top_k_per_group(named, [query_id], [F.col("score").desc(), F.col(vec_id)], k)
