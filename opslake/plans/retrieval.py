"""Text chunks, exact nearest vectors, coverage and terms."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from opslake.functions.text import base_name, json_value, pipe_list
from opslake.operators.asof import as_of
from opslake.operators.ranking import top_k_per_group

# Chunk length, overlap and number of matches of the document index.
CHUNK_SIZE, CHUNK_OVERLAP, MATCH_LIMIT = 1000, 140, 6

# Questions and vectors that meet in one task, and scores that it holds at once.
QUERY_BLOCK = 4096
CHUNK_VECTORS = 65_536
STRIP = 1 << 22


def chunk_text(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """(doc_id, chunk_no, start_pos, end_pos, chunk) with positions from 1, end inclusive.

    Chunks start every ``size - overlap`` characters. A tail that lies wholly in
    the overlap gives no chunk; NULL and empty text give none. The text is cut
    once into blocks of one step and a chunk is put together from its blocks, so
    a very long text costs time in proportion to its length.
    """
    step = size - overlap
    if step <= 0 or overlap < 0:
        raise ValueError("overlap must be at least 0 and less than size")
    per_chunk = math.ceil(size / step)
    n = F.length(F.col(text))
    blocks = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    # The blocks are a column of their own below the generator, and each row that
    # it makes carries the few blocks of its chunk: the text is cut once.
    cut = docs.where(n > 0).select(F.col(doc_id), blocks.alias("_blocks"), n.alias("_n"))
    shifted = [
        F.slice("_blocks", F.lit(k + 1), F.greatest(F.size("_blocks") - k, F.lit(0))).alias(f"_b{k}") for k in range(per_chunk)
    ]
    rows = cut.select(doc_id, "_n", F.posexplode(F.arrays_zip(*shifted)).alias("_i", "_z"))
    start = F.col("_i") * step + 1
    whole = F.concat(*[F.coalesce(F.col(f"_z._b{k}"), F.lit("")) for k in range(per_chunk)])
    return rows.where((F.col("_i") == 0) | (start <= F.col("_n") - overlap)).select(
        doc_id,
        (F.col("_i") + 1).cast("bigint").alias("chunk_no"),
        start.cast("bigint").alias("start_pos"),
        F.least(start + (size - 1), F.col("_n")).cast("bigint").alias("end_pos"),
        F.substring(whole, 1, size).alias("chunk"),
    )


def cosine_topk(
    vectors: DataFrame, queries: DataFrame, k: int = MATCH_LIMIT, vec_id: str = "vec_id", embedding: str = "embedding",
    query_id: str = "query_id", query_embedding: str = "embedding", block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, vec_id, score, rank): the ``k`` most similar vectors of each question, exactly.

    Questions are dealt to blocks of about ``block`` and vectors to chunks of
    about CHUNK_VECTORS; every block meets every chunk in one task, which holds
    one of each and multiplies them. No question passes through the driver, and
    a task hands on at most ``k`` rows a question.

    A vector or question that is NULL, holds a NULL, has length 0 or another
    number of entries than its partner matches nothing. Equal scores go by id.
    """
    n_blocks = max(1, math.ceil(queries.count() / block))
    n_chunks = max(1, math.ceil(vectors.count() / CHUNK_VECTORS))
    kind = dict(queries.dtypes)[query_id]
    schema = f"_query {kind}, _vector bigint, score double"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    everywhere = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    asked = queries.where(F.col(query_embedding).isNotNull()).select(
        F.pmod(F.xxhash64(query_id), F.lit(n_blocks)).cast("int").alias("_block"), everywhere(n_chunks, "_chunk"),
        F.col(query_id).alias("_query"), F.col(query_embedding).cast("array<double>").alias("_q"),
    )
    held = vectors.where(F.col(embedding).isNotNull()).select(
        everywhere(n_blocks, "_block"), F.pmod(F.xxhash64(vec_id), F.lit(n_chunks)).cast("int").alias("_chunk"),
        F.col(vec_id).cast("bigint").alias("_vector"), F.col(embedding).cast("array<double>").alias("_v"),
    )

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        found = [_nearest(*q, *v, k) for d, q in _by_length(asked, 2, 3).items() if (v := _by_length(held, 2, 3).get(d))]
        columns = [np.concatenate([f[i] for f in found]) if found else [] for i in range(3)]
        ids = asked.column(2).to_pylist() if found else []
        columns[0] = [ids[i] for i in columns[0]]
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    met = asked.groupBy("_block", "_chunk").cogroup(held.groupBy("_block", "_chunk")).applyInArrow(meet, schema)
    named = met.select(F.col("_query").alias(query_id), F.col("_vector").alias(vec_id), "score")
    return top_k_per_group(named, [query_id], [F.col("score").desc(), F.col(vec_id)], k)


def _by_length(rows: pa.Table, key: int, vector: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Number of entries -> (row numbers, keys, unit vectors) of the usable rows."""
    lists = rows.column(vector).combine_chunks()
    sizes = np.diff(np.asarray(lists.offsets))
    at = np.asarray(lists.offsets)[:-1] - np.asarray(lists.offsets)[0]
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = {}
    for d in np.unique(sizes[sizes > 0]).tolist():
        index = np.flatnonzero(sizes == d)
        data = flat[at[index][:, None] + np.arange(d)]
        norm = np.linalg.norm(data, axis=1)
        ok = (norm > 0) & np.isfinite(norm)
        keys = rows.column(key).take(pa.array(index[ok])).to_numpy()
        out[d] = (index[ok], keys, data[ok] / norm[ok][:, None])
    return out


def _nearest(rows: np.ndarray, _, unit: np.ndarray, __, keys: np.ndarray, data: np.ndarray, k: int) -> tuple:
    """(question row, vector key, score) of the k best of each question, in strips of bounded size."""
    best_q, best_v, best_s = [], [], []
    order = np.argsort(keys, kind="stable")
    keys, data = keys[order], data[order]
    strip = max(1, STRIP // max(1, len(keys)))
    for a in range(0, len(rows), strip):
        sims = unit[a : a + strip] @ data.T
        top = np.argsort(-sims, axis=1, kind="stable")[:, :k] if len(keys) <= 4 * k else _top(sims, k)
        best_q.append(np.repeat(rows[a : a + strip], top.shape[1]))
        best_v.append(keys[top].ravel())
        best_s.append(np.take_along_axis(sims, top, axis=1).ravel())
    return tuple(np.concatenate(x) if x else np.zeros(0) for x in (best_q, best_v, best_s))


def _top(sims: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row; of equal values the first columns."""
    floor = np.partition(sims, -k, axis=1)[:, -k][:, None]
    above, at = sims > floor, sims == floor
    room = k - above.sum(axis=1, keepdims=True)
    keep = above | (at & (np.cumsum(at, axis=1) <= room))
    return np.nonzero(keep)[1].reshape(len(sims), k)


def chunks_per_object(chunks: DataFrame, attributes: str = "attributes", path: str = "$.object_name") -> DataFrame:
    """(source_object, chunk_count) by a value inside a JSON column."""
    return chunks.groupBy(json_value(F.col(attributes), path).alias("source_object")).agg(
        F.count(F.lit(1)).alias("chunk_count")
    )


def coverage(expected: DataFrame, catalog: DataFrame, chunks: DataFrame, attributes: str = "attributes") -> DataFrame:
    """Chunks per expected document, 0 when it was not indexed.

    ``expected`` has (document_id, file_name). Chunks carry the path of their
    file in JSON; its last part is the file name.
    """
    counted = (
        chunks.groupBy(base_name(json_value(F.col(attributes), "$.object_name")).alias("file_name"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    known = catalog.select("document_id", F.col("version").alias("catalog_version"), F.col("file_name").alias("catalog_file_name"))
    return (
        expected.select("document_id", "file_name")
        .join(known, "document_id", "left")
        .join(counted, "file_name", "left")
        .select(
            "document_id", "catalog_version", "file_name", "catalog_file_name",
            F.coalesce(F.col("_n"), F.lit(0)).alias("chunk_count"),
        )
    )


def narrow(chunks: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Keep the chunks of candidate documents."""
    return chunks.join(candidates.select(key).distinct(), key, "left_semi").select(*chunks.columns)


def canonical_term(rows: DataFrame, column: str, terms: DataFrame, out: str = "canonical_term") -> DataFrame:
    """Replace a synonym by its term; other text stays. ``terms`` has (term, synonyms a|b|c).

    A word that is listed for several terms takes the first by name.
    """
    listed = terms.select("term", F.explode(F.array_union(pipe_list(F.col("synonyms")), F.array("term"))).alias("_word"))
    words = listed.groupBy("_word").agg(F.min("term").alias("_term"))
    return (
        rows.join(words, F.col(column) == F.col("_word"), "left")
        .withColumn(out, F.coalesce(F.col("_term"), F.col(column)))
        .drop("_word", "_term")
    )


def version_at(docs: DataFrame, family: str, effective: str, on: str, tie: str = "document_id") -> DataFrame:
    """The version of each document family in force on a date; none if all start later."""
    by = [F.col(effective).desc(), F.col("version").desc(), F.col(tie)]
    return top_k_per_group(docs.where(F.col(effective) <= on), [family], by, 1).drop("rank")


def versions_at(
    docs: DataFrame, asked: DataFrame, family: str, effective: str, on: str, tie: str = "document_id", how: str = "inner", folder: str | None = None
) -> DataFrame:
    """``version_at`` for a table of questions (``family``, ``on``, ...), each with its own date."""
    return as_of(asked, docs, [family], on, effective, [("version", True), (tie, False)], how, folder)


__all__: Sequence[str] = (
    "chunk_text", "cosine_topk", "chunks_per_object", "coverage", "narrow", "canonical_term", "version_at", "versions_at",
)
