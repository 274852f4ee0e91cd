"""Ranked lexical search: top documents of each item, equal bags scored once.

Terms are runs of digits, letters and non-ASCII characters, A-Z lower-cased.
With N documents that hold a term, L their terms with repeats, n the terms of
one document, df the documents that hold a term and tf its occurrences in one:

    w = floor(1000 * ln((2N + 2) / (2 df + 1)))     in doubles
    m = 75 + (25 n N) div L                         64-bit integers from here on
    score = sum of w * ((10^9 tf) div (1000 tf + 12 m))   over the item's terms, repeats included

An item sees of a document only the terms of the items and m. So documents are
restricted to the vocabulary of the items; documents whose tf vectors and m are
equal form a class. Classes are found by a hash and verified by the vectors
themselves, and each is scored once. The 20 best (class, smallest id) of an
item hold its 20 best documents, for each class passed over has 20 better
documents before its first. Only classes that are chosen are expanded, by
ascending id.

Memory and data moved: items are taken in chunks of CHUNK_BYTES of text, each
with a vocabulary of its own, so what tasks get is bounded; a chunk costs one
pass over the texts. A task holds BLOCK classes x ITEMS items of scores and
hands on K classes per item. A group of equal documents is combined before
every shuffle, and its expansion keeps K rows per task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslake.llm.common import slices, texts, words_of
from opslake.sources.scratch import saved, shared_dir

CHUNK_BYTES = 8 << 20
BLOCK = 1024
ITEMS = 512
_LAST = np.iinfo(np.int64).max

Query = tuple[int, Counter]  # (row of the item, its terms)


def chunks(items: DataFrame) -> Iterator[list[Query]]:
    """The items (row, text) with their terms, in chunks of about CHUNK_BYTES of text; items without a term are left out."""
    part, size = [], 0
    for r in items.toLocalIterator():
        terms = Counter(words_of(bytes(r.text)))
        if not terms:
            continue
        if part and size + len(r.text) > CHUNK_BYTES:
            yield part
            part, size = [], 0
        part.append((r.row, terms))
        size += len(r.text)
    if part:
        yield part


def bags(rows: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every row that holds a term; ``terms`` are ascending places in ``vocabulary``."""
    place = {t: k for k, t in enumerate(vocabulary)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts = pa.list_(pa.int32()), pa.list_(pa.int32())
        for batch in slices(batches):
            n, terms, tfs = [], [], []
            for text in batch.column(1).to_pylist():
                held = Counter(words_of(text))
                own = sorted((place[t], held[t]) for t in held.keys() & place.keys())
                n.append(sum(held.values()))
                terms.append([t for t, _ in own])
                tfs.append([c for _, c in own])
            out = pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(terms, ids), pa.array(tfs, counts)], names=["doc_id", "n", "terms", "tfs"]
            )
            yield out.filter(pa.array([x > 0 for x in n], pa.bool_()))

    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def document_counts(bag: DataFrame, size: int) -> np.ndarray:
    """df of every term of a vocabulary of ``size``, over all documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        seen = np.flatnonzero(df)
        yield pa.record_batch([pa.array(seen), pa.array(df[seen])], names=["term", "df"])

    df = np.zeros(size, np.int64)
    found = bag.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df[found.column("term").to_numpy()] = found.column("df").to_numpy()
    return df


def classes(bag: DataFrame, documents: int, tokens: int) -> DataFrame:
    """``bag`` with m and the hash of (terms, tfs, m), without documents that hold no term of the vocabulary."""
    m = F.lit(75).cast("long") + F.expr(f"(25 * n * {documents}L) div {max(1, tokens)}L")
    held = bag.where(F.size("terms") > 0).select("doc_id", "terms", "tfs", m.alias("m"))
    return held.withColumn("hash", F.xxhash64("terms", "tfs", "m"))


class Scorer:
    """Scores of blocks of classes for the items of a chunk."""

    def __init__(self, queries: list[Query], vocabulary: list[bytes], weights: np.ndarray):
        place = {t: k for k, t in enumerate(vocabulary)}
        self.rows = np.array([row for row, _ in queries], np.int64)
        entries = sorted((place[t], k, c) for k, (_, terms) in enumerate(queries) for t, c in terms.items())
        term, self.item, repeats = (np.array(x, np.int64) for x in zip(*entries, strict=True))
        self.factor = weights[term] * repeats
        self.starts = np.searchsorted(term, np.arange(len(vocabulary) + 1))

    def scores(self, terms: np.ndarray, tfs: np.ndarray, m: np.ndarray, lengths: np.ndarray, first: int) -> np.ndarray:
        """Scores (item, class) of the items from ``first``, ITEMS at most; ``terms`` and ``tfs`` of all classes in a row."""
        size = min(ITEMS, len(self.rows) - first)
        out = np.zeros((size, len(m)), np.int64)
        owner = np.repeat(np.arange(len(m)), lengths)
        gain = (1_000_000_000 * tfs) // (1000 * tfs + 12 * m[owner])
        order = np.argsort(terms, kind="stable")
        present, at = np.unique(terms[order], return_index=True)
        for t, a, b in zip(present.tolist(), at.tolist(), [*at[1:].tolist(), len(order)], strict=True):
            low, high = self.starts[t], self.starts[t + 1]
            low, high = low + np.searchsorted(self.item[low:high], [first, first + size])
            if low < high:
                held = order[a:b]
                out[np.ix_(self.item[low:high] - first, owner[held])] += self.factor[low:high, None] * gain[held]
        return out


def best(found: DataFrame, scorer: Scorer, k: int) -> DataFrame:
    """(row, hash, m, terms, tfs, least, score): of each task's classes the k best of each item, score above 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of every item the k best so far: score, smallest id (NULL last), place among the kept classes.
        top = np.zeros((len(scorer.rows), k), np.int64)
        least, last = np.full((2, *top.shape), _LAST)
        where = np.full(top.shape, -1)
        kept: pa.Table | None = None
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                col = {name: part.column(i) for i, name in enumerate(part.schema.names)}
                held = 0 if kept is None else kept.num_rows
                kept = pa.Table.from_batches([part]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([part])])
                lengths = col["terms"].value_lengths().to_numpy().astype(np.int64)
                flat = [col[x].flatten().to_numpy().astype(np.int64) for x in ("terms", "tfs")]
                m = col["m"].to_numpy().astype(np.int64)
                null = col["least"].is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = col["least"].fill_null(_LAST).to_numpy().astype(np.int64)
                for first in range(0, len(scorer.rows), ITEMS):
                    got = scorer.scores(*flat, m, lengths, first)
                    for i, bar in zip(*[x.tolist() for x in _beaten(got, top[first : first + ITEMS, -1])], strict=True):
                        at, new = first + i, np.flatnonzero(got[i] >= max(1, bar))
                        s = np.concatenate([top[at], got[i, new]])
                        x = np.concatenate([least[at], ids[new]])
                        z = np.concatenate([last[at], null[new]])
                        w = np.concatenate([where[at], held + new])
                        order = np.lexsort((x, z, -s))[:k]
                        top[at], least[at], last[at], where[at] = s[order], x[order], z[order], w[order]
                used = np.unique(where[where >= 0])
                kept = kept.take(pa.array(used)).combine_chunks()
                where[where >= 0] = np.searchsorted(used, where[where >= 0])
        if kept is None:
            return
        item, rank = np.nonzero(where >= 0)
        for a in range(0, len(item), 4096):
            i, r = item[a : a + 4096], rank[a : a + 4096]
            rows = kept.take(pa.array(where[i, r])).combine_chunks()
            columns = [rows.column(c).combine_chunks() for c in ("hash", "m", "terms", "tfs", "least")]
            yield pa.record_batch([pa.array(scorer.rows[i]), *columns, pa.array(top[i, r])], names=["row", "hash", "m", "terms", "tfs", "least", "score"])

    return found.mapInArrow(run, "row long, hash long, m long, terms array<int>, tfs array<int>, least long, score long")


def _beaten(got: np.ndarray, bars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(item, bar) of the items for which a class reaches the lowest score that they keep."""
    items = np.flatnonzero(got.max(axis=1, initial=0) >= np.maximum(1, bars))
    return items, bars[items]


def _ranked(df: DataFrame, by: Iterable[str], order: Iterable[Column], k: int) -> DataFrame:
    """The k first rows of each group, numbered in ``rank``; the limit holds in every task before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", folder: str | None = None
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 of every row of ``items``.

    Equal scores stand by ascending doc_id, NULL ids last; rank counts from 1.
    A NULL text has no terms; an item without terms, or whose terms no document
    holds, gives no row, nor do empty tables. Every row of either table counts:
    repeated documents are ranked each, repeated items are answered each. Extra
    columns do not matter.
    """
    spark = docs.sparkSession
    folder = folder or shared_dir(spark)
    numbered = texts(items, item_id, item_text).withColumnRenamed("doc_id", "item_id").withColumn("row", F.monotonically_increasing_id())
    listed = saved(numbered, f"{folder}/items")
    total, answers = None, []
    for step, queries in enumerate(chunks(listed.select("row", "text"))):
        vocabulary = sorted(set().union(*(terms for _, terms in queries)))
        bag = saved(bags(texts(docs, id_col, text_col), vocabulary), f"{folder}/bags-{step}")
        if total is None:
            total = bag.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
        df = document_counts(bag, len(vocabulary)).tolist()
        weights = np.array([math.floor(1000 * math.log((2 * total.n + 2) / (2 * x + 1))) for x in df], np.int64)
        rows = classes(bag, total.n, total.tokens)
        # Grouping by the vectors themselves verifies what the hash brought together.
        distinct = rows.groupBy("hash", "m", "terms", "tfs").agg(F.min("doc_id").alias("least"))
        by_score = [F.desc("score"), F.asc_nulls_last("least")]
        found = best(distinct, Scorer(queries, vocabulary, weights), k)
        chosen = saved(_ranked(found, ["row"], by_score, k).drop("rank", "least"), f"{folder}/chosen-{step}")
        named = chosen.select("hash", "m", "terms", "tfs").distinct()
        members = rows.join(named, ["hash", "m", "terms", "tfs"], "left_semi").select("hash", "m", "terms", "tfs", "doc_id")
        first = _ranked(members, ["hash", "m", "terms", "tfs"], [F.asc_nulls_last("doc_id")], k).drop("rank")
        expanded = chosen.join(first, ["hash", "m", "terms", "tfs"]).select("row", "doc_id", "score")
        answers.append(_ranked(expanded, ["row"], [F.desc("score"), F.asc_nulls_last("doc_id")], k))
    if not answers:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = answers[0]
    for more in answers[1:]:
        out = out.union(more)
    return out.join(listed.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")
