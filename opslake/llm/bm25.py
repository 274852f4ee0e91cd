"""Benchmark decontamination: BM25 with block-max WAND, then overlap checks.

Test items are indexed, every passage of every document is a query. A passage
holds two strides of words, a stride being the longest item of the whole
benchmark, so each stretch of that length lies in one passage whole. A document
of several passages is one more query as a whole, for items whose parts stand
far apart. Impacts are divided by the least score that a text can have if it
passes the check below; so the retrieval threshold is 1 for all items and no
text that would pass is lost. Sums of range maxima are taken for all queries of
a batch in one numpy pass; only where such a sum reaches 1 are cursors opened,
and they move by block-max WAND. Whole documents have so many terms that their
scores are summed term by term instead.

Check, of retrieved items only: the share of the item's five-word shingles that
the document holds, for the question and for the answer (the last sentence), and
for both together. A document leaks the item when the share of both together
reaches ``overlap`` and neither of the two is wholly absent. Runs are looked up
in all of the document, so what its passages hold counts together, however far
question and answer stand apart or words are inserted.

Memory: the index goes to every task, in chunks of bounded items and bytes;
documents run through one chunk after the other.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import keep_rows, slices, text_hash, texts, words_of

SHINGLE = 5
K1, B = 1.2, 0.75
BLOCK = 8
RANGES = 128  # parts of a chunk whose bounds are taken for all passages at once
CHUNK_ITEMS, CHUNK_BYTES = 4_000, 4 << 20
LEAST_STRIDE = 32
_PAIRS = 1 << 15

HIT = "struct<item_id: long, score: double, overlap: double, question_overlap: double, answer_overlap: double>"


def split_item(text: bytes) -> tuple[list[bytes], int]:
    """(words, number of words of the question): the answer is the last sentence, if another stands before it."""
    parts = [w for w in map(words_of, re.split(rb"[.!?\n]+", text)) if w]
    words = [w for part in parts for w in part]
    return words, len(words) - len(parts[-1]) if len(parts) > 1 else len(words)


def shingles(words: list) -> list[tuple]:
    """Runs of SHINGLE words; fewer words are one run, none none."""
    if len(words) < SHINGLE:
        return [tuple(words)] if words else []
    return list(zip(*(words[k:] for k in range(SHINGLE)), strict=False))


def _code(windows: np.ndarray) -> np.ndarray:
    """A number per row of term numbers; different rows may share one."""
    code = np.zeros(len(windows), np.uint64)
    for k in range(windows.shape[1]):
        code = (code ^ windows[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return code


@dataclass
class Cursor:
    """A term's list with the place reached in it."""

    items: list[int]
    impacts: list[float]
    top: float
    block_tops: dict[int, float]
    at: int = 0

    def seek(self, item: int, end: int) -> bool:
        """To the first entry not before ``item``; False if there is none before ``end``."""
        self.at = bisect_left(self.items, item, self.at)
        return self.at < len(self.items) and self.items[self.at] < end


class ItemIndex:
    """Inverted index of items with block-max impacts.

    ``df`` and ``n_items`` are those of the whole benchmark, of which this may
    be a chunk, and so is ``longest``. Items without words are left out: nothing can leak them.
    """

    def __init__(self, items: list[tuple[int, bytes]], df: dict[bytes, int], n_items: int, mean_words: float, overlap: float, longest: int = 0):
        self.overlap = overlap
        self.ids, self.shingles, self.questions, self.exact = [], [], [], []
        self.vocabulary: dict[bytes, int] = {}
        postings: list[list[tuple[int, float]]] = []
        self.longest = longest
        for item_id, text in sorted(items, key=lambda x: x[0]):
            words, question = split_item(text)
            if not words:
                continue
            k, self.longest = len(self.ids), max(self.longest, len(words))
            impact = {}
            for word, tf in Counter(words).items():
                idf = math.log(1 + (n_items - df[word] + 0.5) / (df[word] + 0.5))
                term = self.vocabulary.setdefault(word, len(self.vocabulary))
                if term == len(postings):
                    postings.append([])
                impact[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_words))
            runs = shingles([self.vocabulary[w] for w in words])
            least = self._least(runs, impact)
            for term, value in impact.items():
                postings[term].append((k, value / least))
            self.ids.append(item_id)
            self.shingles.append(runs)
            # A run counts for the part in which it ends.
            self.questions.append(max(0, question - SHINGLE + 1) if len(words) >= SHINGLE else (1 if question == len(words) else 0))
            self.exact.append(least)
        self.postings = postings
        self.lists: dict[int, tuple] = {}  # what cursors of a term share, made when first needed
        self.starts = np.cumsum([0, *map(len, postings)])
        self.entry_item = np.array([k for entries in postings for k, _ in entries], np.int64)
        self.entry_impact = np.array([v for entries in postings for _, v in entries], np.float64)
        self.holders: dict[tuple, list[int]] = {}  # run -> items, as often as they hold it
        for k, runs in enumerate(self.shingles):
            for run in runs:
                self.holders.setdefault(run, []).append(k)
        self.codes = {n: np.unique(_code(np.array([r for r in self.holders if len(r) == n]))) for n in {len(r) for r in self.holders}}
        self.range_items = BLOCK * max(1, -(-len(self.ids) // (BLOCK * RANGES)))
        self.tops = np.zeros((len(postings), -(-len(self.ids) // self.range_items)), np.float32)
        for term, entries in enumerate(postings):
            for k, v in entries:
                part = k // self.range_items
                self.tops[term, part] = max(self.tops[term, part], v)

    def _least(self, runs: list[tuple], impact: dict[int, float]) -> float:
        """Least BM25 score of a passage that holds ``overlap`` of the runs.

        A missing word breaks all runs that hold it, and a broken run has at
        most SHINGLE words; so the missing words stand in at most SHINGLE times
        the broken runs. The dearest choice within that is a knapsack; its
        fractional optimum bounds it.
        """
        broken = len(runs) - math.ceil(self.overlap * len(runs) - 1e-9)
        room, lost = SHINGLE * broken, 0.0
        held = Counter(t for run in runs for t in set(run))
        for term in sorted(impact, key=lambda t: -impact[t] / held[t]):
            take = min(1.0, room / held[term])
            lost += take * impact[term]
            room -= take * held[term]
            if room <= 0:
                break
        return max(1e-9, (sum(impact.values()) - lost) * (1 - 1e-9))

    def cursor(self, term: int) -> Cursor:
        if term not in self.lists:
            blocks: dict[int, float] = {}
            for k, v in self.postings[term]:
                blocks[k // BLOCK] = max(v, blocks.get(k // BLOCK, 0.0))
            self.lists[term] = [k for k, _ in self.postings[term]], [v for _, v in self.postings[term]], float(self.tops[term].max()), blocks
        return Cursor(*self.lists[term])

    def search(self, terms: Iterable[int], part: int) -> Iterator[tuple[int, float]]:
        """(item number, score) of the items of a range whose score reaches 1, by block-max WAND."""
        begin, end = part * self.range_items, (part + 1) * self.range_items
        cursors = [c for c in map(self.cursor, terms) if c.seek(begin, end)]
        while cursors:
            cursors.sort(key=lambda c: c.items[c.at])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += c.top
                if bound >= 1:
                    pivot = i
                    break
            if pivot < 0:
                return
            item = cursors[pivot].items[cursors[pivot].at]
            while pivot + 1 < len(cursors) and cursors[pivot + 1].items[cursors[pivot + 1].at] == item:
                pivot += 1
            block = item // BLOCK
            if sum(c.block_tops.get(block, 0.0) for c in cursors[: pivot + 1]) < 1:
                # No item of this block before the next cursor's can reach 1.
                goal = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    goal = min(goal, cursors[pivot + 1].items[cursors[pivot + 1].at])
            elif cursors[0].items[cursors[0].at] == item:
                score = sum(c.impacts[c.at] for c in cursors[: pivot + 1])
                if score >= 1:
                    yield item, score * self.exact[item]
                goal = item + 1
            else:
                goal = item
            cursors = [c for i, c in enumerate(cursors) if i > pivot or c.seek(goal, end)]

    def gather(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """As ``search`` over all items, by sums over the lists of the terms; for queries of very many terms."""
        sizes = self.starts[terms + 1] - self.starts[terms]
        at = np.repeat(self.starts[terms + 1] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
        scores = np.bincount(self.entry_item[at], self.entry_impact[at], minlength=len(self.ids))
        return [(k, scores[k] * self.exact[k]) for k in np.flatnonzero(scores >= 1).tolist()]

    def held(self, ids: np.ndarray) -> set[tuple]:
        """Runs of the items that stand in a text, given as term numbers, -1 for other words."""
        found: set[tuple] = set()
        for n, codes in self.codes.items():
            if len(ids) < n:
                continue
            windows = np.lib.stride_tricks.sliding_window_view(ids, n)
            code = _code(windows)
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            found.update(run for run in map(tuple, windows[codes[at] == code].tolist()) if run in self.holders)
        return found

    def score(self, item: int, terms: set[int]) -> float:
        """BM25 score of an item for a text with these terms."""
        own = {t for run in self.shingles[item] for t in run} & terms
        return self.exact[item] * sum(self.postings[t][bisect_left(self.postings[t], (item,))][1] for t in own)

    def verify(self, item: int, held: set[tuple]) -> tuple[float, float, float]:
        """Shares of the item's runs in ``held``: all, those of the question, those of the answer (1 if it has none)."""
        found = [run in held for run in self.shingles[item]]
        q = self.questions[item]
        share = lambda part: sum(part) / len(part) if part else 1.0
        return share(found), share(found[:q]), share(found[q:])


def _doc_hits(
    index: ItemIndex, ids: np.ndarray, queries: list[tuple[int, int, np.ndarray]], passages: int, stride: int, width: int
) -> list[dict]:
    """Leaks of one document among the items that its queries retrieve; query number ``passages`` is the whole document.

    The score is that of the passage with the largest share, or the document's if no passage alone would do.
    """
    retrieved: dict[int, list[tuple[int, float]]] = {}
    whole = None
    for query, part, terms in queries:
        if query < passages:
            for item, score in index.search(terms.tolist(), part):
                retrieved.setdefault(item, []).append((query, score))
        elif whole is None:
            whole = index.gather(terms)
    for item, _ in whole or ():
        retrieved.setdefault(item, [])
    if not retrieved:
        return []
    held = index.held(ids)
    if not held:
        return []
    out, known, windows = [], None, {}
    for item in sorted(retrieved):
        both, question, answer = index.verify(item, held)
        if both < index.overlap - 1e-9 or not question or not answer:
            continue
        best, size = (0.0, 0.0), len(index.shingles[item][0])
        for passage, score in retrieved[item]:
            if (passage, size) not in windows:
                words = ids[passage * stride : passage * stride + width].tolist()
                windows[passage, size] = set(zip(*(words[k:] for k in range(size)), strict=False))
            share = index.verify(item, windows[passage, size])[0]
            if share >= index.overlap - 1e-9:
                best = max(best, (share, score))
        if not best[0]:
            known = known if known is not None else set(ids.tolist())
            best = both, index.score(item, known)
        out.append({"item_id": index.ids[item], "score": best[1], "overlap": both, "question_overlap": question, "answer_overlap": answer})
    return out


def _alive(index: ItemIndex, passage: np.ndarray, term: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(passage, range, terms) where the terms' largest impacts in the range together reach 1.

    ``passage`` is sorted. Elsewhere no WAND pivot exists.
    """
    starts = np.flatnonzero(np.diff(passage, prepend=-1))
    ends = np.append(starts[1:], len(passage))
    k = 0
    while k < len(starts):
        stop = max(k + 1, int(np.searchsorted(ends, starts[k] + _PAIRS, side="right")))
        a, b = starts[k], ends[stop - 1]
        bounds = np.add.reduceat(index.tops[term[a:b]], starts[k:stop] - a, axis=0)
        for row, part in zip(*(x.tolist() for x in np.nonzero(bounds >= 1 - 1e-4)), strict=True):
            yield int(passage[starts[k + row]]), part, term[starts[k + row] : ends[k + row]]
        k = stop


def scan(index: ItemIndex, docs: list[bytes]) -> list[tuple[int, list[dict]]]:
    """(number of passages, leaks) of each text."""
    stride = max(LEAST_STRIDE, index.longest)
    width, size = 2 * stride, max(1, len(index.vocabulary))
    get, coded, passage_of, keys, base, counts = index.vocabulary.get, [], [], [], 0, []
    for text in docs:
        words = words_of(text)
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        n = max(1, -(-len(words) // stride) - 1) if words else 0
        known = np.flatnonzero(ids >= 0)
        if n and len(known):
            last = np.minimum(known // stride, n - 1)
            first = np.maximum(known // stride - 1, 0)
            at = [last, first] if n == 1 else [last, first, np.full(len(known), n)]
            keys.append((base + np.concatenate(at)) * size + np.tile(ids[known], len(at)))
        coded.append(ids)
        passage_of.append(base)
        counts.append(n)
        base += n + (n > 1)
    out = [(n, []) for n in counts]
    if not keys:
        return out
    pairs = np.unique(np.concatenate(keys))  # distinct (passage, term)
    passage, term = pairs // size, pairs % size
    alive: dict[int, list[tuple[int, int, np.ndarray]]] = {}
    for p, part, terms in _alive(index, passage, term):
        d = bisect_right(passage_of, p) - 1
        alive.setdefault(d, []).append((p - passage_of[d], part, terms))
    for d, ids in enumerate(coded):
        if d in alive:
            out[d] = (counts[d], _doc_hits(index, ids, alive[d], counts[d], stride, width))
    return out


def _chunks(items: DataFrame, id_col: str, text_col: str, overlap: float) -> Iterator[ItemIndex]:
    """The benchmark as indexes of bounded size, with document frequencies of all of it."""
    rows = texts(items, id_col, text_col).where("doc_id is not null")
    rows = rows.distinct()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [split_item(t)[0] for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array(map(len, words), pa.int64()), pa.array([sorted(set(w)) for w in words], pa.list_(pa.binary()))],
                names=["doc_id", "n", "words"],
            )

    counted = rows.mapInArrow(count, "doc_id long, n long, words array<binary>").where("n > 0")
    total = counted.agg(F.count(F.lit(1)).alias("n"), F.avg("n").alias("mean"), F.max("n").alias("longest")).first()
    if not total["n"]:
        return
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    chunks = max(-(-total["n"] // CHUNK_ITEMS), -(-size // CHUNK_BYTES))
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(chunks))
    df = counted.select(F.explode("words").alias("word")).groupBy("word").count()
    for k in range(chunks):
        part = [(r["doc_id"], bytes(r["text"])) for r in rows.where(chunk == k).collect()]
        words = counted.where(chunk == k).select(F.explode("words").alias("word")).distinct()
        freq = {bytes(r["word"]): r["count"] for r in words.join(df, "word").collect()}
        if part:
            yield ItemIndex(part, freq, total["n"], total["mean"], overlap, total["longest"])


def find_leaks(
    docs: DataFrame, items: DataFrame, overlap: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, text_hash, n_passages, leaks), one row per row of ``docs``.

    leaks: for each test item found, its id, BM25 score and the shares of its
    shingles in the document. Words are runs of digits, letters and
    non-ASCII characters, A-Z lower-cased. Passages of all words of all texts
    are queries, and texts of several passages as a whole; NULL and empty texts have none. Items with a NULL id or
    without words leak nowhere; an item with fewer than five words must stand
    there whole; rows of ``items`` that share an id count as items each.
    Repeated rows are searched each; other columns do not matter.
    """
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col, text_hash(text_col).alias("text_hash"))
    rows = rows.select("doc_id", "text", "text_hash", F.lit(0).cast("long").alias("n_passages"), F.lit(None).cast(f"array<{HIT}>").alias("leaks"))
    for index in _chunks(items, item_id_col, item_text_col, overlap):
        shipped = spark.sparkContext.broadcast(index)

        def run(batches: Iterable[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = scan(shipped.value, batch.column(1).to_pylist())
                before = batch.column(4).to_pylist()
                leaks = [(old or []) + new for old, (_, new) in zip(before, found, strict=True)]
                yield pa.record_batch(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array([n for n, _ in found], pa.int64()),
                     pa.array(leaks, batch.schema.field(4).type)],
                    names=["doc_id", "text", "text_hash", "n_passages", "leaks"],
                )

        rows = rows.mapInArrow(run, f"doc_id long, text binary, text_hash long, n_passages long, leaks array<{HIT}>")
    return rows.select("doc_id", "text_hash", "n_passages", F.array_sort(F.coalesce("leaks", F.array().cast(f"array<{HIT}>"))).alias("leaks"))


def decontaminate(
    docs: DataFrame, items: DataFrame, overlap: float = 0.8, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """The documents that leak no item, in one pass per chunk of items; all columns stay. See ``find_leaks``."""
    for index in _chunks(items, item_id_col, item_text_col, overlap):
        shipped = docs.sparkSession.sparkContext.broadcast(index)
        docs = keep_rows(docs, text_col, lambda found, shipped=shipped: [not leaks for _, leaks in scan(shipped.value, found)])
    return docs
