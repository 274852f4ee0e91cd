"""Business terms and their synonyms inside running text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.functions.text import pipe_list

# Words of one automaton; a longer list is searched in several passes.
CHUNK_BYTES = 8 << 20
_LOWER = {c: c + 32 for c in range(65, 91)}
_MATCHES = "array<struct<start_pos: bigint, end_pos: bigint, term: string>>"
# Matches that a task holds at once, besides those of one text.
HELD = 50_000


def word_list(terms: DataFrame) -> DataFrame:
    """(word, term) of (term, synonyms ``a|b|c``), A-Z lower-cased; a word of several terms goes to the first by name."""
    listed = terms.select("term", F.explode(F.array_union(pipe_list(F.col("synonyms")), F.array("term"))).alias("_w"))
    low = F.translate("_w", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return listed.where(F.length("_w") > 0).groupBy(low.alias("word")).agg(F.min("term").alias("term"))


def _chunks(words: DataFrame) -> Iterator[tuple[dict[str, str], bool]]:
    """(words and terms, is it the last), each of about CHUNK_BYTES."""
    part, size = {}, 0
    for r in words.toLocalIterator():
        if size > CHUNK_BYTES:
            yield part, False
            part, size = {}, 0
        part[r.word] = r.term
        size += len(r.word) + len(r.term)
    yield part, True


def all_matches(automaton, text: str) -> list[tuple[int, int, str]]:
    """(first, last character from 1, term) of every listed word that neither follows nor precedes a letter or digit."""
    low, found = text.translate(_LOWER), []
    for last, (length, term) in automaton.iter(low):
        first = last - length + 1
        if (first == 0 or not (low[first - 1].isalnum() and low[first].isalnum())) and (last + 1 == len(low) or not (low[last + 1].isalnum() and low[last].isalnum())):
            found.append((first + 1, last + 1, term))
    return found


def longest(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Matches that do not overlap: the leftmost, of these the longest, and so on."""
    out, end = [], 0
    for m in sorted(found, key=lambda m: (m[0], -m[1])):
        if m[0] > end:
            out.append(m)
            end = m[1]
    return out


def find_terms(docs: DataFrame, terms: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start_pos, end_pos, term): where the terms of (term, synonyms) stand in the texts, in order.

    An automaton (Aho-Corasick) over all words reads a text once, so time is
    linear in its length and its matches, however many words are listed. A task
    passes its matches on as they come and holds those of one text and HELD more.
    Positions count characters from 1, ends included. NULL and empty texts have
    no match; every row is searched by itself.
    """
    rows = docs.where(F.length(text) > 0).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.lit(None).cast(_MATCHES).alias("found"))
    kind = dict(rows.dtypes)["doc_id"]
    for words, last in _chunks(word_list(terms)):

        def run(batches: Iterable[pa.RecordBatch], words=words, last=last) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for word, term in words.items():
                automaton.add_word(word, (len(word), term))
            if words:
                automaton.make_automaton()
            for batch in batches:
                yield from _searched(batch, automaton if words else None, last)

        found = "start_pos bigint, end_pos bigint, term string" if last else f"text string, found {_MATCHES}"
        rows = rows.mapInArrow(run, f"doc_id {kind}, {found}")
    return rows


def _searched(batch: pa.RecordBatch, automaton, last: bool) -> Iterator[pa.RecordBatch]:
    """One row per match in the last pass; before it the texts, with what was found so far."""
    ids, texts, earlier = batch.columns
    first, sizes, flat = 0, [], ([], [], [])
    for i in range(batch.num_rows):
        held = [(m["start_pos"], m["end_pos"], m["term"]) for m in earlier[i].as_py() or ()]
        if automaton:
            held += all_matches(automaton, texts[i].as_py())
        if last:
            held = longest(held)
        sizes.append(len(held))
        for a, b, t in held:
            flat[0].append(a), flat[1].append(b), flat[2].append(t)
        if len(flat[0]) >= HELD or i == batch.num_rows - 1:
            matches = [pa.array(v, k) for v, k in zip(flat, (pa.int64(), pa.int64(), pa.string()), strict=True)]
            n, names = len(sizes), ["start_pos", "end_pos", "term"]
            if last:
                row = np.repeat(np.arange(first, first + n), sizes)
                yield pa.record_batch([ids.take(pa.array(row)), *matches], names=["doc_id", *names])
            else:
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.StructArray.from_arrays(matches, names=names))
                yield pa.record_batch([ids.slice(first, n), texts.slice(first, n), lists], names=["doc_id", "text", "found"])
            first, sizes, flat = i + 1, [], ([], [], [])
