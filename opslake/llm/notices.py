"""Fuzzy search for short license notices.

A notice that may have ``e`` errors is cut into ``e + 1`` pieces; in any match
at least one piece stands unchanged (pigeonhole), so an exact search for the
pieces finds all candidates. Around each candidate the ``regex`` library looks
for the notice with at most ``e`` insertions, deletions and substitutions.
Beside it, phrases are counted exactly as runs of words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from opslake.llm.common import slices, texts, words_of

# Phrases that count as places, with their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices as words, with their labels.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under a creative commons attribution license": "cc-by",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

# One error in so many characters of a notice.
CHARS_PER_ERROR = 10
STRETCH = 4
SEEN = 10_000  # parts whose matches a notice remembers, of some hundred bytes each

SPAN = "struct<label: string, first_word: long, last_word: long, errors: int, matched: string>"
RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    f"score double, spans array<{SPAN}>"
)


@dataclass
class Notice:
    """A notice ready for search."""

    text: bytes
    label: str
    errors: int
    pieces: list[tuple[bytes, int]] = field(init=False)
    pattern: regex.Pattern = field(init=False)

    def __post_init__(self):
        n, parts = len(self.text), self.errors + 1
        cuts = [n * k // parts for k in range(parts + 1)]
        self.pieces = [(self.text[a:b], a) for a, b in zip(cuts, cuts[1:], strict=False)]
        self.seen: dict[bytes, list[tuple[int, int, int]]] = {}
        self.pattern = regex.compile(b"(?b)(?:%s){e<=%d}" % (regex.escape(self.text), self.errors))

    def windows(self, text: bytes) -> Iterator[tuple[int, int]]:
        """Parts of the text that may hold the notice, joined where they overlap, in order."""
        found = set()
        for piece, at in self.pieces:
            p = text.find(piece)
            while p >= 0:
                found.add(p - at)
                p = text.find(piece, p + 1)
        start = stop = None
        for p in sorted(found):
            a, b = max(0, p - self.errors), min(len(text), p + len(self.text) + 2 * self.errors)
            if start is not None and a <= stop:
                stop = max(stop, b)
                continue
            if start is not None:
                yield start, stop
            start, stop = a, b
        if start is not None:
            yield start, stop

    def search(self, text: bytes) -> Iterator[tuple[int, int, int]]:
        """(start, stop, errors) of matches that do not overlap, in order: the best of a part, then what lies on both sides of it.

        Parts of more than 2 * STRETCH lengths of the notice are taken in stretches that overlap.
        """
        reach = len(self.text) + 2 * self.errors
        for start, stop in self.windows(text):
            # The best of a long part is sought in stretches, else each search would see all of it.
            while stop - start > 2 * STRETCH * reach:
                end = start + STRETCH * reach
                whole = [m for m in self._within(text, start, end) if m[1] <= end - reach]
                yield from whole
                start = max(end - 2 * reach, whole[-1][1] if whole else 0)
            yield from self._within(text, start, stop)

    def _within(self, text: bytes, start: int, stop: int) -> Iterator[tuple[int, int, int]]:
        part = text[start:stop]
        if part not in self.seen:
            if len(self.seen) >= SEEN:
                self.seen.clear()
            self.seen[part] = list(self._best(part))
        for a, b, errors in self.seen[part]:
            yield start + a, start + b, errors

    def _best(self, text: bytes) -> Iterator[tuple[int, int, int]]:
        todo: list[tuple[int, int] | tuple[int, int, int]] = [(0, len(text))]
        while todo:
            part = todo.pop()
            if len(part) == 3:
                yield part
            elif part[1] - part[0] >= len(self.text) - self.errors and (m := self.pattern.search(text, *part)):
                todo += [(m.end(), part[1]), (m.start(), m.end(), sum(m.fuzzy_counts)), (part[0], m.start())]


def prepare(notices: dict[str, str], chars_per_error: int) -> list[Notice]:
    return [Notice(text.encode(), label, max(1, len(text) // chars_per_error)) for text, label in notices.items()]


def _places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """First bytes of the phrase as whole words; places may share words."""
    p = joined.find(b" " + phrase + b" ")
    while p >= 0:
        yield p + 1
        p = joined.find(b" " + phrase + b" ", p + 1)


def scan(text: bytes, phrases: dict[str, str], notices: list[Notice]) -> dict:
    """One text's row, without the id."""
    words = words_of(text)
    joined = b" %s " % b" ".join(words)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)  # a word stands after each but the last
    word_at = lambda p: int(np.searchsorted(spaces, p)) - 1  # noqa: E731  number of spaces before p, less one
    starts, base = [], set()
    for phrase, label in phrases.items():
        for p in _places(joined, phrase.encode()):
            starts.append(word_at(p))
            base.add(label)
    spans, best = [], 1.0 if base else 0.0
    for notice in notices:
        for a, b, errors in notice.search(joined):
            best = max(best, 1 - errors / len(notice.text))
            first = max(0, word_at(a + (joined[a : a + 1] == b" ")))
            last = max(first, word_at(b - (joined[b - 1 : b] == b" ")))
            spans.append(
                {"label": notice.label, "first_word": first, "last_word": last, "errors": errors,
                 "matched": joined[a:b].strip().decode("utf-8", "replace")}
            )
    return {
        "n_words": len(words),
        "n_base": len(starts),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {s["label"] for s in spans})),
        "score": best,
        "spans": sorted(spans, key=lambda s: (s["first_word"], s["label"], s["last_word"])),
    }


def find_notices(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    chars_per_error: int = CHARS_PER_ERROR,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: words, exact places, labels, score and fuzzy spans.

    Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased.
    ``n_base`` counts all places of the phrases; first_word and last_word are
    their smallest and largest start, else NULL. ``spans`` are the fuzzy
    matches, in words; ``labels`` joins both. score: 1 for an exact place, else
    1 minus the errors per character of the best match, else 0. NULL and empty
    texts: no words, no labels, score 0. Repeated rows are scanned each; an
    empty table gives no row; other columns do not matter.
    """
    ready = prepare(notices, chars_per_error)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
         ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
         ("spans", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                                       ("errors", pa.int32()), ("matched", pa.string())])))]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            yield pa.RecordBatch.from_pylist([{"doc_id": i, **scan(t, phrases, ready)} for i, t in rows], schema=schema)

    return texts(docs, id_col, text_col).mapInArrow(run, RESULT)
