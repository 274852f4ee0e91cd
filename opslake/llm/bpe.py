"""Byte-level BPE with a hierarchical-bitmap rank queue.

Text is cut by the pattern of the tokenizer; each match is encoded by itself.
The queue has one bucket per merge rank with the positions of pairs that may
merge at that rank, and a bitmap of two levels that finds the lowest rank in
use by find-first-set. Tokens of a match are a linked list over byte positions;
an entry whose pair has changed meanwhile is stale and skipped. A match of n
bytes costs O(n log n), so a match may be as long as the text. Many matches
share one queue, which spreads its cost over them.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from opslake.llm.common import slices, texts

# Segments that a Python worker remembers, in each of two generations, and the longest one.
REMEMBERED = 350_000
REMEMBERED_CHARS = 48
GROUP_CHARS = 4 << 20
_MET = (1 << 22) - 1  # words are remembered when a group meets them after another has
_LOW = 8  # bits of a rank below the summary level
_LOW_MASK = (1 << _LOW) - 1


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a rank file: a base64 token and its rank per line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def byte_pairs(ranks: dict[bytes, int]) -> np.ndarray:
    """Rank of every pair of bytes, at 256 times the first plus the second; -1 where they do not merge."""
    table = np.full(1 << 16, -1, np.int32)
    for token, rank in ranks.items():
        if len(token) == 2:
            table[token[0] << 8 | token[1]] = rank
    return table


def merge_all(pieces: list[bytes], ranks: dict[bytes, int], table: np.ndarray | None = None) -> list[list[int]]:
    """Token ids of each piece: the pair of lowest rank merges first, of equal ones the leftmost.

    All pieces stand in one buffer and share the queue; no pair crosses from one
    to the next. A bucket is emptied from left to right. A merge may make a pair
    of a lower rank; then the rest of the bucket waits until that is done.
    ``table`` is ``byte_pairs(ranks)``, for callers that have it.
    """
    buffer, get = b"".join(pieces), ranks.get
    n = len(buffer)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    first, at = bytearray(n + 1), 0  # 1 where a piece begins, and at the end
    for piece in pieces:
        first[at] = 1
        at += len(piece)
    first[n] = 1
    buckets: dict[int, list[int]] = {}
    words: dict[int, int] = {}
    summary = 0

    # Rank at which the token at a position merges with the next one, first of all of the bytes.
    data = np.frombuffer(buffer, np.uint8).astype(np.int32)
    start = (byte_pairs(ranks) if table is None else table)[data[:-1] << 8 | data[1:]]
    start[np.frombuffer(first, np.uint8)[1:n] != 0] = -1
    pair = [*start.tolist(), -1, -1][: n + 1]
    order = np.argsort(start, kind="stable")
    order = order[np.searchsorted(start[order], 0) :]
    cuts = np.flatnonzero(np.diff(start[order], prepend=-1)).tolist()
    for i, j in zip(cuts, [*cuts[1:], len(order)]):
        buckets[int(start[order[i]])] = order[i:j].tolist()
    for rank in buckets:
        high = rank >> _LOW
        words[high] = words.get(high, 0) | 1 << (rank & _LOW_MASK)
        summary |= 1 << high

    while summary:
        high = (summary & -summary).bit_length() - 1
        word = words[high]
        lowest = word & -word
        rank = high << _LOW | lowest.bit_length() - 1
        words[high] = word ^ lowest
        if word == lowest:
            summary ^= 1 << high
        bucket = buckets.pop(rank)
        bucket.sort()
        for p in bucket:
            if pair[p] != rank:  # stale
                continue
            q = after[p]
            end = after[p] = after[q]
            pair[q] = -1
            made = []
            if first[end]:
                pair[p] = -1
            else:
                before[end] = p
                new = pair[p] = get(buffer[p : after[end]], -1)
                if new >= 0:
                    made.append(p)
            if not first[p]:
                o = before[p]
                new = pair[o] = get(buffer[o:end], -1)
                if new >= 0:
                    made.append(o)
            lower = False
            for o in made:
                new = pair[o]
                if new in buckets:
                    buckets[new].append(o)
                else:
                    buckets[new] = [o]
                    high = new >> _LOW
                    words[high] = words.get(high, 0) | 1 << (new & _LOW_MASK)
                    summary |= 1 << high
                    lower = lower or new < rank
            if lower:
                rest = [o for o in bucket if o > p and pair[o] == rank]
                if rest:
                    buckets[rank] = rest + buckets.get(rank, [])
                    high = rank >> _LOW
                    words[high] = words.get(high, 0) | 1 << (rank & _LOW_MASK)
                    summary |= 1 << high
                break

    out, p = [], 0
    for piece in pieces:
        stop, ids = p + len(piece), []
        while p < stop:
            ids.append(ranks[buffer[p : after[p]]])
            p = after[p]
        out.append(ids)
    return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one match."""
    whole = ranks.get(piece)
    return [whole] if whole is not None else merge_all([piece], ranks)[0]


class Codec:
    """Encoder and decoder of one rank file. Ids are handled as decimal text joined by commas."""

    def __init__(self, data: bytes, pattern: str):
        self.ranks = read_ranks(data)
        self.table = byte_pairs(self.ranks)
        self.bytes_of = {str(rank): token for token, rank in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        # Marks that one byte stands for: "," and the id. The pattern must match a mark after a letter by itself.
        ends = [(m, self.ranks.get(m.encode())) for m in ".,;:!?" if self.find(f" a{m}") == [" a", m]]
        self.marks = {m: f",{rank}" for m, rank in ends if rank is not None}
        self.met = bytearray(_MET + 1)
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def encode(self, text: str) -> str:
        """Ids of a whole text."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[str]:
        """Ids of whole texts, in order. Texts are taken in groups, whose new words share one queue."""
        at = 0
        while at < len(texts):
            stop, held = at, 0
            while stop < len(texts) and (stop == at or held + len(texts[stop]) <= GROUP_CHARS):
                held += len(texts[stop])
                stop += 1
            yield from self._group(texts[at:stop])
            at = stop

    def _group(self, texts: list[str]) -> list[str]:
        """The pattern always starts a match at a space before a character that is no white space.

        So a text is cut there first, and most words are looked up, not cut by
        the pattern again. What follows a line break between two characters that
        are no white space, and a mark after a letter, are cut off in the same
        way: both are matches of their own, and what stands before them is
        matched as it would be without them.
        """
        if len(self.young) >= REMEMBERED:
            self.old, self.young, self.met = self.young, {}, bytearray(_MET + 1)
        known, marks, rows, new = self.young.get, self.marks, [], {}
        for text in texts:
            words = text.split(" ")
            out = list(map(known, words))
            holes = [i for i, ids in enumerate(out) if ids is None] if None in out else []
            if any(not words[i] or words[i][0].isspace() for i in holes if i):
                segments = self._segments(words)
                out, holes = [None] * len(segments), range(len(segments))
                fills = [(i, (segments[i],), "") for i in holes]
            else:
                out[0] = None
                fills = [(0, (words[0],), "")]
                for i in holes:
                    if not i:
                        continue
                    word, tail = words[i], marks.get(words[i][-1], "")
                    if tail and word[-2:-1].isalpha():
                        word = word[:-1]
                        if (ids := known(word)) is not None:
                            out[i] = ids + tail
                            continue
                    else:
                        tail = ""
                    lines = word.split("\n")
                    if len(lines) > 1 and all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                        fills.append((i, (" " + lines[0], *["\n" + x for x in lines[1:]]), tail))
                    else:
                        fills.append((i, (" " + word,), tail))
            new.update(dict.fromkeys(s for _, parts, _ in fills for s in parts))
            rows.append((out, fills))
        self._learn(new)
        results = []
        for out, fills in rows:
            for i, parts, tail in fills:
                out[i] = (new[parts[0]] if len(parts) == 1 else ",".join([new[s] for s in parts])) + tail
            results.append(",".join(filter(None, out)))
        return results

    @staticmethod
    def _segments(words: list[str]) -> list[str]:
        """Pieces of a text with odd white space: words next to it stay with the one before."""
        out, run = [], [words[0]]
        for word in words[1:]:
            if word and not word[0].isspace():
                out.append(" ".join(run))
                run = [" " + word]
            else:
                run.append(word)
        return [*out, " ".join(run)]

    def _learn(self, new: dict[str, str | None]) -> None:
        """Fill in the ids of segments; those after a space are remembered if short."""
        matches, pieces = {}, {}
        young, old = self.young, self.old
        for segment in new:
            word = self._key(segment)
            ids = word and (young.get(word) or old.get(word))
            if ids:
                new[segment] = young[word] = ids
            else:
                matches[segment] = parts = [segment] if word and word.isalpha() else self.find(segment)
                pieces.update(dict.fromkeys(parts))
        unknown = []
        for piece in pieces:
            coded = piece.encode()
            rank = self.ranks.get(coded)
            if rank is not None:
                pieces[piece] = str(rank)
                continue
            word = self._key(piece)
            ids = word and (young.get(word) or old.get(word))
            if ids:
                pieces[piece] = ids
            else:
                unknown.append((piece, coded))
        found = merge_all([coded for _, coded in unknown], self.ranks, self.table)
        for (piece, _), ids in zip(unknown, found, strict=True):
            pieces[piece] = ",".join(map(str, ids))
        met = self.met
        for segment, parts in matches.items():
            new[segment] = ids = ",".join([pieces[p] for p in parts]) if len(parts) > 1 else pieces[parts[0]] if parts else ""
            word = self._key(segment)
            if word:
                at = hash(segment) & _MET
                if met[at]:
                    young[word] = ids
                else:
                    met[at] = 1

    @staticmethod
    def _key(segment: str) -> str | None:
        """Under which a segment is remembered: without its space, or with one at the end after a line break; None if it is not."""
        if not 1 < len(segment) <= REMEMBERED_CHARS or segment[1].isspace():
            return None
        return segment[1:] if segment[0] == " " else segment + " " if segment[0] == "\n" else None

    def decode(self, ids: str) -> bytes:
        """Bytes of the ids; an unknown id is a KeyError."""
        return b"".join(map(self.bytes_of.__getitem__, ids.split(","))) if ids else b""


_codecs: dict[tuple[bytes, str], Codec] = {}


def _codec(data: bytes, pattern: str) -> Codec:
    """The worker's codec, with what it remembers from earlier tasks."""
    key = (hashlib.sha256(data).digest(), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(data, pattern)
    return _codecs[key]


def _shipped(docs: DataFrame, path: str):
    """The rank file, read on the driver; a few MB, so every task may have it."""
    with open(path, "rb") as f:
        data = f.read()
    if len(data) > 64 << 20:
        raise ValueError(f"{path} is too large for a rank file")
    return docs.sparkSession.sparkContext.broadcast(data)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids array<int>, decoded_sha256), one row per row of ``docs``.

    decoded_sha256 is the digest of the bytes that the ids give back.

    No special tokens: their names in a text are ordinary text. NULL and empty
    texts give no ids. Every row is encoded by itself, so repeated rows, NULL
    ids and an empty table need no rule; other columns do not matter.
    """
    data = _shipped(docs, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data.value, pattern)
        for batch in slices(batches):
            ids = list(codec.encode_all([t.decode() for t in batch.column(1).to_pylist()]))
            lists = [[int(x) for x in i.split(",")] if i else [] for i in ids]
            sha = [hashlib.sha256(codec.decode(i)).hexdigest() for i in ids]
            yield pa.record_batch(
                [batch.column(0), pa.array([len(x) for x in lists], pa.int64()), pa.array(lists, pa.list_(pa.int32())), pa.array(sha, pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded_sha256"],
            )

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, bytes) from the result of ``encode``."""
    data = _shipped(encoded, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data.value, "")
        for batch in batches:
            out = [codec.decode(",".join(map(str, ids or ()))) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded, and decoded from its ids.

    The digests are those of the decimal ids joined by commas and of the
    decoded bytes, in lower-case hex. Rows as in ``encode``; ids are not kept.
    """
    data = _shipped(docs, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data.value, pattern)
        for batch in slices(batches):
            counts, coded, decoded = [], [], []
            for ids in codec.encode_all([t.decode() for t in batch.column(1).to_pylist()]):
                counts.append(ids.count(",") + 1 if ids else 0)
                coded.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
