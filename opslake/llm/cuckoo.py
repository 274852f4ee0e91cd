"""Exact deduplication with a cuckoo-filter index over the digests of live texts.

Texts are equal when their bytes are. Digests (SHA-256) are dealt to tasks by
value; each task keeps a cuckoo filter of its live digests. A miss means that a
digest is new. A hit is verified against the stored rows of its content bucket,
since a filter also hits by accident. When an insertion finds no room the
filter is rebuilt at twice the size from the stored digests. Equal digests of
one Arrow batch become one row before the shuffle, so copies that make up a
third of all rows do not load one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import fresh, texts
from opslake.sources.scratch import saved, shared_dir

SLOTS = 4
KICKS = 200
_MIX = 0x5BD1E995

# What a change does, in the order in which a task applies changes.
STORED, REMOVED, ADDED = 0, 1, 2
CHANGES = "digest binary, keep_id long, group_size long, ties long, change int"


class CuckooIndex:
    """Digests with a value each: insert, look up, delete."""

    def __init__(self, buckets: int = 1024):
        self.kicks = 0
        self.content: list[list[list]] = []
        self._make(1 << max(1, (buckets - 1).bit_length()), [])

    def _make(self, buckets: int, entries: Iterable[list]) -> None:
        """Empty filter and content of ``buckets`` buckets, filled with ``entries`` ([digest, value] each)."""
        self.mask, self.size = buckets - 1, 0
        self.filter: list[list[int]] = [[] for _ in range(buckets)]
        self.content = [[] for _ in range(buckets)]
        for entry in entries:
            self._add(entry)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        """Fingerprint (16 bits, never 0) and the two buckets where it may stand."""
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[:8], "little") & self.mask
        return mark, first, first ^ (mark * _MIX & self.mask)

    def _entry(self, digest: bytes) -> list | None:
        mark, first, second = self._places(digest)
        if mark not in self.filter[first] and mark not in self.filter[second]:
            return None
        for entry in self.content[first]:  # the filter may be wrong: compare whole digests
            if entry[0] == digest:
                return entry
        return None

    def _add(self, entry: list) -> None:
        mark, first, second = self._places(entry[0])
        self.content[first].append(entry)
        self.size += 1
        for at in (first, second):
            if len(self.filter[at]) < SLOTS:
                self.filter[at].append(mark)
                return
        at = second
        for turn in range(KICKS):
            bucket = self.filter[at]
            k = turn % SLOTS
            mark, bucket[k] = bucket[k], mark
            self.kicks += 1
            at ^= mark * _MIX & self.mask
            if len(self.filter[at]) < SLOTS:
                self.filter[at].append(mark)
                return
        self._make(2 * (self.mask + 1), [e for bucket in self.content for e in bucket])

    def get(self, digest: bytes):
        """The value of a live digest, else None."""
        entry = self._entry(digest)
        return entry[1] if entry else None

    def put(self, digest: bytes, value) -> bool:
        """Store a value; True when the digest was not live before."""
        entry = self._entry(digest)
        if entry:
            entry[1] = value
            return False
        self._add([digest, value])
        return True

    def remove(self, digest: bytes) -> bool:
        """Forget a digest; False when it is not live, and then nothing changes."""
        entry = self._entry(digest)
        if entry is None:
            return False
        mark, first, second = self._places(digest)
        self.content[first] = [e for e in self.content[first] if e is not entry]
        bucket = self.filter[first] if mark in self.filter[first] else self.filter[second]
        bucket.remove(mark)
        self.size -= 1
        return True

    def items(self) -> Iterator[tuple[bytes, object]]:
        for bucket in self.content:
            yield from ((digest, value) for digest, value in bucket)


def _merge(a: tuple, b: tuple) -> tuple:
    """(largest id, rows, rows that have the largest id) of two parts of a group; a NULL id is smaller than any."""
    if a[0] == b[0]:
        return a[0], a[1] + b[1], a[2] + b[2]
    top = b if a[0] is None or (b[0] is not None and b[0] > a[0]) else a
    return top[0], a[1] + b[1], top[2]


def _batch(rows: Iterable[tuple], change: int | None = None) -> pa.RecordBatch:
    """Rows (digest, (keep_id, group_size, ties)) as a batch, with a change if given."""
    rows = list(rows)
    arrays = [pa.array([d for d, _ in rows], pa.binary())] + [pa.array([v[i] for _, v in rows], pa.int64()) for i in range(3)]
    names = ["digest", "keep_id", "group_size", "ties"]
    if change is not None:
        arrays, names = [*arrays, pa.array(np.full(len(rows), change, np.int32))], [*names, "change"]
    return pa.record_batch(arrays, names=names)


def _combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, digest) rows as additions, equal digests of a batch as one."""
    for batch in batches:
        seen: dict[bytes, tuple] = {}
        for doc_id, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            one = (doc_id, 1, 1)
            seen[digest] = _merge(seen[digest], one) if digest in seen else one
        if seen:
            yield _batch(seen.items(), ADDED)


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Changes of one task, in order, through its index; the live digests at the end."""
    index = CuckooIndex()
    for batch in batches:
        for digest, keep, rows, ties, change in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if change == REMOVED:
                index.remove(digest)
                continue
            known = index.get(digest)
            index.put(digest, (keep, rows, ties) if known is None else _merge(known, (keep, rows, ties)))
    live = list(index.items())
    for i in range(0, len(live), 10_000):
        yield _batch(live[i : i + 10_000])


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest) of every row; NULL counts as the empty text."""
    return texts(docs, id_col, text_col).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))


def update_index(index: DataFrame | None, added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """Apply changes to a digest table: (digest, keep_id, group_size, ties).

    ``index`` is a table that this function gave before, ``removed`` holds
    digests that are no longer live, ``added`` holds (doc_id, digest). Removals
    come before additions. keep_id is the largest id (NULL only when all are),
    ties the number of rows that have it. Unknown removals change nothing.
    """
    parts = []
    if index is not None:
        parts.append(index.select("digest", "keep_id", "group_size", "ties", F.lit(STORED).alias("change")))
    if removed is not None:
        none = F.lit(None).cast("long")
        parts.append(removed.select("digest", none.alias("keep_id"), none.alias("group_size"), none.alias("ties"), F.lit(REMOVED).alias("change")))
    if added is not None:
        parts.append(added.select("doc_id", "digest").mapInArrow(_combine, CHANGES))
    changes = parts[0]
    for p in parts[1:]:
        changes = changes.union(p)
    dealt = changes.repartition("digest").sortWithinPartitions("change")
    return dealt.mapInArrow(_apply, CHANGES.rsplit(",", 1)[0])


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Of equal texts the row with the largest id is kept; a NULL id is smaller
    than any, and a NULL or empty text is the empty text. Rows that repeat both
    the largest id and the text: one of them is kept. An empty table gives no
    row; other columns do not matter.
    """
    folder = folder or shared_dir(docs.sparkSession)
    rows = saved(digests(docs, id_col, text_col), f"{folder}/digests")
    index = saved(update_index(None, rows), f"{folder}/index")
    groups = index.select(F.col("digest").alias("group"), "keep_id", "group_size", "ties")
    joined = rows.join(groups.where("group_size > 1"), F.col("digest") == F.col("group"), "left").select(
        "doc_id",
        F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("ties", F.lit(1)).alias("ties"),
        "digest",
    )
    top = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    repeated = groups.where("ties > 1").select(
        F.col("keep_id").alias("doc_id"), "keep_id", "group_size", F.explode(F.sequence(F.lit(1).cast("long"), "ties")).alias("turn"), "group"
    )
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    return (
        joined.where(~(top & (F.col("ties") > 1)))
        .select("doc_id", "keep_id", "group_size", top.alias("kept"), sha)
        .union(repeated.select("doc_id", "keep_id", "group_size", (F.col("turn") == 1).alias("kept"), F.lower(F.hex("group"))))
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """The documents with one row of each group of equal texts left, all columns kept; see ``exact_groups``.

    Where the row to keep stands in the table several times, one of them stays.
    """
    folder = folder or shared_dir(docs.sparkSession)
    index = saved(update_index(None, digests(docs, id_col, text_col)), f"{folder}/index")
    digest, group, keep, ties = (fresh(docs, name) for name in ("row_digest", "group_digest", "group_keep", "group_ties"))
    groups = index.where("group_size > 1").select(F.col("digest").alias(group), F.col("keep_id").alias(keep), F.col("ties").alias(ties))
    own = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    seen = docs.withColumn(digest, own).join(groups, F.col(digest) == F.col(group), "left")
    kept = seen.where(F.col(group).isNull() | F.col(id_col).eqNullSafe(F.col(keep)))
    once = F.coalesce(F.col(ties), F.lit(1)) == 1
    return kept.where(once).union(kept.where(~once).dropDuplicates([id_col, digest])).select(*docs.columns)
