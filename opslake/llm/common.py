"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows that Python holds at once. Texts may be long, so Arrow batches are cut further by bytes.
BATCH_BYTES = 8 << 20

_KEEP = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)).translate(_KEEP)


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters of UTF-8 text, A-Z lower-cased."""
    return text.translate(_WORDS).split()


def crc32_mod(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n).cast("long"))


def text_hash(text_col: str) -> Column:
    """Tells rows apart that share an id; a NULL text is the empty text."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """(doc_id, text as UTF-8 bytes; NULL counts as empty), and the columns ``more``."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
        *more,
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows (doc_id, text_hash) of ``gone``; a NULL id equals a NULL id."""
    one, two = fresh(docs, "gone_id"), fresh(docs, "gone_hash")
    rows = gone.select(F.col("doc_id").alias(one), F.col("text_hash").alias(two)).distinct()
    return docs.join(rows, F.col(id_col).eqNullSafe(F.col(one)) & (text_hash(text_col) == F.col(two)), "left_anti")


def keep_rows(docs: DataFrame, text_col: str, keep: Callable[[list[bytes]], Sequence[bool]]) -> DataFrame:
    """The rows whose text ``keep`` accepts, with all columns, in one pass without a shuffle; NULL counts as empty."""
    at = [c.lower() for c in docs.columns].index(text_col.lower())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            yield batch.filter(pa.array(keep([t or b"" for t in batch.column(at).cast(pa.binary()).to_pylist()]), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def slices(batches: Iterable[pa.RecordBatch], column: str | int = "text", size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column``, a name or position, holds about ``size`` bytes per slice (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.binary_length(batch.column(column))
        part = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False)) // size
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))


def int64s(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """A column of whole numbers without NULL."""
    return batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
