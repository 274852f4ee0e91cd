"""WARC archives with a two-level capture index.

Write: one gzip member per record, archives of bounded size. Index: captures
are sorted by key (reversed host, path, capture id) into shards; a shard holds
compressed blocks of lines, and beside it stands its sparse directory, one line
per block with the block's first key and place. Look up: binary search over the
shards' first keys, then over one directory, a range read of one block, a
binary search in it, and a range read of the record.

Archives lie in a folder that all executors share and that ``pyarrow.fs`` can
open (file, hdfs, s3, gs). A task that is run again writes new files; only
files of finished tasks are named in the written tables, so others are never
read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import slices
from opslake.sources.scratch import saved, shared_dir

ARCHIVE_BYTES = 1 << 30
BLOCK_LINES = 512
READ_SPAN = 8 << 20  # records of so many bytes of one archive are read by one task
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = "none"


def capture_key(url: Column, capture_id: Column) -> Column:
    """Sort key: host reversed by commas, ')', path and query, then the id as 16 hex digits.

    Scheme, user, port and fragment do not count; hosts are lower-cased. White
    space and control characters become '_'. A NULL url has an empty host, a
    NULL id sorts first.
    """
    text = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(text, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rest = F.regexp_replace(F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), "#.*", "")
    surt = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    sortable = F.lpad(F.hex(capture_id.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")  # signed order
    return F.concat(F.regexp_replace(surt, r"[\x00-\x20\x7F\u0085  ]", "_"), F.lit(" "), F.coalesce(sortable, F.lit("-" * 16)))


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def _header(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def record(page_id: int | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit without it."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{NO_ID if page_id is None else page_id}>",
        f"WARC-Target-URI: {_header(url)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1_hex)).decode()}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, payload) of one record; the payload of a revisit is empty."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    headers = {k.lower(): v for k, v in headers.items()}
    return headers, rest[: int(headers["content-length"])].partition(b"\r\n\r\n")[2]


def _urn_id(urn: str | None) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">") if urn else NO_ID
    return None if text == NO_ID else int(text)


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_bytes: int = 1000, date: str = "2000-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per page below ``folder``; (key, file, offset, length) of each, as a written table.

    Of equal payloads of ``least_bytes`` or more, the one with the largest id is
    the response and the others revisit it; all smaller ones are responses. A
    NULL html is an empty payload. Rows that share the largest id are responses
    each. NULL ids are never largest; payloads with NULL ids alone are responses.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"),
        F.sha1(payload).alias("sha1"),
    )
    first = (
        rows.where(F.octet_length("payload") >= least_bytes)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select(F.col("sha1").alias("same"), "first")
    )
    small = F.octet_length("payload") < least_bytes
    refers = F.when(~small & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    plan = rows.join(first, F.col("sha1") == F.col("same"), "left").select(
        "page_id", "url", "payload", "sha1", refers.alias("refers_to"), capture_key(F.col("url"), F.col("page_id")).alias("key")
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        out, name, at = None, "", 0
        for batch in slices(batches, "payload"):
            keys, files, offsets, lengths = [], [], [], []
            for page_id, url, body, sha1, refers_to, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or at >= archive_bytes:
                    if out:
                        out.close()
                    fs.create_dir(root, recursive=True)
                    name, at = f"{uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                zipped = zlib.compress(record(page_id, url, body, sha1, refers_to, date), 6, wbits=31)
                out.write(zipped)
                for column, value in zip((keys, files, offsets, lengths), (key, name, at, len(zipped)), strict=True):
                    column.append(value)
                at += len(zipped)
            yield pa.record_batch(
                [pa.array(keys, pa.string()), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                names=["key", "file", "offset", "length"],
            )
        if out:
            out.close()

    return saved(plan.mapInArrow(write, "key string, file string, offset long, length long"), f"{folder}-captures")


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> list[tuple[str, str]]:
    """Write shards and directories below ``folder``; (first key, shard name) in order, one per non-empty task."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        name, out, at, lines, directory, first = uuid4().hex, None, 0, [], [], None

        def flush() -> None:
            nonlocal at
            block = zlib.compress(b"\n".join(lines), 6)
            directory.append(b"%s %d %d" % (lines[0].rsplit(b" ", 3)[0], at, len(block)))
            out.write(block)
            at += len(block)
            lines.clear()

        for batch in batches:
            for key, file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    first = key
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}.cdx", compression=None)
                lines.append(f"{key} {file} {offset} {length}".encode())
                if len(lines) == block_lines:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        out.close()
        with fs.open_output_stream(f"{root}/{name}.idx", compression=None) as f:
            f.write(b"\n".join(directory))
        yield pa.record_batch([pa.array([first]), pa.array([name])], names=["first", "shard"])

    shards = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    found = saved(shards.mapInArrow(write, "first string, shard string"), f"{folder}-shards").collect()
    return sorted(((r["first"], r["shard"]) for r in found), key=lambda x: x[0].encode())


class CaptureIndex:
    """Look-ups in a written index. Holds one directory and one block at a time."""

    def __init__(self, folder: str, shards: list[tuple[str, str]]):
        self.fs, self.root = _open(folder)
        self.first = [key.encode() for key, _ in shards]
        self.names = [name for _, name in shards]
        self.shard, self.block = -1, (-1, -1)

    def _directory(self, shard: int) -> None:
        if shard != self.shard:
            with self.fs.open_input_file(f"{self.root}/{self.names[shard]}.idx") as f:
                rows = [line.rsplit(b" ", 2) for line in f.read().split(b"\n")]
            self.keys, self.places = [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]
            self.file = self.fs.open_input_file(f"{self.root}/{self.names[shard]}.cdx")
            self.shard = shard

    def _block(self, shard: int, k: int) -> None:
        if (shard, k) != self.block:
            at, size = self.places[k]
            self.file.seek(at)
            rows = [line.rsplit(b" ", 3) for line in zlib.decompress(self.file.read(size)).split(b"\n")]
            self.lines, self.line_keys, self.block = rows, [r[0] for r in rows], (shard, k)

    def lookup(self, key: str) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of all captures with the key; none if there is no such key."""
        want = key.encode()
        shard = max(0, bisect_left(self.first, want) - 1)  # equal keys may begin in the shard before
        while shard < len(self.names) and self.first[shard] <= want:
            self._directory(shard)
            k = max(0, bisect_left(self.keys, want) - 1)
            while k < len(self.keys) and self.keys[k] <= want:
                self._block(shard, k)
                for row in self.lines[bisect_left(self.line_keys, want) : bisect_right(self.line_keys, want)]:
                    yield row[1].decode(), int(row[2]), int(row[3])
                k += 1
            shard += 1


def find(keys: DataFrame, folder: str, shards: list[tuple[str, str]]) -> DataFrame:
    """(key, file, offset, length) of the captures of the distinct values of ``key``.

    Keys are sorted first, so a task walks through neighbouring blocks. The
    list of shards has one entry per index task.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CaptureIndex(folder, shards)
        for batch in batches:
            rows = [(key, *place) for key in batch.column(0).to_pylist() for place in index.lookup(key)]
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "file", "offset", "length"])

    wanted = keys.select("key").distinct().repartitionByRange("key").sortWithinPartitions("key")
    return wanted.mapInArrow(run, "key string, file string, offset long, length long")


READ = "page_id long, url string, record_type string, refers_to long, digest string, payload binary"


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """The records at (file, offset, length): id, url, type, refers_to, the header's digest (hex) and the payload.

    Places are grouped by stretches of one archive and read in order. The
    payload of a revisit is NULL. A damaged record is an error.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        name, f = None, None
        for batch in batches:
            rows, held = [], 0
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != name:
                    if f:
                        f.close()
                    name, f = file, fs.open_input_file(f"{root}/{file}")
                f.seek(offset)
                headers, payload = parse(zlib.decompress(f.read(length), wbits=31))
                kind = headers["warc-type"]
                digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"damaged record in {file} at {offset}")
                rows.append(
                    (_urn_id(headers["warc-record-id"]), headers["warc-target-uri"], kind, _urn_id(headers.get("warc-refers-to")),
                     digest, payload if kind == "response" else None)
                )
                held += len(payload)
                if held > 32 << 20:
                    yield _read_batch(rows)
                    rows, held = [], 0
            yield _read_batch(rows)

    stretch = F.floor(F.col("offset") / READ_SPAN)
    # A place is a short row that stands for a long record: the number of tasks follows the bytes of the records.
    total = places.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(1, -(-total // READ_SPAN))
    near = places.select("file", "offset", "length").repartition(tasks, "file", stretch).sortWithinPartitions("file", "offset")
    return near.mapInArrow(run, READ)


def _read_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    names = ["page_id", "url", "record_type", "refers_to", "digest", "payload"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def archive_round_trip(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None
) -> DataFrame:
    """Write all pages, look every capture up through the index and read it back.

    (page_id, url, record_type, refers_to, payload_bytes, payload_digest), one
    row per page row; rows that repeat id and url are read each. payload_bytes
    and payload_digest are those of the payload that was read, for a revisit the
    one of the response that it refers to. An empty table gives no row; other
    columns do not matter.
    """
    folder = folder or shared_dir(pages.sparkSession)
    archives, index = f"{folder}/archives", f"{folder}/index"
    shards = write_index(write_archives(pages, archives, id_col, url_col, html_col), index)
    keys = pages.select(capture_key(F.col(url_col), F.col(id_col).cast("long")).alias("key"))
    places = saved(find(keys, index, shards), f"{folder}/places")
    read = read_records(places, archives).select(
        "page_id", "url", "record_type", "refers_to", "digest",
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
    )
    read = saved(read, f"{folder}/read")
    revisits, responses = read.where("record_type = 'revisit'"), read.where("record_type = 'response'")
    full = responses.groupBy(F.col("page_id").alias("id"), F.col("payload_digest").alias("same")).agg(F.max("payload_bytes").alias("bytes"))
    resolved = revisits.join(full, (F.col("refers_to") == F.col("id")) & (F.col("digest") == F.col("same"))).select(
        "page_id", "url", "record_type", "refers_to", F.col("bytes").alias("payload_bytes"), F.col("same").alias("payload_digest")
    )
    return responses.select(*resolved.columns).union(resolved)
