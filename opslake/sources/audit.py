"""Checks of files, shapes and the catalog."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opslake.operators.sets import union_all

# Largest file that is read in one piece, and the piece of larger ones.
WHOLE_BYTES, BLOCK_BYTES = 256 << 20, 16 << 20
# Tasks over which large files are spread, one file each up to this number.
MOST_TASKS = 10_000


def scan_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Read every table in full: (table, rows, corrupt).

    Tables read with ``on_bad='keep'`` report their bad rows. All columns are
    hashed so that the scan decodes every column.
    """
    parts = []
    for name, df in tables.items():
        bad = F.count("_corrupt_record") if "_corrupt_record" in df.columns else F.lit(0).cast("bigint")
        seen = F.count(F.xxhash64(*[F.col(c) for c in df.columns]))
        parts.append(df.agg(F.lit(name).alias("table"), seen.alias("rows"), bad.alias("corrupt")))
    return union_all(parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows) without reading any column."""
    return union_all(
        df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()
    )


def files_of(df: DataFrame) -> DataFrame:
    """Files behind a file-based DataFrame with their size and row count."""
    return (
        df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size_bytes"))
        .groupBy("path", "size_bytes")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def file_hashes(spark: SparkSession, path: str, glob: str = "*", whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """(path, size_bytes, sha256) of whole files of any size below a directory.

    Files up to ``whole_bytes`` are read and hashed by Spark. Larger ones are
    read in blocks, so a task never holds more than a block; ``pyarrow.fs`` must
    be able to open those.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    )
    small = files.where(F.col("length") <= whole_bytes).select(
        "path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256")
    )

    def stream(batches):
        for batch in batches:
            hashes = []
            for name in batch.column(0).to_pylist():
                fs, inner = pafs.FileSystem.from_uri(quote(name, safe="/:"))
                digest = hashlib.sha256()
                with fs.open_input_stream(inner) as f:
                    while block := f.read(BLOCK_BYTES):
                        digest.update(block)
                hashes.append(digest.hexdigest())
            yield pa.record_batch([*batch.columns, pa.array(hashes, pa.string())], names=["path", "size_bytes", "sha256"])

    large = files.where(F.col("length") > whole_bytes).select("path", F.col("length").alias("size_bytes"))
    # Rows are short but stand for large files: a given number of tasks is not merged by the size of the rows.
    tasks = min(MOST_TASKS, max(1, large.count()))
    return small.unionByName(large.repartition(tasks).mapInArrow(stream, "path string, size_bytes long, sha256 string"))


def hash_report(hashes: DataFrame, manifest: DataFrame, root: str) -> DataFrame:
    """Compare file hashes with a manifest (relative_path, sha256): (relative_path, ok).

    A listed file that is absent is reported as not ok.
    """
    base = root.rstrip("/") + "/"
    # The root is literal text; a scheme such as file: may stand before it.
    begin = F.locate(base, F.col("path"))
    found = hashes.where(begin > 0).select(
        F.substr("path", begin + F.lit(len(base))).alias("relative_path"), F.col("sha256").alias("_found")
    )
    return manifest.join(found, "relative_path", "left").select(
        "relative_path", (F.coalesce(F.col("_found"), F.lit("")) == F.lower("sha256")).alias("ok")
    )


def shape_report(spark: SparkSession, df: DataFrame, expected: StructType, rows: int | None = None) -> DataFrame:
    """Differences from an expected schema and row count: (column, issue)."""
    have = {f.name: f for f in df.schema.fields}
    issues = []
    for f in expected.fields:
        got = have.pop(f.name, None)
        if got is None:
            issues.append((f.name, "missing"))
        elif got.dataType != f.dataType:
            issues.append((f.name, f"type {got.dataType.simpleString()}, expected {f.dataType.simpleString()}"))
        elif got.nullable and not f.nullable:
            issues.append((f.name, "nullable"))
    issues += [(name, "unexpected") for name in have]
    report = spark.createDataFrame(issues, "column string, issue string")
    if rows is None:
        return report
    counted = df.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != rows)
    return report.unionByName(
        counted.select(
            F.lit(None).cast("string").alias("column"),
            F.concat(F.col("n").cast("string"), F.lit(f" rows, expected {rows}")).alias("issue"),
        )
    )


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments; they are saved with the table and shown by DESCRIBE."""
    for name, text in comments.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "comment": text})
    return df


def dictionary(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Data dictionary (table, position, column, type, comment)."""
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.metadata.get("comment"))
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, "table string, position int, column string, type string, comment string")


def catalog_report(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """(name, kind, ok): does each object exist, and can its plan be analysed?"""
    kinds = {t.name: t.tableType for t in spark.catalog.listTables()}
    rows = []
    for name in names:
        ok = False
        if name in kinds:
            try:
                spark.table(name).schema
                ok = True
            except Exception:
                ok = False
        rows.append((name, kinds.get(name), ok))
    return spark.createDataFrame(rows, "name string, kind string, ok boolean")


def element_report(graph, allowed_kinds: Sequence[str] = ("VERTEX", "EDGE")) -> DataFrame:
    """(name, label, kind, key, properties, rows) of the elements of a graph; ``properties`` are sorted and comma-joined."""
    parts = []
    for kind, elements in (("VERTEX", graph.vertices), ("EDGE", graph.edges)):
        for e in elements if kind in allowed_kinds else ():
            parts.append(e.df.agg(
                F.lit(e.name).alias("name"), F.lit(e.label).alias("label"), F.lit(kind).alias("kind"), F.lit(e.key).alias("key"),
                F.lit(",".join(sorted(e.properties))).alias("properties"), F.count(F.lit(1)).alias("rows"),
            ))
    return union_all(parts)


def column_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, comment, filled): the dictionary with the non-NULL values of each column."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(*[F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
        rows = [
            F.struct(
                F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(f.metadata.get("comment")).cast("string").alias("comment"), F.col(f"_{i}").alias("filled"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
        parts.append(counts.select(F.lit(name).alias("table"), F.inline(F.array(*rows))))
    return union_all(parts)


def public_views(spark: SparkSession, allowed: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> list[str]:
    """Register only the allowed views, each with a fixed column list."""
    for name, (df, columns) in allowed.items():
        df.select(*columns).createOrReplaceTempView(name)
    return sorted(allowed)
