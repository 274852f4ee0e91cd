"""Typed readers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from opslake.functions.text import blank_to_null
from opslake.sources.schemas import TABLES

# Directory levels of a table that is stored by day.
DAY_LEVELS = ("year", "month", "day")

# Pass as ``blank`` when no column of the table uses '' for a missing value.
NEVER_BLANK: tuple[str, ...] = ()


def _nulls_for_blanks(df: DataFrame, blank: Sequence[str] | None) -> DataFrame:
    """Rewrite '' to NULL; ``None`` means every text column."""
    if blank is None:
        blank = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    for name in blank:
        df = df.withColumn(name, blank_to_null(F.col(name)))
    return df


def _directory_levels(df: DataFrame) -> set[str]:
    """Columns that Spark takes from the directory names, by the relation itself; no file is listed again."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return {name for k in range(leaves.size()) for name in leaves.apply(k).relation().partitionSchema().fieldNames()}


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | StructType | None = None,
    days: Iterable[date] | None = None,
    blank: Sequence[str] | None = None,
) -> DataFrame:
    """Parquet file or directory tree.

    Without a schema Spark takes it from one file and does not merge. ``days``
    keeps only the named day directories; the filter is on the partition
    columns, so other files are not opened. Day levels that come from the
    directories are not part of the result; columns of the same name that the
    files or the given schema hold are data and stay.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    given = StructType.fromDDL(schema).fieldNames() if isinstance(schema, str) else schema.fieldNames() if schema is not None else []
    levels = [c for c in DAY_LEVELS if c in _directory_levels(df) and c not in given]
    if days is not None:
        if len(levels) != len(DAY_LEVELS):
            raise ValueError("this table is not stored by day")
        wanted = None
        for d in days:
            one = (F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day)
            wanted = one if wanted is None else wanted | one
        df = df.where(wanted if wanted is not None else F.lit(False))
    return _nulls_for_blanks(df.drop(*levels), blank)


def read_csv(spark: SparkSession, path: str, schema: str | StructType, on_bad: str = "drop") -> DataFrame:
    """CSV with a header and declared types.

    ``on_bad='drop'`` skips rows that do not fit the schema, ``'fail'`` stops,
    ``'keep'`` adds the raw text of such rows as ``_corrupt_record``. All columns
    are parsed even when few are read, so a row is bad or good for every query.
    """
    modes = {"drop": "DROPMALFORMED", "fail": "FAILFAST", "keep": "PERMISSIVE"}
    parsed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if on_bad == "keep":
        parsed = StructType(parsed.fields).add("_corrupt_record", StringType())
    df = (
        spark.read.schema(parsed)
        .option("header", True)
        .option("mode", modes[on_bad])
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .csv(path)
    )
    # Spark converts only the columns a query needs. This condition is always
    # true and needs them all.
    return df.where(F.hash(*[F.col(c) for c in df.columns]) >= F.lit(-(2**31)))


def all_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column as text; a leading byte-order mark is dropped."""
    return spark.read.option("header", True).csv(path)


def read_json(
    spark: SparkSession, path: str, schema: str | StructType, blank: Sequence[str] | None = None
) -> DataFrame:
    """JSON Lines with declared types."""
    return _nulls_for_blanks(spark.read.schema(schema).json(path), blank)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A few literal rows, e.g. the seed of a relation table."""
    return spark.createDataFrame(list(rows), schema)


def read_known(spark: SparkSession, root: str, name: str, days: Iterable[date] | None = None) -> DataFrame:
    """A table of ``TABLES`` below a root location."""
    spec = TABLES[name]
    path = f"{root.rstrip('/')}/{spec.path}"
    if spec.fmt == "csv":
        return read_csv(spark, path, spec.ddl)
    if spec.fmt == "json":
        return read_json(spark, path, spec.ddl, spec.blank)
    return read_table(spark, path, spec.ddl, days, spec.blank)


def ensure_table(spark: SparkSession, name: str, path: str, schema: str | StructType) -> DataFrame:
    """The view or table called ``name``; made from the CSV only if absent."""
    if not spark.catalog.tableExists(name):
        read_csv(spark, path, schema).createTempView(name)
    return spark.table(name)
