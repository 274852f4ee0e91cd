"""Aggregation shapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.functions.numeric import percent
from opslake.sources.scratch import saved, shared_dir


def count_where(pred: Column) -> Column:
    """Rows for which the predicate is true (0, not NULL, when none)."""
    return F.count(F.when(pred, F.lit(1)))


def count_battery(rows: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Many conditional counts in one scan, one row."""
    return rows.agg(*[count_where(pred).alias(name) for name, pred in checks.items()])


def metric_columns(rows: DataFrame, keys: Sequence[str], metric: str, wanted: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Metric rows to columns in one aggregation.

    ``wanted`` maps an output name to (metric label, aggregate of the value),
    e.g. ``("fan_rpm", F.min)`` applied to the value column by the caller.
    """
    return rows.groupBy(*keys).agg(
        *[agg(F.when(F.col(metric) == label, value)).alias(name) for name, (label, agg, value) in wanted.items()]
    )


def offending_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are NULL or occur more than once, with their row count."""
    is_null = None
    for k in keys:
        is_null = F.col(k).isNull() if is_null is None else is_null | F.col(k).isNull()
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(is_null | (F.col("row_count") > 1))


def failure_columns(result: Column, ok: str, digits: int = 1) -> list[Column]:
    """Aggregates ``attempts``, ``failures`` (everything that is not ``ok``) and ``failure_rate_pct``."""
    attempts, failures = F.count(F.lit(1)), count_where(F.coalesce(result, F.lit("")) != ok)
    return [
        attempts.alias("attempts"), failures.alias("failures"),
        percent(failures, attempts, digits).alias("failure_rate_pct"),
    ]


def failure_rate(rows: DataFrame, keys: Sequence[str], result: str, ok: str, digits: int = 1) -> DataFrame:
    return rows.groupBy(*keys).agg(*failure_columns(F.col(result), ok, digits))


def first_time(rows: DataFrame, keys: Sequence[str], ts: str, pred: Column, name: str) -> DataFrame:
    """Earliest time at which a predicate holds, per key."""
    return rows.groupBy(*keys).agg(F.min(F.when(pred, F.col(ts))).alias(name))


def json_pages(
    rows: DataFrame, key: str, order: Sequence[Column], payload: Column, page_rows: int = 1000, folder: str | None = None
) -> DataFrame:
    """Ordered JSON arrays per key, in pages of exactly ``page_rows`` members but for the last.

    Returns (key, page_no, members, json). Page 0 holds the first ``page_rows``
    members of the key, and so on, whatever the number of partitions.

    Rows are dealt to ranges of key and order, so a hot key spreads over many
    tasks, and written once to ``folder`` (a shared scratch folder by default):
    ranges must be the same for all that follows, also when a task is lost. A
    row's place is its number inside the range plus the key's rows in earlier
    ranges, from a table of one count per key and range. No group ever holds
    more than a page. A NULL key is a key of its own.
    """
    sort_cols = [f"_o{i}" for i in range(len(order))]
    by = [*[F.col(c).asc_nulls_last() for c in sort_cols], F.col("_json")]
    dealt = saved(
        rows.select(F.col(key), payload.alias("_json"), *[o.alias(n) for n, o in zip(sort_cols, order)])
        .repartitionByRange(F.col(key), *by)
        .withColumn("_range", F.spark_partition_id()),
        folder or shared_dir(rows.sparkSession),
    )
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col(key).alias("_key"), F.col("_range").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    numbered = dealt.withColumn("_pos", F.row_number().over(Window.partitionBy(key, "_range").orderBy(*by)))
    placed = numbered.join(starts, (F.col("_range") == F.col("_at")) & F.col(key).eqNullSafe(F.col("_key"))).select(
        key, "_json", (F.col("_start") + F.col("_pos") - 1).cast("bigint").alias("_place")
    )
    page = F.floor(F.col("_place") / page_rows).cast("bigint")
    return (
        placed.groupBy(key, page.alias("page_no"))
        .agg(F.array_sort(F.collect_list(F.struct("_place", "_json"))).alias("_rows"))
        .select(
            key, "page_no", F.size("_rows").cast("bigint").alias("members"),
            F.concat(F.lit("["), F.array_join(F.transform("_rows", lambda r: r["_json"]), ","), F.lit("]")).alias("json"),
        )
    )
