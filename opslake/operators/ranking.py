"""Sorting and ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.sources.scratch import saved


def top_k(rows: DataFrame, by: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of a total order; each task keeps only its own ``k``."""
    return rows.orderBy(*by).limit(k)


def top_k_per_group(rows: DataFrame, keys: Sequence[str], by: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of every group with their rank.

    The rank filter lets Spark cut each group to ``k`` rows before the shuffle,
    so a hot group ships ``k`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*by)
    return rows.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def numbered(rows: DataFrame, key: str, by: Sequence[Column], out: str, folder: str) -> DataFrame:
    """Add the place of each row within its ``key`` in the order ``by`` (NULL last), from 0.

    Rows are dealt to ranges of key and order and written once to ``folder``, so
    a hot key spreads over many tasks; a place is the number inside the range
    plus the key's rows in earlier ranges. Rows that ``by`` leaves equal stand
    in any order, all in one range.
    """
    names = [f"_by{i}" for i in range(len(by))]
    order = [F.col(n).asc_nulls_last() for n in names]
    dealt = rows.withColumns(dict(zip(names, by))).repartitionByRange(F.col(key), *order).withColumn("_range", F.spark_partition_id())
    dealt = saved(dealt, folder)
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col(key).alias("_key"), F.col("_range").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = dealt.withColumn("_pos", F.row_number().over(Window.partitionBy(key, "_range").orderBy(*order)))
    placed = inside.join(starts, (F.col("_range") == F.col("_at")) & F.col(key).eqNullSafe(F.col("_key")))
    return placed.select(*rows.columns, (F.col("_start") + F.col("_pos") - 1).cast("bigint").alias(out))
