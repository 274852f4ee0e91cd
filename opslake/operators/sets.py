"""Set operators."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def labelled_union(branches: Mapping[str, DataFrame], label: str) -> DataFrame:
    """UNION ALL of branches with a column that names the branch."""
    return union_all(df.withColumn(label, F.lit(name)) for name, df in branches.items())


def union_distinct(frames) -> DataFrame:
    return union_all(frames).distinct()


def symmetric_difference(a: DataFrame, b: DataFrame, label: str, a_name: str, b_name: str) -> DataFrame:
    """Distinct rows found on one side only, with the side's name.

    One grouping over both sides replaces two set differences. Grouping treats
    NULLs as equal, as a set difference does.
    """
    cols = a.columns
    both = a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    sides = both.groupBy(*cols).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return sides.where(F.col("_a") != F.col("_b")).select(
        F.when(F.col("_a") == 1, F.lit(a_name)).otherwise(F.lit(b_name)).alias(label), *cols
    )
