"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_by_day(df: DataFrame, path: str, day: str, mode: str = "errorifexists") -> None:
    """Parquet under ``year=/month=/day=`` from a date or date-text column.

    The rebalance hint groups the rows of a day into files and lets adaptive
    execution split a day that is too large for one task.
    """
    d = F.to_date(F.col(day))
    out = (
        df.withColumn("year", F.date_format(d, "yyyy"))
        .withColumn("month", F.date_format(d, "MM"))
        .withColumn("day", F.date_format(d, "dd"))
    )
    levels = ("year", "month", "day")
    out.hint("rebalance", *[F.col(c) for c in levels]).write.mode(mode).partitionBy(*levels).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)
