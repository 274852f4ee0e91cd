"""String, list and JSON column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(col: Column) -> Column:
    """An empty string means a missing value in the source files."""
    return F.nullif(col, F.lit(""))


def edge_id(source: Column, label: str, target: Column) -> Column:
    """``source|label|target``; NULL when either end is NULL."""
    return F.concat(source.cast("string"), F.lit(f"|{label}|"), target.cast("string"))


def base_name(path: Column) -> Column:
    """Last part of a slash-separated path."""
    return F.regexp_substr(path, F.lit("[^/]+$"))


def json_value(doc: Column, path: str) -> Column:
    return F.get_json_object(doc, path)


def json_object(members: Sequence[Column]) -> Column:
    """A JSON object that keeps members whose value is NULL."""
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})


def pipe_list(col: Column) -> Column:
    """``a|b|c`` as an array; NULL and empty text give an empty array."""
    return F.when(
        F.coalesce(F.length(col), F.lit(0)) > 0, F.split(col, r"\|")
    ).otherwise(F.array().cast("array<string>"))


def rank_of(col: Column, order: Sequence[str]) -> Column:
    """Position of a label in ``order`` from 1; unknown labels come last."""
    expr = F.when(col == order[0], F.lit(1))
    for position, label in enumerate(order[1:], start=2):
        expr = expr.when(col == label, F.lit(position))
    return expr.otherwise(F.lit(len(order) + 1))


# Task priorities from most to least urgent.
PRIORITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")


def priority_rank(col: Column) -> Column:
    return rank_of(col, PRIORITIES)
