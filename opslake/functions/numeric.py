"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Decimals to which values are taken before they are summed exactly.
KEPT_DECIMALS = 6


def exact_avg(col: Column, digits: int, decimals: int = KEPT_DECIMALS) -> Column:
    """Rounded average whose result does not depend on the order of the rows.

    The sum runs over decimals, so a different partitioning or a retried task
    cannot move the last digit. Values are rounded to ``decimals`` decimals
    first; the views and metrics built on this do so too.
    """
    total = F.sum(col.cast(f"decimal(20,{decimals})"))
    rows = F.count(col).cast("decimal(20,0)")
    return F.round(F.try_divide(total, rows), digits).cast("double")


def exact_sum(col: Column, decimals: int = KEPT_DECIMALS) -> Column:
    """Sum over values rounded to ``decimals`` decimals as double, independent of the row order."""
    return F.sum(col.cast(f"decimal(20,{decimals})")).cast("double")


def half_even(col: Column, unit: int = 1) -> Column:
    """Round to a multiple of ``unit``, ties to the even multiple (money rule)."""
    return (F.bround(col.cast("double") / F.lit(unit), 0) * unit).cast("bigint")


def clamp(col: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part / whole`` in percent; NULL when ``whole`` is zero.

    Decimal division keeps ties exact before rounding.
    """
    share = F.try_divide(part.cast("decimal(20,0)") * 100, whole.cast("decimal(20,0)"))
    return F.round(share, digits).cast("double")


def gap_percent(forecast: Column, plan: Column, digits: int = 1) -> Column:
    """Share of a forecast that a plan leaves uncovered."""
    return percent(forecast - plan, forecast, digits)
