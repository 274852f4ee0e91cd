"""Ordered-series operators: time grids, runs of a condition, carried values.

A long series of one key (over KEY_ROWS rows) is cut into time chunks. Each
chunk is worked on by its own window group, and only a summary per chunk is
ordered per key, so a key that holds a third of all rows still spreads over many
tasks. A chunk is a clock hour, or a part of one: an hour with more than
CHUNK_ROWS rows of a key is cut at seconds, by the number of rows. All other
series are one chunk each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.functions.moments import seconds_between


# Rows of a key in one window group; only rows of one and the same second stay together beyond it.
CHUNK_ROWS = 1_000_000
# Rows of a key up to which its series is not cut at all.
KEY_ROWS = 100_000


def _with_chunk(rows: DataFrame, keys: Sequence[str], ts: Column, chunk: str, chunk_rows: int) -> DataFrame:
    """Add ``_chunk``: (start of the time unit, part of it by rows), and ``_cut``: does the key have several.

    Rows are counted by key first, and only long series are looked at by the
    second. Both tables that the rows are joined with are small by construction:
    there are at most rows / KEY_ROWS long series and rows / chunk_rows crowded
    units, so they are shipped and the rows are not moved.
    """
    unit, second, n = F.date_trunc(chunk, ts), F.date_trunc("second", ts), F.count(F.lit(1))
    names = [f"_b{i}" for i in range(len(keys))]
    own = [F.col(k).alias(b) for k, b in zip(keys, names)]

    def same(left: Sequence[str], right: Sequence[str]) -> Column:
        return reduce(and_, (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)))

    long = rows.groupBy(*own).agg(n.alias("_all")).where(F.col("_all") > min(KEY_ROWS, chunk_rows)).select(*names, F.lit(True).alias("_cut"))
    seconds = rows.join(F.broadcast(long), same(keys, names), "left_semi").groupBy(*own, unit.alias("_u"), second.alias("_s")).agg(n.alias("_n"))
    within = Window.partitionBy(*names, "_u")
    past = F.coalesce(F.sum("_n").over(within.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = (
        seconds.select(*names, "_u", "_s", F.floor(past / chunk_rows).alias("_part"), F.sum("_n").over(within).alias("_all"))
        .where(F.col("_all") > chunk_rows).groupBy(*names, "_u", "_part").agg(F.min("_s").alias("_from"))
    )
    # Where the parts of a crowded unit begin; a unit without a time has one part.
    crowded = parts.groupBy(*[F.col(b).alias(f"{b}_c") for b in names], F.col("_u").alias("_u_c")).agg(F.collect_list("_from").alias("_begins"))
    part = F.coalesce(F.size(F.filter("_begins", lambda x: x <= F.col("_second"))), F.lit(0))
    return (
        rows.join(F.broadcast(long), same(keys, names), "left")
        .withColumns({"_cut": F.coalesce("_cut", F.lit(False)), "_second": second})
        .withColumn("_unit", F.when(F.col("_cut"), unit))
        .join(F.broadcast(crowded), same([*keys, "_unit"], [*[f"{b}_c" for b in names], "_u_c"]) & F.col("_cut"), "left")
        .withColumn("_chunk", F.struct(F.col("_unit").alias("unit"), F.when(F.col("_begins").isNull(), 0).otherwise(part).alias("part")))
        .drop("_second", "_unit", "_u_c", "_begins", *names, *[f"{b}_c" for b in names])
    )


def running_grid(
    stock: DataFrame, sales: DataFrame, keys: Sequence[str], start: Column, ts: str, quantity: str,
    step_minutes: int, marks: int,
) -> DataFrame:
    """Quantity sold up to each mark of a regular time grid, per key.

    ``start`` gives the first mark from the key columns. A sale exactly on a
    mark counts for it; sales before the first mark count for the first; sales
    after the last mark do not count.

    Sales are summed per key and mark; a prefix sum over the marks that have
    sales gives stretches of marks with one total, and a stretch is unfolded to
    its marks. The cost of a sale does not depend on the number of marks, and a
    best seller ships one row per mark and task.
    """
    late = seconds_between(start, F.col(ts))
    mark = F.greatest(F.ceil(late / F.lit(step_minutes * 60)).cast("bigint"), F.lit(0).cast("bigint"))
    sums = (
        sales.withColumn("_mark", mark).where(F.col("_mark") < marks)
        .groupBy(*keys, "_mark").agg(F.sum(quantity).cast("bigint").alias("_n"))
    )
    by_mark = Window.partitionBy(*keys).orderBy("_mark")
    total = F.coalesce(F.sum("_n").over(by_mark.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).cast("bigint")
    stretch = lambda first, last, sold: F.struct(first.alias("_first"), last.alias("_last"), sold.alias("sold"))
    zero, last_mark = F.lit(0).cast("bigint"), F.lit(marks - 1).cast("bigint")
    ends = sums.select(*keys, "_mark", total.alias("_total"), (F.lead("_mark").over(by_mark) - 1).alias("_next"), F.lag("_mark").over(by_mark).alias("_before"))
    own = stretch(F.col("_mark"), F.coalesce("_next", last_mark), F.col("_total"))
    ahead = F.when(F.col("_before").isNull() & (F.col("_mark") > 0), F.array(own, stretch(zero, F.col("_mark") - 1, zero))).otherwise(F.array(own))
    stretches = ends.select(*keys, F.inline(ahead))
    return (
        stock.join(stretches, list(keys), "left")
        .select(
            *[F.col(c) for c in stock.columns], start.alias("_start"),
            F.explode(F.sequence(F.coalesce("_first", zero).cast("int"), F.coalesce("_last", last_mark).cast("int"))).alias("mark_no"),
            F.coalesce("sold", zero).alias("sold"),
        )
        .withColumn("mark_ts", F.timestamp_add("MINUTE", F.col("mark_no") * step_minutes, F.col("_start")))
        .drop("_start")
    )


def sustained(
    rows: DataFrame, keys: Sequence[str], ts: str, tie: str, flag: Column, min_seconds: int | Column,
    end: str | None = None, chunk: str = "hour", chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Runs of consecutive readings for which ``flag`` holds long enough.

    Returns (keys, start_ts, end_ts, readings) with ``end_ts - start_ts`` of at
    least ``min_seconds``, a number or an expression of the keys. ``end`` names the column that closes a reading (for
    windows); by default a reading is a point in time.
    """
    closes = F.col(end) if end else F.col(ts)
    base = rows.select(
        *keys,
        F.col(ts).alias("_ts"),
        F.col(tie).alias("_tie"),
        closes.alias("_end"),
        F.coalesce(flag, F.lit(False)).alias("_on"),
    )
    base = _with_chunk(base, keys, F.col("_ts"), chunk, chunk_rows)
    # With _cut as a key, the second use of the runs reads long series only.
    seq = Window.partitionBy(*keys, "_cut", "_chunk").orderBy("_ts", "_tie")
    turned = F.coalesce((F.lag("_on").over(seq) != F.col("_on")).cast("int"), F.lit(0))
    upto = seq.rowsBetween(Window.unboundedPreceding, 0)
    runs = (
        base.withColumns({"_turn": turned, "_final": F.lead("_on").over(seq).isNull()})
        .withColumn("_run", F.sum("_turn").over(upto))
        .groupBy(*keys, "_cut", "_chunk", "_run")
        .agg(
            F.first("_on").alias("_on"),
            F.min("_ts").alias("_start"),
            F.max("_end").alias("_stop"),
            F.count(F.lit(1)).alias("_n"),
            ((F.col("_run") == 0) | F.max("_final")).alias("_edge"),
        )
    )
    inner = runs.where(~(F.col("_edge") & F.col("_cut")) & F.col("_on")).select(*keys, "_start", "_stop", "_n")
    # Only the first and last run of a chunk can continue in a neighbour, where a series has several.
    order = Window.partitionBy(*keys).orderBy("_chunk", "_run")
    joins_previous = (
        (F.col("_run") == 0)
        & (F.lag("_on").over(order) == F.col("_on"))
        & (F.lag("_chunk").over(order) != F.col("_chunk"))
    )
    stitched = (
        runs.where("_cut AND _edge")
        .withColumn("_new", F.coalesce((~joins_previous).cast("int"), F.lit(1)))
        .withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .where("_on")
        .groupBy(*keys, "_island")
        .agg(F.min("_start").alias("_start"), F.max("_stop").alias("_stop"), F.sum("_n").alias("_n"))
        .drop("_island")
    )
    return (
        inner.unionByName(stitched)
        .where(seconds_between(F.col("_start"), F.col("_stop")) >= min_seconds)
        .select(
            *keys,
            F.col("_start").alias("start_ts"),
            F.col("_stop").alias("end_ts"),
            F.col("_n").cast("bigint").alias("readings"),
        )
    )


def carry_forward(
    rows: DataFrame, keys: Sequence[str], ts: str, tie: str, values: dict[str, Column], chunk: str = "hour",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add columns with the latest non-null value at or before each row. A NULL key is a key of its own."""
    marked = _with_chunk(rows, keys, F.col(ts), chunk, chunk_rows)
    seq = Window.partitionBy(*keys, "_chunk").orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    for name, value in values.items():
        marked = marked.withColumn(name, F.last(value, ignorenulls=True).over(seq))
    ends = marked.groupBy(*keys, "_chunk").agg(
        *[F.max_by(F.col(n), F.when(F.col(n).isNotNull(), F.struct(ts, tie))).alias(f"_end_{n}") for n in values]
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_chunk").alias("_c"),
        *[F.last(f"_end_{n}", ignorenulls=True).over(before).alias(f"_in_{n}") for n in values]
    )
    same = F.col("_chunk").eqNullSafe(F.col("_c"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = marked.join(carried, same, "left")
    for name in values:
        out = out.withColumn(name, F.coalesce(F.col(name), F.col(f"_in_{name}")))
    return out.drop("_chunk", "_cut", "_c", *[f"_k{i}" for i in range(len(keys))], *[f"_in_{n}" for n in values])
