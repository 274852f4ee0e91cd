"""Join shapes that the views, checks and graph plans share.

No strategy is forced. Catalyst broadcasts a side by its size, and adaptive
execution splits skewed shuffle partitions. The one hint here is in
``salted_join``, whose broadcast side has a proven row bound. Views and metrics
over a sales plan ask for a merge join, as estimates do not count unfolded rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.operators.sets import union_all


def flag_exists(left: DataFrame, right: DataFrame, key: Column, right_key: str, name: str) -> DataFrame:
    """Add a 0/1 column: is there a row in ``right`` for the left key?

    The right side is reduced to distinct keys first, so the join cannot
    multiply rows and a hot key costs one row.
    """
    probe = right.select(F.col(right_key).alias("_probe")).where(F.col("_probe").isNotNull()).distinct()
    return (
        left.withColumn("_key", key)
        .join(probe, F.col("_key") == F.col("_probe"), "left")
        .withColumn(name, F.col("_probe").isNotNull().cast("int"))
        .drop("_key", "_probe")
    )


def in_scope(rows: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Keep rows whose key exists in a dimension; takes no column from it."""
    keys = dim.select(F.col(dim_key).alias("_scope"))
    return rows.join(keys, rows[key] == F.col("_scope"), "left_semi")


def overlay(
    master: DataFrame,
    patch: DataFrame,
    key: str,
    value: str,
    when_patched: Mapping[str, Column],
    when_master: Mapping[str, Column],
) -> DataFrame:
    """Let a patch row win over the master value and say where the value is from.

    ``when_patched`` is evaluated on the patch row, ``when_master`` on the
    master row; both name the same provenance columns.
    """
    side = patch.select(
        F.col(key).alias("_patch_key"),
        F.col(value).alias("_patch_value"),
        *[expr.alias(f"_patched_{name}") for name, expr in when_patched.items()],
    )
    joined = master.join(side, F.col(key) == F.col("_patch_key"), "left")
    patched = F.col("_patch_key").isNotNull()
    out = [
        F.coalesce(F.col("_patch_value"), F.col(value)).alias(value) if c == value else F.col(c)
        for c in master.columns
    ]
    out += [
        F.when(patched, F.col(f"_patched_{name}")).otherwise(when_master[name]).alias(name)
        for name in when_patched
    ]
    return joined.select(*out)


def dangling(edges: DataFrame, ends: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Rows of ``edges`` for which at least one end has no partner.

    ``ends`` lists (edge column, other table, its key). Each end is looked up
    once in the distinct keys of the other table.
    """
    out, missing = edges, None
    for i, (column, other, key) in enumerate(ends):
        mark = f"_end{i}"
        keys = other.select(F.col(key).alias(mark)).where(F.col(mark).isNotNull()).distinct()
        out = out.join(keys, F.col(column) == F.col(mark), "left")
        absent = F.col(mark).isNull()
        missing = absent if missing is None else missing | absent
    return out.where(missing).select(*edges.columns)


def unresolved(rows: DataFrame, column: str, reference: DataFrame, key: str) -> DataFrame:
    """Rows with a non-null reference that the reference table does not hold."""
    keys = reference.select(F.col(key).alias("_ref"))
    return rows.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_ref"), "left_anti")


def dangling_counts(
    references: Sequence[tuple[str, DataFrame, Sequence[tuple[str, str]]]], keys: Mapping[str, DataFrame]
) -> DataFrame:
    """(name, error_count): for each named table its rows with a reference that does not resolve; only where found.

    A reference names one or two (column, kind of key); ``keys`` has one
    single-column table per kind. All tables share two joins, against one table
    of distinct (kind, key), instead of one join per reference. A NULL reference
    does not resolve; leave such rows out beforehand where NULL is allowed.
    """
    held = union_all(
        df.select(F.lit(kind).alias("_kind"), F.col(df.columns[0]).cast("string").alias("_key")) for kind, df in keys.items()
    ).distinct()
    none = F.lit(None).cast("string")
    ends = union_all(
        rows.select(
            F.lit(name).alias("name"),
            F.lit(ends[0][1]).alias("_kind"), F.col(ends[0][0]).cast("string").alias("_key"),
            (F.lit(ends[1][1]) if len(ends) > 1 else none).alias("_kind2"),
            (F.col(ends[1][0]).cast("string") if len(ends) > 1 else none).alias("_key2"),
        )
        for name, rows, ends in references
    )
    first = held.withColumn("_found", F.lit(True))
    second = held.select(F.col("_kind").alias("_kind2"), F.col("_key").alias("_key2"), F.lit(True).alias("_found2"))
    missing = F.col("_found").isNull() | (F.col("_kind2").isNotNull() & F.col("_found2").isNull())
    return (
        ends.join(first, ["_kind", "_key"], "left").join(second, ["_kind2", "_key2"], "left")
        .where(missing).groupBy("name").agg(F.count(F.lit(1)).alias("error_count"))
    )


def with_parent(rows: DataFrame, key: str, parent: str, columns: Mapping[str, str]) -> DataFrame:
    """Join each row to its base row: the parent if one is named, else itself.

    ``columns`` maps new names to columns of the base row.
    """
    base = rows.select(F.col(key).alias("_base"), *[F.col(c).alias(n) for n, c in columns.items()])
    lookup = F.coalesce(F.nullif(F.col(parent).cast("string"), F.lit("")), F.col(key).cast("string"))
    return (
        rows.withColumn("_lookup", lookup)
        .join(base.withColumn("_base", F.col("_base").cast("string")), F.col("_lookup") == F.col("_base"), "left")
        .drop("_lookup", "_base")
    )


def hot_keys(rows: DataFrame, key: str, share: float) -> DataFrame:
    """Keys that hold more than ``share`` of all rows: at most ``1 / share`` keys."""
    counts = rows.groupBy(key).count()
    total = counts.agg(F.sum("count").alias("n"))
    return counts.where(F.col("count") > F.lit(share) * total.scalar()).select(key)


def salted_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, share: float = 0.02, salts: int = 32
) -> DataFrame:
    """Inner equi join that spreads hot keys of ``right`` over ``salts`` tasks.

    Only keys above ``share`` of the right rows are salted. Their right rows are
    spread by a hash of the row (a retried task repeats it), and the left rows
    with such a key are copied once per salt. All other rows keep salt 0.
    The broadcast side has at most ``1 / share`` rows.
    """
    hot = F.broadcast(hot_keys(right, right_key, share).withColumnRenamed(right_key, "_hot"))
    spread = F.when(
        F.col("_hot").isNotNull(), F.pmod(F.xxhash64(*[F.col(c) for c in right.columns]), F.lit(salts)).cast("int")
    ).otherwise(F.lit(0))
    r = (
        right.join(hot, F.col(right_key) == F.col("_hot"), "left")
        .withColumn("_salt_r", spread)
        .drop("_hot")
    )
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    l = (
        left.join(hot, F.col(left_key) == F.col("_hot"), "left")
        .withColumn("_salt_l", F.explode(copies))
        .drop("_hot")
    )
    on = (F.col(left_key) == F.col(right_key)) & (F.col("_salt_l") == F.col("_salt_r"))
    return l.join(r, on).drop("_salt_l", "_salt_r")
