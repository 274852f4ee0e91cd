"""As-of join: for each question the latest row at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.sources.scratch import saved, shared_dir


def as_of(
    asked: DataFrame, rows: DataFrame, keys: Sequence[str], asked_at: str, rows_at: str, ties: Sequence[tuple[str, bool]] = (),
    how: str = "inner", folder: str | None = None,
) -> DataFrame:
    """The columns of ``asked`` and those of ``rows`` without ``keys``, for each question the row in force at its time.

    In force is the row of the same ``keys`` with the largest ``rows_at`` at or
    before ``asked_at``; of equal times, ``ties`` decide: (column, does the
    larger win). A NULL key is a key of its own, a row or question without a
    time matches nothing. ``how='left'`` keeps questions without a row.

    Rows and questions are merged in one order, dealt to ranges of it and
    written once. A question takes the last row before it in its range, else
    what earlier ranges of its key end with, from one row per key and range. So
    one key may hold most rows, and no question is compared with more than one.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how: {how!r}")
    taken = [c for c in rows.columns if c not in keys]
    clash = set(taken) & set(asked.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    names = [f"_k{i}" for i in range(len(keys))]
    kinds = {c: t for c, t in rows.dtypes}
    own = [F.col(k).alias(n) for k, n in zip(keys, names)]
    row, question = F.struct(*taken), F.struct(*asked.columns)
    row_type = "struct<" + ", ".join(f"`{c}`: {kinds[c]}" for c in taken) + ">"
    question_type = "struct<" + ", ".join(f"`{c}`: {t}" for c, t in asked.dtypes) + ">"
    time = dict(asked.dtypes)[asked_at]

    held = rows.where(F.col(rows_at).isNotNull()).select(
        *own, F.col(rows_at).cast(time).alias("_at"), F.lit(0).alias("_kind"), *[F.col(c).alias(f"_t{i}") for i, (c, _) in enumerate(ties)],
        F.lit(None).cast("bigint").alias("_any"), row.alias("_row"), F.lit(None).cast(question_type).alias("_asked"),
    )
    wanted = asked.where(F.col(asked_at).isNotNull()).select(
        *own, F.col(asked_at).alias("_at"), F.lit(1).alias("_kind"), *[F.lit(None).cast(kinds[c]).alias(f"_t{i}") for i, (c, _) in enumerate(ties)],
        F.xxhash64(*asked.columns).alias("_any"), F.lit(None).cast(row_type).alias("_row"), question.alias("_asked"),
    )
    # The winner of equal times stands last; questions of one time come after all rows of it and are spread by a hash.
    ahead = [F.col("_at").asc(), F.col("_kind").asc(), *[F.col(f"_t{i}").asc_nulls_first() if larger else F.col(f"_t{i}").desc_nulls_first() for i, (_, larger) in enumerate(ties)], F.col("_any").asc()]
    back = [F.col("_row").isNull().asc(), F.col("_at").desc(), *[F.col(f"_t{i}").desc_nulls_last() if larger else F.col(f"_t{i}").asc_nulls_last() for i, (_, larger) in enumerate(ties)]]
    merged = held.union(wanted).repartitionByRange(*[F.col(n).asc_nulls_first() for n in names], *ahead).withColumn("_range", F.spark_partition_id())
    merged = saved(merged, folder or shared_dir(asked.sparkSession))

    inside = Window.partitionBy(*names, "_range").orderBy(*ahead).rowsBetween(Window.unboundedPreceding, 0)
    answered = merged.withColumn("_last", F.last("_row", ignorenulls=True).over(inside)).where(F.col("_asked").isNotNull())
    ends = merged.withColumn("_n", F.row_number().over(Window.partitionBy(*names, "_range").orderBy(*back))).where("_n = 1")
    before = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *[F.col(n).alias(f"{n}_c") for n in names], F.col("_range").alias("_range_c"), F.last("_row", ignorenulls=True).over(before).alias("_in")
    )
    on = F.col("_range") == F.col("_range_c")
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"{n}_c"))
    found = answered.join(carried, on).withColumn("_row", F.coalesce("_last", "_in"))
    if how == "inner":
        return found.where(F.col("_row").isNotNull()).select("_asked.*", "_row.*")
    timeless = asked.where(F.col(asked_at).isNull()).select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in taken])
    return found.select("_asked.*", "_row.*").union(timeless)
