"""Changes to data as new DataFrames, and versioned snapshots to keep them.

Nothing is updated in place. A change takes a table and gives the changed
table; a what-if builds a second graph and needs no undo.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.operators.aggregates import count_where, offending_keys
from opslake.operators.sets import union_all
from opslake.plans.graph import GraphSpec
from opslake.plans.kg import impact_by_stage, incident_impact, open_tasks, related_documents


class ChangeError(ValueError):
    """A change that must not be applied."""

    def __init__(self, message: str, code: int | None = None):
        super().__init__(message)
        self.code = code


def require_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key is NULL or repeated; looks for one offending key only."""
    if offending_keys(rows, keys).limit(1).count():
        raise ChangeError(f"NULL or duplicate key in {list(keys)}")


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None,
    insert_defaults: Mapping[str, Column] | None = None, check: bool = True,
) -> DataFrame:
    """Update rows of ``target`` that match ``source`` on ``keys``, insert the others.

    ``update`` limits the columns that a match changes. Columns that the source
    lacks keep their value on a match and take ``insert_defaults`` or NULL on an
    insert. A source with NULL or duplicate keys is refused. Both sides are
    shuffled once, on the key.
    """
    if check:
        require_unique(source, keys)
    given = [c for c in source.columns if c not in keys]
    changed = set(given if update is None else update)
    defaults = insert_defaults or {}
    t = target.withColumn("_in_target", F.lit(True))
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in given], F.lit(True).alias("_in_source"))
    both = t.join(s, list(keys), "full")
    is_new = F.col("_in_target").isNull()
    matched = F.col("_in_target").isNotNull() & F.col("_in_source").isNotNull()

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        on_insert = F.col(f"_s_{c}") if c in given else defaults.get(c, F.lit(None))
        expr = F.when(is_new, on_insert)
        if c in given and c in changed:
            expr = expr.when(matched, F.col(f"_s_{c}"))
        return expr.otherwise(F.col(c))

    types = dict(target.dtypes)
    return both.select(*[value(c).cast(types[c]).alias(c) for c in target.columns])


def new_ids(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Give each row the next id above every existing one: no gaps, and the same ids whenever the plan is run.

    Rows are dealt by a hash of their content, numbered inside a bucket and
    shifted by the rows of the buckets before it. Rows that agree in all
    columns are interchangeable, so any order among them will do.
    """
    others = [c for c in rows.columns if c != key]
    content = F.xxhash64(*others)
    top = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("m"))
    dealt = rows.drop(key).withColumns({"_hash": content, "_bucket": F.pmod(content, F.lit(ID_BUCKETS)).cast("int")})
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    starts = dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", *others))
    numbered = dealt.withColumn("_place", place).join(starts, "_bucket")
    return numbered.withColumn(key, top.scalar() + F.col("_start") + F.col("_place")).drop("_hash", "_bucket", "_place", "_start").select(*others, key)


def upsert_by_natural_key(
    tasks: DataFrame, source: DataFrame, natural: Sequence[str], key: str = "task_id",
    insert_defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Upsert on a natural key; a known row keeps its id, a new one gets the next ids.

    Refused when the natural key of a source row is repeated in the source or
    matches more than one row of the target.
    """
    require_unique(source, natural)
    touched = tasks.join(source.select(*natural), list(natural), "left_semi").select(*tasks.columns)
    require_unique(touched, natural)
    rest = tasks.join(source.select(*natural), list(natural), "left_anti").select(*tasks.columns)
    merged = upsert(touched, source, natural, insert_defaults=insert_defaults, check=False)
    known = merged.where(F.col(key).isNotNull())
    fresh = new_ids(merged.where(F.col(key).isNull()), tasks, key).select(*tasks.columns)
    return union_all([rest, known, fresh])


# Parts in which new rows are numbered.
ID_BUCKETS = 4096

# Task priorities and the defaults of a new task.
TASK_PRIORITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
NEW_TASK_STATUS = "OPEN"
INVALID_PRIORITY = -20001


def insert_checked(tasks: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Insert task rows: (changed table, rejected rows with the reason).

    The priority is upper-cased and must be known; incident and title are
    required. New rows get an id, the current time and the state OPEN. Columns
    the caller leaves out are NULL.
    """
    priority = F.upper(F.col("priority"))
    reason = (
        F.when(priority.isNotNull() & ~priority.isin(*TASK_PRIORITIES), f"{INVALID_PRIORITY} Invalid priority")
        .when(F.col("incident_id").isNull(), "incident_id is NULL")
        .when(F.col("task_title").isNull(), "task_title is NULL")
    )
    checked = rows.withColumn("reject_reason", reason)
    types = dict(tasks.dtypes)
    stamped = {"created_at": F.current_timestamp(), "status": F.lit(NEW_TASK_STATUS), "priority": priority}

    def value(c: str) -> Column:
        if c in stamped and c in types:
            return stamped[c].cast(types[c])
        return (F.col(c) if c in rows.columns else F.lit(None)).cast(types[c])

    plain = [c for c in tasks.columns if c != "task_id"]
    good = checked.where(F.col("reject_reason").isNull()).select(*[value(c).alias(c) for c in plain])
    inserted = new_ids(good, tasks, "task_id").select(*[F.col(c).cast(types[c]) for c in tasks.columns])
    return tasks.unionByName(inserted), checked.where(F.col("reject_reason").isNotNull())


@dataclass(frozen=True)
class Constraints:
    """Declared constraints of a relation table."""

    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    checks: Mapping[str, tuple[str, ...]] | None = None


# Constraints of the relation tables.
CONSTRAINTS = {
    "lot_patch": Constraints(
        ("equipment_id",), ("manufacturing_lot", "source_type", "source_reference_id", "assertion_status", "effective_date"),
        {"assertion_status": ("VERIFIED", "PROVISIONAL", "SYNTHETIC")}),
    "task_equipment": Constraints(("task_id", "equipment_id"), ("source_type", "source_reference_id")),
    "task_document": Constraints(("task_id", "document_id"), ("source_type", "source_reference_id")),
    "lot_document": Constraints(
        ("manufacturing_lot", "document_id"), ("relation_type", "source_type", "source_reference_id")),
    "tasks": Constraints(("task_id",), ("incident_id", "task_title"), {"priority": TASK_PRIORITIES}),
}


def constraint_violations(rows: DataFrame, spec: Constraints) -> DataFrame:
    """(rule, violations): primary key, NOT NULL and CHECK rules. A CHECK accepts NULL."""
    key = offending_keys(rows, spec.key).agg(
        F.lit(f"key {','.join(spec.key)}").alias("rule"), F.count(F.lit(1)).alias("violations")
    )
    flags = {f"not null {c}": F.col(c).isNull() for c in spec.required}
    for c, allowed in (spec.checks or {}).items():
        flags[f"check {c}"] = F.col(c).isNotNull() & ~F.col(c).isin(*allowed)
    if not flags:
        return key
    counts = rows.agg(*[count_where(p).alias(f"_c{i}") for i, p in enumerate(flags.values())])
    pairs = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(f"_c{i}").alias("violations")) for i, rule in enumerate(flags)
    ])
    return key.unionByName(counts.select(F.inline(pairs)))


def apply_update(rows: DataFrame, pred: Column, values: Mapping[str, Column], expected: int | None = None) -> DataFrame:
    """Rewrite columns of matching rows; refuse unless exactly ``expected`` rows match."""
    _require_count(rows, pred, expected)
    hit = F.coalesce(pred, F.lit(False))
    return rows.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def apply_delete(rows: DataFrame, pred: Column, expected: int | None = None) -> DataFrame:
    """Drop matching rows; refuse unless exactly ``expected`` rows match."""
    _require_count(rows, pred, expected)
    return rows.where(~F.coalesce(pred, F.lit(False)))


def delete_matching(rows: DataFrame, keys: DataFrame, on: Sequence[str], expected: int | None = None) -> DataFrame:
    """Drop rows whose key is in ``keys``; refuse unless exactly ``expected`` rows match."""
    if expected is not None:
        found = rows.join(keys, list(on), "left_semi").count()
        if found != expected:
            raise ChangeError(f"expected {expected} rows, found {found}")
    return rows.join(keys, list(on), "left_anti").select(*rows.columns)


def _require_count(rows: DataFrame, pred: Column, expected: int | None) -> None:
    if expected is not None:
        found = rows.where(pred).count()
        if found != expected:
            raise ChangeError(f"expected {expected} rows, found {found}")


def _answer_rows(graph: GraphSpec, ids=None) -> DataFrame:
    """Rows of the three answers as (incident_id, document_id, path); the path names the answer."""
    none = F.lit(None).cast("string").alias("document_id")
    return union_all([
        incident_impact(graph, ids).select("incident_id", none, F.lit("IMPACT").alias("path")),
        open_tasks(graph, ids).select("incident_id", none, F.lit("OPEN_TASK").alias("path")),
        related_documents(graph, ids).select("incident_id", "document_id", "path"),
    ])


def _sizes(rows: DataFrame, keys: Sequence[str], bulletin: str | None) -> DataFrame:
    path = F.col("path")
    paths = {
        "incident_paths": "DOCUMENTED_BY", "lot_paths": "AFFECTS>BELONGS_TO_LOT>GOVERNED_BY",
        "task_paths": "CREATES>USES_PROCEDURE",
    }
    return rows.groupBy(*keys).agg(
        count_where(path == "IMPACT").alias("equipment"),
        count_where(path == "OPEN_TASK").alias("tasks"),
        count_where(path.isin(*paths.values())).alias("paths"),
        F.count_distinct("document_id").alias("documents"),
        count_where(F.col("document_id") == F.lit(bulletin)).alias("bulletin_paths"),
        *[count_where(path == value).alias(name) for name, value in paths.items()],
    )


def answer_state(graph: GraphSpec, ids=None, bulletin: str | None = None) -> DataFrame:
    """Per incident: sizes of the three answers and of each kind of document path.

    ``bulletin`` counts the paths to one document. An incident without any row has no line.
    """
    return _sizes(_answer_rows(graph, ids), ["incident_id"], bulletin)


def what_if(cases: Mapping[str, GraphSpec], ids=None, bulletin: str | None = None) -> DataFrame:
    """``answer_state`` of several graphs, labelled by case, in one grouping."""
    rows = union_all(_answer_rows(g, ids).withColumn("case", F.lit(name)) for name, g in cases.items())
    return _sizes(rows, ["case", "incident_id"], bulletin)


def what_if_rows(graph: GraphSpec, tasks: DataFrame) -> DataFrame:
    """The answers of a graph as rows that cases can be counted on, each computed once.

    (incident_id, answer, n, path, document_id, relation_type, priority). Equipment
    is counted per lot and stage, not listed: ``n`` is the number of devices, 1
    for the other rows. ``priority`` is that of the row's task.
    """
    text = lambda name: F.lit(None).cast("string").alias(name)
    one = F.lit(1).cast("bigint").alias("n")
    impact = impact_by_stage(graph).select(
        "incident_id", F.lit("equipment").alias("answer"), F.col("related_equipment_count").cast("bigint").alias("n"),
        text("path"), text("document_id"), text("relation_type"), text("priority"),
    )
    open_rows = open_tasks(graph).select(
        "incident_id", F.lit("task").alias("answer"), one, text("path"), text("document_id"), text("relation_type"), "priority"
    )
    urgency = tasks.select(F.col("task_id").alias("_task"), F.col("priority"))
    documents = related_documents(graph).join(urgency, F.col("task_id") == F.col("_task"), "left").select(
        "incident_id", F.lit("document").alias("answer"), one, "path", "document_id", "relation_type", "priority"
    )
    return union_all([impact, open_rows, documents])


def count_cases(rows: DataFrame, cases: Mapping[str, Column], bulletin: Column) -> DataFrame:
    """Sizes of the answers per case and incident, from the rows that each case leaves.

    ``cases`` maps a name to a condition on the rows of ``what_if_rows``; NULL
    counts as true. All cases share one grouping. ``bulletin`` tells the paths to
    one document.
    """
    kept = F.array_compact(F.array(*[F.when(F.coalesce(left, F.lit(True)), F.lit(name)) for name, left in cases.items()]))
    is_path = F.col("answer") == "document"
    kinds = {"incident_paths": "DOCUMENTED_BY", "lot_paths": "AFFECTS>BELONGS_TO_LOT>GOVERNED_BY", "task_paths": "CREATES>USES_PROCEDURE"}
    total = lambda answer: F.coalesce(F.sum(F.when(F.col("answer") == answer, F.col("n"))), F.lit(0)).cast("bigint")
    return rows.withColumn("_bulletin", bulletin).withColumn("case", F.explode(kept)).groupBy("case", "incident_id").agg(
        total("equipment").alias("equipment"), total("task").alias("tasks"), count_where(is_path).alias("paths"),
        F.count_distinct("document_id").alias("documents"), count_where(is_path & F.col("_bulletin")).alias("bulletin_paths"),
        *[count_where(F.col("path") == value).alias(name) for name, value in kinds.items()],
    )


# --- snapshots ------------------------------------------------------------


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions of a snapshot table; an unfinished write has no success marker."""
    jvm = spark.sparkContext._jvm
    marks = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/version=*/_SUCCESS")
    fs = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(marks) or []
    return sorted(int(m.getPath().getParent().getName().split("=")[1]) for m in found)


def snapshot_exists(spark: SparkSession, root: str) -> bool:
    return bool(_versions(spark, root))


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Latest complete version, or the named one."""
    versions = _versions(spark, root)
    if not versions or (version is not None and version not in versions):
        raise ChangeError(f"no such snapshot below {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/version={version or versions[-1]:06d}")


def write_snapshot(df: DataFrame, root: str) -> int:
    """Write the next version and return its number; earlier versions stay readable.

    The data goes to a folder of its own. A writer then claims a number by
    making a file that must not exist yet, and renames its folder to it. Of two
    writers one finds the number taken and goes on to the next, so no version
    is lost or overwritten.
    """
    spark = df.sparkSession
    base = root.rstrip("/")
    draft = f"{base}/_draft-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(draft)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(draft).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    number = max(_versions(spark, root), default=0)
    while True:
        number += 1
        target = path(f"{base}/version={number:06d}")
        if not fs.exists(target) and fs.createNewFile(path(f"{base}/_claim-{number:06d}")):
            if not fs.rename(path(draft), target):
                raise ChangeError(f"could not publish {target.toString()}")
            return number


def create_if_absent(df: DataFrame, root: str) -> DataFrame:
    """Write ``df`` as the first version unless the table exists; return the table."""
    if not snapshot_exists(df.sparkSession, root):
        write_snapshot(df, root)
    return read_snapshot(df.sparkSession, root)
