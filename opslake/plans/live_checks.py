"""Key and endpoint checks of a graph kept up to date by its changes.

``graph.key_errors`` and ``graph.endpoint_errors`` read every element. Here the
multiplicity of every key, and of every pair of ends of every edge table, is
kept; a change adds and takes away multiplicities, and only what it touches can
turn from good to bad or back (the counting algorithm):

- a key is bad when it is NULL or its multiplicity is above 1;
- an edge is bad when one of its ends is missing. A change of the edges themselves
  touches their pairs; a vertex that comes or goes touches the pairs at it. Whether
  the ends of such a pair are there is looked up among the keys.

State lies in hashed buckets, pairs at both their ends, so all look-ups read only
the buckets of the keys looked for. A change adds a file of its own rows to the
buckets that it touches, and a bucket of ``MERGE`` files is written anew as one;
the files of older versions stay, and a version is a list of bucket files.
Elements go by their numbers, and a pair does not repeat the key it lies at.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.operators.sets import union_all
from opslake.plans.graph import GraphSpec
from opslake.sources.scratch import saved

BUCKETS = 64
MERGE = 8
TASKS = 32  # tasks that may write to one bucket
_NULL = "-"  # text of a NULL key; all others begin with "="
_KEYS = "element int, key string, n long, old long, new long, bucket int"
_ENDS = "edge int, at_source boolean, source string, target string, n long, bucket int"
_PAIR = ("edge", "source", "target")

# Kind, name and, of an edge, its two vertex tables.
Element = tuple[str, str, str | None, str | None]


def _text(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(_NULL))


def _bucket(buckets: int, element: str = "element") -> Column:
    """The hash by which Spark deals rows to tasks, so a bucket comes from few tasks."""
    return F.pmod(F.hash(element, "key"), F.lit(buckets)).cast("int").alias("bucket")


@dataclass(frozen=True)
class Delta:
    """``rows``: (element, key, source, target, change), of an edge with both ends. Keys are texts as in the state; an element goes by its place in ``elements``."""

    rows: DataFrame
    elements: tuple[Element, ...]


def _elements(graph: GraphSpec) -> tuple[Element, ...]:
    return (*(("VERTEX", v.name, None, None) for v in graph.vertices), *(("EDGE", e.name, e.source, e.target) for e in graph.edges))


def delta_of(graph: GraphSpec, inserted: Mapping[str, DataFrame] | None = None, deleted: Mapping[str, DataFrame] | None = None) -> Delta:
    """The change made by rows of elements, by element name; an updated row is one deleted and one inserted.

    Rows need the key, and for edges both ends.
    """
    rows, elements = [], _elements(graph)
    known = {e.name: (i, e) for i, e in enumerate((*graph.vertices, *graph.edges))}
    for sign, frames in ((1, inserted or {}), (-1, deleted or {})):
        for name, df in frames.items():
            i, e = known[name]
            ends = [_text(F.col(e.source_key)), _text(F.col(e.target_key))] if elements[i][0] == "EDGE" else [F.lit(None).cast("string")] * 2
            rows.append(df.select(
                F.lit(i).alias("element"), _text(F.col(e.key)).alias("key"), ends[0].alias("source"), ends[1].alias("target"),
                F.lit(sign).cast("long").alias("change"),
            ))
    if not rows:
        raise ValueError("a change without rows")
    return Delta(union_all(rows), elements)


def _refuse_negative(counts: DataFrame) -> None:
    if not counts.where("new < 0").isEmpty():
        raise ValueError("the change deletes rows that are not there")


def _bad_key(n: str) -> Column:
    return ((F.col("key") == _NULL) & (F.col(n) > 0)) | (F.col(n) > 1)


class LiveChecks:
    """Checks of one version of a graph, and the state from which the next follows."""

    def __init__(
        self, spark: SparkSession, folder: str, version: int, files: Mapping[str, Mapping[int, tuple[int, ...]]], buckets: int,
        elements: Sequence[Element],
    ):
        self._spark, self.folder, self.version, self._files, self.buckets, self.elements = spark, folder, version, files, buckets, tuple(elements)

    # --- reading

    @classmethod
    def open(cls, spark: SparkSession, folder: str, version: int) -> LiveChecks:
        """A version that ``start`` or ``apply`` has written."""
        rows = spark.read.parquet(f"{folder}/v{version}/files").collect()  # one row per file of a bucket and table
        files: dict[str, dict[int, tuple[int, ...]]] = {"keys": {}, "ends": {}}
        for r in sorted(rows, key=lambda r: r.version):
            if r.table in files:
                files[r.table][r.bucket] = (*files[r.table].get(r.bucket, ()), r.version)
        named = sorted(spark.read.parquet(f"{folder}/v{version}/elements").collect(), key=lambda r: r.element)
        return cls(spark, folder, version, files, next(r.buckets for r in rows), [(r.kind, r.name, r.source, r.target) for r in named])

    def _read(self, table: str, schema: str, wanted: set[int]) -> DataFrame:
        """Rows of the wanted buckets; no other file is opened. A key or pair has a row in each file that changed it."""
        at = self._files[table]
        paths = [f"{self.folder}/v{v}/{table}/bucket={b}" for b in sorted(wanted & set(at)) for v in at[b]]
        plain = schema.rsplit(",", 1)[0]
        return self._spark.read.schema(plain).parquet(*paths) if paths else self._spark.createDataFrame([], plain)

    def _table(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self.folder}/v{self.version}/{name}")

    def key_errors(self) -> DataFrame:
        """As ``graph.key_errors``."""
        return self._table("totals").where("check = 'key' and errors > 0").select(
            F.col("kind").alias("element_kind"), F.col("name").alias("element_name"), F.col("errors").alias("error_count")
        )

    def endpoint_errors(self) -> DataFrame:
        """As ``graph.endpoint_errors``."""
        return self._table("totals").where("check = 'ends' and errors > 0").select(F.col("name").alias("edge_name"), F.col("errors").alias("error_count"))

    # --- elements by number

    def _with(self, elements: Sequence[Element]) -> tuple[Element, ...]:
        """The elements of the state and behind them those that a change brings."""
        known = {e[:2]: e for e in self.elements}
        if any(known.get(e[:2], e) != e for e in elements):
            raise ValueError("an edge table joins other vertex tables than before")
        return (*self.elements, *(e for e in elements if e[:2] not in known))

    def _is(self, kind: str) -> Column:
        return F.col("element").isin([i for i, e in enumerate(self.elements) if e[0] == kind])

    def _tables(self, side: str) -> list[int]:
        """The number of the vertex table at the ``side`` of each edge table, by its number; -1 for a vertex table."""
        number = {e[:2]: i for i, e in enumerate(self.elements)}
        return [number["VERTEX", e[2 if side == "source" else 3]] if e[0] == "EDGE" else -1 for e in self.elements]

    def _end(self, side: str) -> Column:
        return F.array(*map(F.lit, self._tables(side)))[F.col("edge")]

    def _both_ends(self, pairs: DataFrame) -> DataFrame:
        """Each pair at its source and at its target."""
        return pairs.withColumn("at_source", F.explode(F.array(F.lit(True), F.lit(False))))

    def _at_key(self, ends: DataFrame) -> DataFrame:
        at = F.col("at_source")
        return ends.withColumns({
            "vertex": F.when(at, self._end("source")).otherwise(self._end("target")), "key": F.when(at, F.col("source")).otherwise(F.col("target")),
        })

    # --- writing

    def _places(self, rows: DataFrame, element: str) -> tuple[set[int], set[int]]:
        """Buckets and numbers of the elements of these keys; at most one row per bucket and element is fetched."""
        found = rows.select(_bucket(self.buckets, element), element).distinct().collect()
        return {r.bucket for r in found}, {r[element] for r in found}

    def _long(self, table: str) -> set[int]:
        """Buckets of so many files that a change writes them anew."""
        return {b for b, versions in self._files[table].items() if len(versions) >= MERGE}

    def _dealt(self, rows: DataFrame, element: str, key: str) -> DataFrame:
        """The rows as they are when a shuffle by element and key leaves a bucket to few tasks, else dealt to a multiple of the buckets."""
        conf = self._spark.conf
        n = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions"))
        return rows if n // gcd(n, self.buckets) <= TASKS else rows.repartition(-(-n // self.buckets) * self.buckets, element, key)

    def _write(self, table: str, rows: DataFrame, version: int, anew: set[int]) -> dict[int, tuple[int, ...]]:
        """Write the rows by bucket; returns where each bucket of the new version lies."""
        target = f"{self.folder}/v{version}/{table}"
        rows.write.mode("append").partitionBy("bucket").parquet(target)
        path = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        names = [f.getPath().getName() for f in path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]
        kept = {b: versions for b, versions in self._files[table].items() if b not in anew}
        return kept | {b: (*kept.get(b, ()), version) for b in (int(n.removeprefix("bucket=")) for n in names if n.startswith("bucket="))}

    @classmethod
    def start(cls, graph: GraphSpec, folder: str, buckets: int = BUCKETS) -> LiveChecks:
        """Read every element once and write version 0 below ``folder``."""
        frames = {e.name: e.df for e in (*graph.vertices, *graph.edges)}
        spark = next(iter(frames.values())).sparkSession
        empty = cls(spark, folder, -1, {"keys": {}, "ends": {}}, buckets, ())
        return empty._next(delta_of(graph, inserted=frames), first=True)

    def apply(self, delta: Delta) -> LiveChecks:
        """The checks after a change, as the next version. Deleting what is not there is an error."""
        return self._next(delta, first=False)

    def _next(self, delta: Delta, first: bool) -> LiveChecks:
        now = LiveChecks(self._spark, self.folder, self.version + 1, dict(self._files), self.buckets, self._with(delta.elements))
        here = f"{self.folder}/v{now.version}"
        rows = delta.rows
        if now.elements[: len(delta.elements)] != delta.elements:
            rows = rows.withColumn("element", F.array(*[F.lit(now.elements.index(e)) for e in delta.elements])[F.col("element")])
        rows = saved(rows, f"{here}/work/rows")

        keys = self._next_keys(now, rows, first)
        by_pair = rows.where(now._is("EDGE")).groupBy(F.col("element").alias("edge"), "source", "target")
        pairs = by_pair.agg(F.sum("change").alias("change")).where("change != 0")
        marked = self._first_ends(now, keys, pairs) if first else self._next_ends(now, keys, saved(pairs, f"{here}/work/pairs"), f"{here}/work")
        bad = lambda when: (F.col(f"{when}_source") | F.col(f"{when}_target")).cast("long")
        edge_change = marked.groupBy(F.col("edge").alias("element")).agg(F.sum(F.col("new") * bad("is") - F.col("old") * bad("was")).alias("errors"))
        key_change = keys.groupBy("element").agg(F.sum(_bad_key("new").cast("long") - _bad_key("old").cast("long")).alias("errors"))
        kind, name = (F.array(*[F.lit(e[i]) for e in now.elements])[F.col("element")].alias(c) for i, c in enumerate(("kind", "name")))
        parts = [x.select(F.lit(check).alias("check"), kind, name, "errors") for check, x in (("key", key_change), ("ends", edge_change))]
        if not first:
            parts.append(self._table("totals"))
        union_all(parts).groupBy("check", "kind", "name").agg(F.sum("errors").alias("errors")).write.parquet(f"{here}/totals")

        numbered = [(i, *e) for i, e in enumerate(now.elements)]
        self._spark.createDataFrame(numbered, "element int, kind string, name string, source string, target string").coalesce(1).write.parquet(f"{here}/elements")
        files = [(t, b, v, self.buckets) for t, at in now._files.items() for b, versions in at.items() for v in versions] + [("none", -1, now.version, self.buckets)]
        self._spark.createDataFrame(files, "table string, bucket int, version int, buckets int").coalesce(1).write.parquet(f"{here}/files")
        return now

    def _next_keys(self, now: LiveChecks, rows: DataFrame, first: bool) -> DataFrame:
        """Write what becomes of the touched keys; returns their multiplicities before and now."""
        touched, elements = (set(), set()) if first else self._places(rows, "element")
        anew = touched & self._long("keys")
        counts = rows.select("element", "key", F.lit(0).cast("long").alias("old"), F.col("change").alias("new"))
        if not first:
            held = self._read("keys", _KEYS, touched - anew).where(F.col("element").isin(elements)).union(self._read("keys", _KEYS, anew))
            counts = counts.union(held.select("element", "key", "n", "n"))
        old = F.lit(0).cast("long") if first else F.sum("old")
        counts = counts.groupBy("element", "key").agg(old.alias("old"), F.sum("new").alias("new"))
        counts = self._dealt(counts, "element", "key").select("*", _bucket(self.buckets))
        n = F.when(F.col("bucket").isin(anew), F.col("new")).otherwise(F.col("new") - F.col("old"))
        now._files["keys"] = self._write("keys", counts.withColumn("n", n).where("n != 0 or old != new"), now.version, anew)
        keys = self._spark.read.schema(_KEYS).parquet(f"{self.folder}/v{now.version}/keys")
        _refuse_negative(keys)
        return keys

    def _first_ends(self, now: LiveChecks, keys: DataFrame, pairs: DataFrame) -> DataFrame:
        """Write all pairs at both their ends; returns them marked.

        Looking up an end deals the pairs to tasks as the state lies, so each side is written where it was looked up.
        """
        there, zero = now._vertices(keys), F.lit(0).cast("long")
        pairs = pairs.select(*_PAIR, zero.alias("old"), F.col("change").alias("new"))
        written, schema = f"{self.folder}/v{now.version}/ends", "edge int, at_source boolean, source string, target string, n long, old long, new long"
        for side in ("source", "target"):
            pairs = now._looked_up(pairs, there, side)
            ends = now._at_key(pairs.select("*", F.lit(side == "source").alias("at_source"), F.col("new").alias("n")))
            at = self._write("ends", ends.select("*", _bucket(self.buckets, "vertex")).drop("vertex", "key"), now.version, set())
            schema += f", was_{side} boolean, is_{side} boolean"
            pairs = self._spark.read.schema(schema).parquet(written).where(F.col("at_source") == (side == "source")).drop("at_source", "n", "bucket")
        now._files["ends"] = at
        return pairs

    def _next_ends(self, now: LiveChecks, keys: DataFrame, pairs: DataFrame, work: str) -> DataFrame:
        """Write the change of the pairs at both their ends; returns the touched pairs marked."""
        touched = self._touched_pairs(now, keys, pairs, work)
        ends = now._at_key(now._both_ends(pairs.withColumnRenamed("change", "n")))
        anew = self._long("ends")
        anew = anew and anew & self._places(ends, "vertex")[0]
        if anew:
            ends = ends.unionByName(now._at_key(self._read("ends", _ENDS, anew)))
            ends = ends.groupBy(*[c for c in ends.columns if c != "n"]).agg(F.sum("n").alias("n")).where("n != 0")
        dealt = self._dealt(ends.repartition("vertex", "key"), "vertex", "key").select("edge", "at_source", "source", "target", "n", _bucket(self.buckets, "vertex"))
        now._files["ends"] = self._write("ends", dealt, now.version, anew)

        buckets, vertices = self._places(now._at_key(now._both_ends(touched)), "vertex")
        held = self._read("keys", _KEYS, buckets).where(F.col("element").isin(vertices)).select(F.col("element").alias("vertex"), "key", "n", "n")
        there = now._vertices(keys).select("vertex", "key", F.lit(0).cast("long").alias("old"), F.col("new") - F.col("old"))
        there = there.union(held).toDF("vertex", "key", "old", "new").groupBy("vertex", "key").agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
        there = saved(there, f"{work}/vertices")
        return now._looked_up(now._looked_up(touched, there, "source"), there, "target")

    def _touched_pairs(self, now: LiveChecks, keys: DataFrame, pairs: DataFrame, work: str) -> DataFrame:
        """(edge, source, target, old, new): the pairs that change and those beside a vertex that comes or goes."""
        zero = F.lit(0).cast("long")
        turned = now._vertices(keys).where((F.col("key") != _NULL) & ((F.col("old") > 0) != (F.col("new") > 0)))
        at = turned.select("vertex", "key", F.lit(True).alias("turned"))
        at = at.union(pairs.select(now._end("source"), "source", F.lit(False))).groupBy("vertex", "key").agg(F.max("turned").alias("turned"))
        at = saved(at, f"{work}/at")
        (buckets, vertices), (_, those) = (self._places(x, "vertex") for x in (at, at.where("turned")))
        from_, to = ([i for i, v in enumerate(now._tables(side)) if v in x] for side, x in (("source", vertices), ("target", those)))
        held = self._read("ends", _ENDS, buckets).where(F.when(F.col("at_source"), F.col("edge").isin(from_)).otherwise(F.col("edge").isin(to)))
        held = now._at_key(held).join(at.hint("shuffle_hash"), ["vertex", "key"])
        by_source, by_target = F.when(F.col("at_source"), F.col("n")).otherwise(zero), F.when(F.col("at_source"), zero).otherwise(F.col("n"))
        counts = held.select(*_PAIR, by_source.alias("by_source"), by_target.alias("by_target"), zero.alias("change"), "turned")
        counts = counts.union(pairs.select(*_PAIR, zero, zero, "change", F.lit(False))).groupBy(*_PAIR).agg(
            F.greatest(F.sum("by_source"), F.sum("by_target")).alias("old"), F.sum("change").alias("change"), F.max("turned").alias("turned")
        )
        counts = counts.where("turned or change != 0").select(*_PAIR, "old", (F.col("old") + F.col("change")).alias("new"))
        counts = saved(counts.where("old != 0 or new != 0"), f"{work}/touched")
        _refuse_negative(counts)
        return counts

    def _vertices(self, keys: DataFrame) -> DataFrame:
        return keys.where(self._is("VERTEX")).select(F.col("element").alias("vertex"), "key", "old", "new")

    def _looked_up(self, pairs: DataFrame, there: DataFrame, side: str) -> DataFrame:
        """The pairs with whether their end at the ``side`` was missing and whether it is now."""
        missing = lambda n: (F.col(side) == _NULL) | (F.coalesce(n, F.lit(0)) == 0)
        # One row per vertex on the side that is held in memory, a task's share of them.
        ends = there.select(F.col("vertex").alias("_vertex"), F.col("key").alias(side), F.col("old").alias("_old"), F.col("new").alias("_new"))
        joined = self._dealt(pairs.withColumn("_vertex", self._end(side)), "_vertex", side).join(ends.hint("shuffle_hash"), ["_vertex", side], "left")
        return joined.withColumns({f"was_{side}": missing("_old"), f"is_{side}": missing("_new")}).drop("_vertex", "_old", "_new")
