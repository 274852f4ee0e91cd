"""Property graph over DataFrames: element definitions, path patterns, checks.

A pattern is a chain of hops from a start vertex. Every hop is an equi join, so
Catalyst sees a plain join tree: filters reach the scans, unused columns are
dropped and join strategies are chosen by size.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.operators.aggregates import offending_keys
from opslake.operators.joins import dangling_counts, salted_join
from opslake.operators.sets import union_all


# Rows of an element: a DataFrame, or a function that makes it when first needed.
Rows = DataFrame | Callable[[], DataFrame]


class _Element:
    """Resolves the rows of an element once and checks that its columns exist."""

    @cached_property
    def df(self) -> DataFrame:
        df = self.rows() if callable(self.rows) else self.rows
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            raise ValueError(f"{self.name} lacks columns {missing}")
        return df


@dataclass(frozen=True)
class Vertex(_Element):
    """Vertex table: one row per key; ``properties`` are visible to patterns."""

    name: str
    label: str
    rows: Rows
    key: str
    properties: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.properties]


@dataclass(frozen=True)
class Edge(_Element):
    """Edge table from vertex table ``source`` to vertex table ``target``.

    ``hub`` marks an edge whose target may be shared by very many sources;
    walking back from such a target salts its hot keys.
    """

    name: str
    label: str
    rows: Rows
    source: str
    source_key: str
    target: str
    target_key: str
    key: str = "edge_id"
    properties: tuple[str, ...] = ()
    hub: bool = False

    @property
    def columns(self) -> list[str]:
        return [self.key, self.source_key, self.target_key, *self.properties]


@dataclass(frozen=True)
class GraphSpec:
    vertices: tuple[Vertex, ...]
    edges: tuple[Edge, ...]

    def __post_init__(self):
        known = {v.name for v in self.vertices}
        for e in self.edges:
            if e.source not in known or e.target not in known:
                raise ValueError(f"edge {e.name} names an unknown vertex table")

    def vertex(self, label: str) -> Vertex:
        return _one([v for v in self.vertices if v.label == label], "vertex", label)

    def edge(self, label: str) -> Edge:
        return _one([e for e in self.edges if e.label == label], "edge", label)

    def by_name(self, name: str) -> Vertex:
        return _one([v for v in self.vertices if v.name == name], "vertex table", name)

    def counts(self) -> tuple[int, int]:
        """Number of vertex and edge definitions."""
        return len(self.vertices), len(self.edges)

    def replacing(self, **frames: DataFrame) -> GraphSpec:
        """The same graph with some element tables exchanged, by element name."""
        def exchanged(elements):
            return tuple(replace(e, rows=frames[e.name]) if e.name in frames else e for e in elements)

        return GraphSpec(exchanged(self.vertices), exchanged(self.edges))

    def without_properties(self) -> GraphSpec:
        """The same graph for questions on keys and ends alone."""
        return GraphSpec(*(tuple(replace(e, properties=()) for e in elements) for elements in (self.vertices, self.edges)))

    def saved(self, spark: SparkSession, path: str, names: Sequence[str] | None = None) -> GraphSpec:
        """Write elements once below ``path`` and read them back.

        Use it before many questions on one graph; the views behind the
        elements are then not computed again for each question. ``names`` limits
        it to the elements that the questions use.
        """
        frames = {}
        for element in (*self.vertices, *self.edges):
            if names is None or element.name in names:
                target = f"{path.rstrip('/')}/{element.name}"
                element.df.write.mode("errorifexists").parquet(target)
                frames[element.name] = spark.read.schema(element.df.schema).parquet(target)
        return self.replacing(**frames)


@dataclass(frozen=True)
class Hop:
    """One step of a pattern: along ``edge`` to a vertex; ``back`` walks against its direction."""

    edge_var: str
    edge: str
    vertex_var: str
    vertex: str
    back: bool = False


@dataclass(frozen=True)
class Pattern:
    """``start`` is (variable, label). ``where`` gives vertex conditions by variable.

    ``distinct_pairs`` lists pairs of vertex variables whose keys must differ.
    A condition or pair is applied as soon as its variables are bound.
    """

    start: tuple[str, str]
    hops: tuple[Hop, ...] = ()
    where: Mapping[str, Callable[[Callable[[str], Column]], Column]] = field(default_factory=dict)
    distinct_pairs: tuple[tuple[str, str], ...] = ()


def prop(variable: str, name: str) -> Column:
    """Property of a bound pattern variable."""
    return F.col(f"{variable}__{name}")


def element_id(element: Vertex | Edge, variable: str) -> Column:
    """Identity of a bound element: its table and its key."""
    return F.struct(F.lit(element.name).alias("element"), prop(variable, element.key).cast("string").alias("key"))


def match(
    graph: GraphSpec,
    pattern: Pattern,
    columns: Callable[[Callable[[str, str], Column]], Mapping[str, Column]],
    ids: DataFrame | Sequence | None = None,
    trusted: bool = True,
) -> DataFrame:
    """All matches of a pattern, one row per match; nodes may repeat.

    ``columns`` receives ``prop`` and returns the output columns by name.
    ``ids`` restricts the start vertex: a few literal keys or a DataFrame whose
    first column holds keys.

    With ``trusted`` the edges are taken to end in existing vertices with unique
    keys (``endpoint_errors`` and ``key_errors`` check that). A vertex of which
    only the key is used is then not joined at all.
    """
    used: set[str] = set()

    def noting(variable: str, name: str) -> Column:
        used.add(f"{variable}__{name}")
        return prop(variable, name)

    out_columns = columns(noting)
    conditions = {v: cond(lambda name, v=v: noting(v, name)) for v, cond in pattern.where.items()}

    def vertex_rows(variable: str, label: str) -> DataFrame:
        v = graph.vertex(label)
        names = dict.fromkeys([v.key, *v.properties])
        return v.df.select(*[F.col(c).alias(f"{variable}__{c}") for c in names])

    def edge_rows(variable: str, e: Edge) -> DataFrame:
        names = dict.fromkeys([e.key, *e.properties])
        return e.df.select(
            F.col(e.source_key).alias(f"{variable}__src"),
            F.col(e.target_key).alias(f"{variable}__dst"),
            *[F.col(c).alias(f"{variable}__{c}") for c in names],
        )

    def needs_join(variable: str, label: str) -> bool:
        key = f"{variable}__{graph.vertex(label).key}"
        mine = {c for c in used if c.startswith(f"{variable}__")}
        return not trusted or bool(mine - {key})

    pairs = list(pattern.distinct_pairs)
    labels = {pattern.start[0]: pattern.start[1]}

    def bound(df: DataFrame, variable: str) -> DataFrame:
        """Apply what can be decided once ``variable`` is bound."""
        if variable in conditions:
            df = df.where(conditions[variable])
        for pair in list(pairs):
            if all(v in labels for v in pair):
                a, b = (prop(v, graph.vertex(labels[v]).key) for v in pair)
                df = df.where(a != b)
                pairs.remove(pair)
        return df

    var, label = pattern.start
    key = f"{var}__{graph.vertex(label).key}"

    def restrict(df: DataFrame, column: str) -> DataFrame:
        if ids is None:
            return df
        if isinstance(ids, DataFrame):
            wanted = ids.select(F.col(ids.columns[0]).alias("_wanted")).distinct()
            return df.join(wanted, F.col(column) == F.col("_wanted"), "left_semi")
        return df.where(F.col(column).isin(*ids))

    rows: DataFrame | None = None
    if needs_join(var, label) or not pattern.hops:
        rows = bound(restrict(vertex_rows(var, label), key), var)

    for hop in pattern.hops:
        e = graph.edge(hop.edge)
        here, there = ("dst", "src") if hop.back else ("src", "dst")
        step = edge_rows(hop.edge_var, e)
        near, far = f"{hop.edge_var}__{here}", f"{hop.edge_var}__{there}"
        at = f"{var}__{graph.vertex(labels[var]).key}"
        if rows is None:
            rows = bound(restrict(step, near).withColumn(at, F.col(near)), var)
        elif hop.back and e.hub:
            rows = salted_join(rows, step, at, near)
        else:
            rows = rows.join(step, F.col(at) == F.col(near))
        var = hop.vertex_var
        labels[var] = hop.vertex
        there_key = f"{var}__{graph.vertex(hop.vertex).key}"
        if needs_join(var, hop.vertex):
            rows = rows.join(vertex_rows(var, hop.vertex), F.col(far) == F.col(there_key))
        else:
            rows = rows.withColumn(there_key, F.col(far))
        rows = bound(rows, var)

    return rows.select(*[c.alias(n) for n, c in out_columns.items()])


def key_errors(graph: GraphSpec) -> DataFrame:
    """(element_kind, element_name, error_count): NULL or repeated keys, only where found.

    All elements share one grouping over (element, key) instead of one each.
    An element goes by its number, so that what a task holds per key is short.
    """
    elements = [(kind, e) for kind, es in (("VERTEX", graph.vertices), ("EDGE", graph.edges)) for e in es]
    parts = [e.df.select(F.lit(i).alias("_element"), F.col(e.key).cast("string").alias("_key")) for i, (_, e) in enumerate(elements)]
    counted = union_all(parts).groupBy("_element", "_key").agg(F.count(F.lit(1)).alias("_n"))
    bad = counted.where(F.col("_key").isNull() | (F.col("_n") > 1)).groupBy("_element").agg(F.count(F.lit(1)).alias("error_count"))
    names = [F.struct(F.lit(kind).alias("kind"), F.lit(e.name).alias("name")) for kind, e in elements]
    of = F.array(*names)[F.col("_element")]
    return bad.select(of["kind"].alias("element_kind"), of["name"].alias("element_name"), "error_count")


def endpoint_errors(graph: GraphSpec) -> DataFrame:
    """(edge_name, error_count): edges whose source or target vertex is absent, only where found."""
    references = [
        (e.name, e.df.select(e.source_key, e.target_key), ((e.source_key, e.source), (e.target_key, e.target))) for e in graph.edges
    ]
    used = {name for e in graph.edges for name in (e.source, e.target)}
    keys = {v.name: v.df.select(v.key) for v in graph.vertices if v.name in used}
    return dangling_counts(references, keys).withColumnRenamed("name", "edge_name")


def element_sizes(graph: GraphSpec) -> DataFrame:
    """(element_kind, element_name, rows)."""
    return union_all(
        e.df.agg(F.lit(kind).alias("element_kind"), F.lit(e.name).alias("element_name"), F.count(F.lit(1)).alias("rows"))
        for kind, elements in (("VERTEX", graph.vertices), ("EDGE", graph.edges))
        for e in elements
    )


def _one(found: list, kind: str, name: str):
    if len(found) != 1:
        raise ValueError(f"{kind} {name!r}: {len(found)} definitions")
    return found[0]


def offending(graph: GraphSpec, name: str) -> DataFrame:
    """The offending keys of one element, for a closer look."""
    element = _one([e for e in (*graph.vertices, *graph.edges) if e.name == name], "element", name)
    return offending_keys(element.df, [element.key])
