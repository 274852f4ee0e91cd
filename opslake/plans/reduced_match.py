"""Pattern matches after a full reduction: rows that miss the answer are dropped before the joins.

A pattern is a chain, so its join tree is a path. Two passes of semi-joins
reduce every edge table to the edges of at least one match: forward, an edge
stays if its near end is reached from the start and its far end meets the
condition of its vertex; backward, if the pattern goes on from its far end. The
joins that follow then never make a row that a later hop would drop, so their
intermediate results are no larger than the answer, and what they shuffle is
bounded by input plus answer. A semi-join looks at distinct keys only, so a hub
costs one row; Spark broadcasts or Bloom-filters short key lists by itself.

It pays when conditions at the far end are selective; ``graph.match`` is one
pass less where they are not. Pairs of variables that must differ do not follow
the tree: they are conditions on the answer, as in ``match``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.plans.graph import GraphSpec, Hop, Pattern, match
from opslake.sources.scratch import saved, shared_dir


@dataclass(frozen=True)
class Reduced:
    """A graph with an edge table for each hop and a vertex table for each variable, and the pattern over it."""

    graph: GraphSpec
    pattern: Pattern


def _semi(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    wanted = keys.select(F.col(keys.columns[0]).alias("_wanted"))
    return rows.join(wanted, F.col(column) == F.col("_wanted"), "left_semi")


def reduce_graph(graph: GraphSpec, pattern: Pattern, ids: DataFrame | Sequence | None = None, trusted: bool = True, folder: str | None = None) -> Reduced:
    """The edges and vertices of at least one match of the pattern's hops and conditions, each written once to ``folder``."""
    start, first = pattern.start
    variables = [start, *(h.vertex_var for h in pattern.hops)]
    labels = [first, *(h.vertex for h in pattern.hops)]
    if len(set(variables)) < len(variables):
        raise ValueError("a chain binds each variable once")
    folder = folder or shared_dir(graph.vertex(first).df.sparkSession)

    def good(k: int) -> DataFrame | None:
        """Keys of the vertices that a variable may take; None if any."""
        v = graph.vertex(labels[k])
        condition = pattern.where.get(variables[k])
        rows = None
        if condition is not None or not trusted:
            rows = v.df if condition is None else v.df.where(condition(F.col))
            rows = rows.select(v.key)
        if k == 0 and ids is not None:
            if rows is None:
                rows = v.df.select(v.key)
            if isinstance(ids, DataFrame):
                return _semi(rows, v.key, ids.select(ids.columns[0]))
            return rows.where(F.col(v.key).isin(*ids))
        return rows

    near, far, steps = [], [], []
    reach = good(0)
    for k, hop in enumerate(pattern.hops):
        e = graph.edge(hop.edge)
        a, b = (e.target_key, e.source_key) if hop.back else (e.source_key, e.target_key)
        rows = e.df if reach is None else _semi(e.df, a, reach)
        allowed = good(k + 1)
        if allowed is not None:
            rows = _semi(rows, b, allowed)
        rows = saved(rows, f"{folder}/forward-{k}") if reach is not None or allowed is not None else rows
        near.append(a), far.append(b), steps.append(rows)
        reach = rows.select(b).distinct()
    for k in reversed(range(len(steps) - 1)):
        steps[k] = saved(_semi(steps[k], far[k], steps[k + 1].select(near[k + 1]).distinct()), f"{folder}/backward-{k}")

    vertices, edges, hops = [], [], []
    for k, (variable, label) in enumerate(zip(variables, labels)):
        v = graph.vertex(label)
        rows = v.df
        if steps:
            rows = _semi(rows, v.key, (steps[0].select(near[0]) if k == 0 else steps[k - 1].select(far[k - 1])).distinct())
        vertices.append(replace(v, name=f"{v.name}.{variable}", label=f"{label}.{variable}", rows=rows))
    for k, hop in enumerate(pattern.hops):
        e = graph.edge(hop.edge)
        ends = [f"{graph.vertex(labels[j]).name}.{variables[j]}" for j in ((k + 1, k) if hop.back else (k, k + 1))]
        edges.append(replace(e, name=f"{e.name}.{hop.edge_var}", label=f"{hop.edge}.{hop.edge_var}", rows=steps[k], source=ends[0], target=ends[1]))
        hops.append(Hop(hop.edge_var, f"{hop.edge}.{hop.edge_var}", hop.vertex_var, f"{hop.vertex}.{hop.vertex_var}", hop.back))
    # Conditions have been met by the keys; they stay, for vertices that are joined anyway.
    return Reduced(GraphSpec(tuple(vertices), tuple(edges)), replace(pattern, start=(start, f"{first}.{start}"), hops=tuple(hops)))


def match_reduced(
    graph: GraphSpec,
    pattern: Pattern,
    columns: Callable[[Callable[[str, str], Column]], Mapping[str, Column]],
    ids: DataFrame | Sequence | None = None,
    trusted: bool = True,
    folder: str | None = None,
) -> DataFrame:
    """The bag of ``graph.match``, from a graph that is reduced first."""
    r = reduce_graph(graph, pattern, ids, trusted, folder)
    return match(r.graph, r.pattern, columns, ids if not pattern.hops else None, trusted)
