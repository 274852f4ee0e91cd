"""Impact answers in factors: incidents meet lots, lots hold equipment, pairs are not listed.

The impact question pairs every device that an incident hit with every other
device of its manufacturing lot. The list grows with the square of a lot. Its
factors do not: one row for each (incident, device hit) with the number of its
peers, and one row for each device of a lot that was hit, with its place in the
lot. Sizes, single pairs by number, pages of JSON and the full list are all made
from these two tables.

Order. Devices of a lot stand by stage, then by id, and that is their place,
from 0. The pairs of an incident stand by device hit, then by place; the device
that was hit has no pair with itself, so later places move up by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslake.functions.text import edge_id, json_object
from opslake.operators.aggregates import json_pages
from opslake.operators.joins import salted_join
from opslake.operators.ranking import numbered
from opslake.plans import api, kg
from opslake.plans.graph import GraphSpec, Hop, Pattern, element_id, match
from opslake.sources.scratch import saved, shared_dir

PROVENANCE = ("lot_source", "lot_assertion_status", "lot_source_reference_id")
MEMBER_COLUMNS = ("related_equipment_id", "related_stage_id", "related_stage_name", *PROVENANCE)

_PLACED = Pattern(
    ("l", "MANUFACTURING_LOT"),
    (Hop("b2", "BELONGS_TO_LOT", "e2", "EQUIPMENT", back=True), Hop("d", "DEPLOYED_AT", "s", "STAGE")),
)


@dataclass(frozen=True)
class Factors:
    """``hits``: (incident_id, affected_equipment_id, manufacturing_lot, affected provenance, own_place, peers), peers above 0.

    own_place is the place of the device hit in its lot, NULL if it has none.
    ``members``: (manufacturing_lot, place, MEMBER_COLUMNS) of the lots that were hit.
    """

    hits: DataFrame
    members: DataFrame


def factorise(graph: GraphSpec, ids=None, folder: str | None = None) -> Factors:
    """Both factors, written once to ``folder``; as many rows as there are hits and devices of the lots hit."""
    folder = folder or shared_dir(next(iter(graph.vertices)).df.sparkSession)
    hit = match(graph, Pattern(kg.IMPACT.start, kg.IMPACT.hops[:2]), lambda p: {
        "incident_id": p("i", "incident_id"),
        "affected_equipment_id": p("e1", "equipment_id"),
        "manufacturing_lot": p("l", "manufacturing_lot"),
        **{f"affected_{c}": p("b1", c) for c in PROVENANCE},
    }, ids)
    hit = saved(hit, f"{folder}/hit")
    lots = hit.select(F.col("manufacturing_lot").alias("_lot")).distinct()
    placed = match(graph, _PLACED, lambda p: {
        "manufacturing_lot": p("l", "manufacturing_lot"),
        "related_equipment_id": p("e2", "equipment_id"),
        "related_stage_id": p("s", "stage_id"),
        "related_stage_name": p("s", "stage_name"),
        **{c: p("b2", c) for c in PROVENANCE},
    })
    placed = placed.join(lots, F.col("manufacturing_lot") == F.col("_lot"), "left_semi")
    order = [F.col("related_stage_id"), F.col("related_equipment_id")]
    members = saved(numbered(placed, "manufacturing_lot", order, "place", f"{folder}/dealt"), f"{folder}/members")
    sizes = members.groupBy("manufacturing_lot").agg(F.count(F.lit(1)).alias("_size"))
    own = members.select("manufacturing_lot", F.col("related_equipment_id").alias("affected_equipment_id"), F.col("place").alias("own_place"))
    peers = F.col("_size") - F.col("own_place").isNotNull().cast("bigint")
    hits = hit.join(sizes, "manufacturing_lot").join(own, ["manufacturing_lot", "affected_equipment_id"], "left")
    return Factors(saved(hits.withColumn("peers", peers).drop("_size").where("peers > 0"), f"{folder}/hits"), members)


def peer_counts(f: Factors) -> DataFrame:
    """(incident_id, affected_equipment_id, manufacturing_lot, related_equipment_count)."""
    return f.hits.select("incident_id", "affected_equipment_id", "manufacturing_lot", F.col("peers").alias("related_equipment_count"))


def _impact_columns() -> list[str]:
    return list(api.IMPACT_MEMBERS)


def expand(f: Factors) -> DataFrame:
    """Every pair, with the columns of ``kg.incident_impact``; hot lots are salted."""
    members = f.members.withColumnRenamed("manufacturing_lot", "_lot")
    pairs = salted_join(f.hits, members, "manufacturing_lot", "_lot")
    return pairs.where("related_equipment_id != affected_equipment_id").select(*_impact_columns())


def expand_elements(f: Factors, graph: GraphSpec) -> DataFrame:
    """Every pair as the identities of the nine elements of its path, with the columns of ``kg.impact_elements``."""
    of = {v.label: v for v in graph.vertices} | {e.label: e for e in graph.edges}
    rows = expand(f).select(
        F.col("incident_id").alias("i__incident_id"), F.col("affected_equipment_id").alias("e1__equipment_id"),
        F.col("manufacturing_lot").alias("l__manufacturing_lot"), F.col("related_equipment_id").alias("e2__equipment_id"),
        F.col("related_stage_id").alias("s__stage_id"),
    )
    ends = {
        "a": ("i__incident_id", "AFFECTS", "e1__equipment_id"), "b1": ("e1__equipment_id", "LOT", "l__manufacturing_lot"),
        "b2": ("e2__equipment_id", "LOT", "l__manufacturing_lot"), "d": ("e2__equipment_id", "STAGE", "s__stage_id"),
    }
    rows = rows.withColumns({f"{v}__edge_id": edge_id(F.col(a), label, F.col(b)) for v, (a, label, b) in ends.items()})
    names = {
        "incident_vertex": ("INCIDENT", "i"), "affects_edge": ("AFFECTS", "a"), "affected_equipment_vertex": ("EQUIPMENT", "e1"),
        "affected_lot_edge": ("BELONGS_TO_LOT", "b1"), "lot_vertex": ("MANUFACTURING_LOT", "l"), "related_lot_edge": ("BELONGS_TO_LOT", "b2"),
        "related_equipment_vertex": ("EQUIPMENT", "e2"), "deployed_at_edge": ("DEPLOYED_AT", "d"), "stage_vertex": ("STAGE", "s"),
    }
    return rows.select(*[element_id(of[label], v).alias(n) for n, (label, v) in names.items()])


def _starts(f: Factors) -> DataFrame:
    """``hits`` with the number of the first pair of each within its incident, ``start``."""
    order = Window.partitionBy("incident_id").orderBy("affected_equipment_id", "manufacturing_lot")
    before = F.sum("peers").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return f.hits.withColumn("start", F.coalesce(before, F.lit(0)))


def pairs_at(f: Factors, wanted: DataFrame) -> DataFrame:
    """The pairs with the numbers (incident_id, position) of ``wanted``, from 0, and their columns.

    A number at or above the incident's pairs gives no row. Work: the hits of
    the incidents asked for and one look-up per number.
    """
    asked = wanted.select(F.col("incident_id").alias("_incident"), F.col("position").cast("bigint").alias("position"))
    found = _starts(f).join(asked, (F.col("incident_id") == F.col("_incident")) & (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("peers")))
    at = F.col("position") - F.col("start")
    found = found.withColumn("_place", at + F.coalesce((F.col("own_place") <= at).cast("bigint"), F.lit(0)))
    members = f.members.withColumnRenamed("manufacturing_lot", "_lot")
    return found.join(members, (F.col("manufacturing_lot") == F.col("_lot")) & (F.col("_place") == F.col("place"))).select("position", *_impact_columns())


def spread_positions(f: Factors) -> DataFrame:
    """(incident_id, position): the first, middle and last pair of every incident."""
    n = f.hits.groupBy("incident_id").agg(F.sum("peers").alias("_n"))
    last = F.col("_n") - 1
    return n.select("incident_id", F.explode(F.array_distinct(F.array(F.lit(0).cast("bigint"), F.floor(last / 2), last))).alias("position"))


def impact_pages(f: Factors, page_rows: int = 1000, folder: str | None = None) -> DataFrame:
    """(incident_id, page_no, members, json): the pages of ``api.impact_json``, without a table of pairs.

    A lot is cut into runs of ``page_rows`` devices, each with the first device
    of the next run, and a page is a run with the device hit left out: one join
    row per page. Incidents with several hits have their pairs merged by stage;
    those, and only those, are listed and paged.
    """
    several = f.hits.groupBy("incident_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("incident_id").alias("_several"))
    single = f.hits.join(several, F.col("incident_id") == F.col("_several"), "left_anti")
    listed = expand(Factors(f.hits.join(several, F.col("incident_id") == F.col("_several"), "left_semi"), f.members))
    order = [F.col("related_stage_id"), F.col("related_equipment_id")]
    merged = json_pages(listed, "incident_id", order, api._members(api.IMPACT_MEMBERS), page_rows, folder)

    run = F.floor(F.col("place") / page_rows)
    opens = (F.col("place") % page_rows == 0) & (F.col("place") > 0)
    runs = F.when(opens, F.array(run - 1, run)).otherwise(F.array(run))
    held = F.struct("place", *MEMBER_COLUMNS)
    cut = f.members.select(F.col("manufacturing_lot").alias("_lot"), held.alias("_m"), F.explode(runs).alias("_run"))
    cut = cut.groupBy("_lot", "_run").agg(F.array_sort(F.collect_list("_m")).alias("_devices"))

    pages = single.withColumn("page_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("peers") / page_rows) - 1)))
    met = pages.join(cut, (F.col("manufacturing_lot") == F.col("_lot")) & (F.col("page_no") == F.col("_run")))
    others = F.filter("_devices", lambda m: ~m["place"].eqNullSafe(F.col("own_place")))
    first = F.when(F.col("own_place") < F.col("page_no") * page_rows, 2).otherwise(1)
    met = met.withColumn("_page", F.slice(others, first, F.lit(page_rows)))

    def member(m):
        return json_object([(m[c] if c in MEMBER_COLUMNS else F.col(c)).alias(c) for c in api.IMPACT_MEMBERS])

    single_pages = met.select(
        "incident_id", "page_no", F.size("_page").cast("bigint").alias("members"),
        F.concat(F.lit("["), F.array_join(F.transform("_page", member), ","), F.lit("]")).alias("json"),
    )
    return single_pages.unionByName(merged)
