"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level every child draws ``-ln(u) / weight`` with u from a hash of the
key and the child's name; the smallest draw wins (a weighted rendezvous). A
child whose weight grows can only win keys, one whose weight shrinks can only
lose them, and draws of other nodes stay as they are. So a change of weights
moves keys only between the subtrees whose weights change.

All work is built-in expressions; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_CHUNK = 50_000


@dataclass(frozen=True)
class Node:
    """A node of the tree. Names are unique among siblings; a leaf has a shard number."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None


def layout(shards: int, base: int = 24, racks: int = 3, per_rack: int = 4) -> tuple[Node, ...]:
    """Regions for ``shards`` equal shards.

    The first ``base`` shards fill regions of ``racks`` x ``per_rack``. Each
    later shard opens a region of its own of weight 1, so that it takes rows
    only into itself, and as many from every older shard.
    """
    per_region, regions = racks * per_rack, []
    first = min(shards, base)
    for region in range(0, first, per_region):
        inner = []
        for rack in range(region, min(first, region + per_region), per_rack):
            leaves = tuple(Node(str(s), 1.0, shard=s) for s in range(rack, min(first, rack + per_rack, region + per_region)))
            inner.append(Node(f"{region}/{rack}", float(len(leaves)), leaves))
        regions.append(Node(str(region), sum(r.weight for r in inner), tuple(inner)))
    for s in range(first, shards):
        regions.append(Node(f"new-{s}", 1.0, (Node("rack", 1.0, (Node(str(s), 1.0, shard=s),)),)))
    return tuple(regions)


def _draw(key: Sequence[Column], level: int, parent: Column, child: Column, weight: Column) -> Column:
    """-ln(u) / weight; u is 53 bits of a hash of level, parent, child and key."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(level), parent, child, *key), 11)
    return -F.log((h.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))) / weight


def place(key: Sequence[Column], regions: Sequence[Node]) -> Column:
    """The shard of a key (int). A NULL key part hashes as NULL and is placed like any other."""

    def descend(nodes: Sequence[Node], level: int, parent: str) -> Column:
        alive = [n for n in nodes if n.weight > 0]
        if len(alive) == 1:
            best = None
        else:
            draws = [
                F.struct(_draw(key, level, F.lit(parent), F.lit(n.name), F.lit(n.weight)).alias("draw"), F.lit(i).alias("child"))
                for i, n in enumerate(alive)
            ]
            best = F.least(*draws)["child"]
        below = [F.lit(n.shard) if n.shard is not None else descend(n.children, level + 1, f"{parent}/{n.name}") for n in alive]
        if best is None:
            return below[0]
        return F.element_at(F.array(*below), best + 1) if all(n.shard is not None for n in alive) else _choose(best, below)

    return descend(regions, 0, "").cast("int")


def _choose(index: Column, options: Sequence[Column]) -> Column:
    """The option at an index; only that branch is computed."""
    out = F.when(index == 0, options[0])
    for i, option in enumerate(options[1:], 1):
        out = out.when(index == i, option)
    return out


def slots(rows: DataFrame, group: str, order: Sequence[str], chunks: int) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, 2, ... within each group without gaps, in no promised order.

    Rows of a group are dealt to ``chunks`` chunks by a hash of ``order``,
    numbered inside a chunk and shifted by the rows of the chunks before it. No
    task sorts a whole group.
    """
    from pyspark.sql import Window

    dealt = rows.withColumn("__chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    sizes = dealt.groupBy(group, "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "__chunk", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(group, "__chunk").orderBy(*order)
    return (
        dealt.withColumn("__row", F.row_number().over(inside))
        .join(starts, [group, "__chunk"])
        .withColumn("slot", (F.col("__start") + F.col("__row") - 1).cast("long"))
        .drop("__chunk", "__n", "__row", "__start")
    )


def shard_documents(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard), one row per row of ``docs``.

    doc_id and the shard count alone decide the shard; grown_shard is the one
    with one shard more and differs from shard only where it is that new shard.
    size: UTF-8 bytes of the text (NULL: none) plus 8. text_crc32 of a NULL text
    is that of the empty text. Rows that repeat an id get one shard and a slot
    each; NULL ids share one shard. An empty table gives no row; other columns
    do not matter. ``rows_per_chunk`` sizes the pieces in which slots are
    numbered, by the number of rows of the table.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = [F.col(id_col).cast("long")]
    placed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        place(key, layout(shards)).alias("shard"),
        place(key, layout(shards + 1)).alias("grown_shard"),
    )
    chunks = max(1, -(-docs.select(id_col).count() // (rows_per_chunk * shards)))
    return slots(placed, "shard", ["doc_id", "text_crc32", "size"], chunks).select(
        "doc_id", "size", "text_crc32", "shard", "slot", "grown_shard"
    )
