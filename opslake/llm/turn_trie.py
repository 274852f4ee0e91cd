"""Prefix trie of conversations by a van Emde Boas recursion over depth.

Every conversation is a sequence of turns. The depths 0 .. 2^K - 1 are one
block; a block of 2^(j+1) depths is cut at its half: the depths before the cut
are the upper trie, and each distinct prefix up to the cut is the root of a
lower trie. Upper and lower tries are blocks of 2^j depths and are cut in the
same way, all blocks of a size in one round. After K rounds every depth has
been a cut, and every prefix has a name.

Names. A prefix is named by the smallest conversation that starts with it, and
its depth. In a round, conversations in the same block have the name of its
root in common; they have the prefix up to the cut in common when the turns
between root and cut are equal. Those are an aligned run of 2^j turns, whose
digest is made from the digests of its two halves, so a round reads one digest
for each conversation and block.

Totals. Sums over subtrees start as the node's own and are grafted upward,
smallest blocks first: the total of the root of each lower trie is added to its
ancestors in the upper trie, which stand on the path of the conversation that
names it. That is at most one row per turn and round.

Data moved is in proportion to turns times log2 of the longest conversation.
No conversation, prefix or group of equal conversations is ever gathered: turns
are numbered by ranges of (conversation, turn), names and sums are combined
before shuffles, and the ids below a digest are packed in ranges and hashed as
a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.sources.scratch import saved, shared_dir

PACK = 4096  # ids that are joined to one text before hashing
_SHARED, _CYCLE = 4, 20


def _sha(c: Column) -> Column:
    return F.unhex(F.sha2(c, 256))


def number_turns(conversations: DataFrame, folder: str) -> DataFrame:
    """(conv, pos, symbol, words): turns from 1 in the order of (turn, role, text), NULL turns first.

    A NULL role or text is empty; rows with a NULL conv_id belong to no
    conversation. ``symbol`` is the SHA-256 of role and text, ``words`` the
    words of the text. Sorted ranges are numbered by themselves and shifted by
    the counts of the ranges before, so one conversation may have most rows.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role, text)
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    sizes = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv",
        F.monotonically_increasing_id().alias("at"),
        _sha(sizes).alias("symbol"),
        F.expr(r"regexp_count(text, '[^\\x20\\x09-\\x0D]+')").cast("long").alias("words"),
    )
    placed = saved(placed, f"{folder}/placed").withColumn("part", F.shiftright("at", 33))
    runs = placed.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.expr("coalesce(sum(n) over (partition by conv order by part rows between unbounded preceding and 1 preceding), 0)")
    return placed.join(runs.withColumn("before", before), ["conv", "part"]).select(
        "conv", (F.col("at") - F.col("first") + F.col("before") + 1).alias("pos"), "symbol", "words"
    )


def rebuild(turns: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """(conv, size) and (conv, depth, symbol, words) of the rebuilt conversations, depth from 1.

    Conversation c begins with the first h turns of conversation c - c % 20 (as
    many as it has, none where it does not exist), h = crc32(decimal c) % 4;
    its own turns after its first h follow. The remainder of a negative id is
    negative, so its first conversation is the next multiple towards zero.
    """
    own = saved(turns.groupBy("conv").agg(F.max("pos").alias("own")), f"{folder}/own")
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(_SHARED).cast("long"))
    asked = own.select("conv", "own", h.alias("h"), (F.col("conv") - F.col("conv") % _CYCLE).alias("donor"))
    given = own.select(F.col("conv").alias("donor"), F.col("own").alias("there"))
    head = F.least("h", F.coalesce("there", F.lit(0).cast("long")))
    convs = asked.join(given, "donor", "left").withColumn("head", head)
    convs = saved(convs.withColumn("size", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), f"{folder}/convs")
    starts = turns.where(F.col("pos") < _SHARED).withColumnRenamed("conv", "donor")
    heads = starts.join(convs.select("conv", "donor", "head"), "donor").where("pos <= head").select("conv", F.col("pos").alias("depth"), "symbol", "words")
    tails = turns.join(convs.select("conv", "h", "head"), "conv").where("pos > h")
    tails = tails.select("conv", (F.col("pos") - F.col("h") + F.col("head")).alias("depth"), "symbol", "words")
    return convs.select("conv", "size"), saved(heads.union(tails), f"{folder}/steps")


def run_digests(steps: DataFrame, levels: int, folder: str) -> list[DataFrame]:
    """For j below ``levels``: (conv, low, digest) of the runs of 2^j turns after depth ``low``, a multiple of 2^j."""
    out = [steps.select("conv", (F.col("depth") - 1).alias("low"), F.col("symbol").alias("digest"))]
    for j in range(1, levels):
        right = F.col("low").bitwiseAND(1 << (j - 1)) != 0
        halves = out[-1].groupBy("conv", F.shiftleft(F.shiftright("low", j), j).alias("low")).agg(
            F.max(F.when(~right, F.col("digest"))).alias("a"), F.max(F.when(right, F.col("digest"))).alias("b")
        )
        whole = halves.where("a is not null and b is not null").select("conv", "low", _sha(F.concat("a", "b")).alias("digest"))
        out.append(saved(whole, f"{folder}/digests-{j}"))
    return out


def name_prefixes(convs: DataFrame, digests: list[DataFrame], folder: str) -> DataFrame:
    """(conv, depth, name) for every depth that a conversation has, 0 included.

    ``name`` is the smallest conversation with the same turns down to ``depth``.
    """
    least = convs.agg(F.min("conv").alias("name"))
    parts = [saved(convs.join(F.broadcast(least)).select("conv", F.lit(0).cast("long").alias("depth"), "name"), f"{folder}/names-root")]
    for j in reversed(range(len(digests))):
        blocks = reduce(DataFrame.union, parts).withColumnRenamed("depth", "low")
        cuts = saved(blocks.join(digests[j], ["conv", "low"]), f"{folder}/cuts-{j}")
        named = cuts.groupBy("low", "name", "digest").agg(F.min("conv").alias("new"))
        fresh = cuts.join(named, ["low", "name", "digest"])
        parts.append(saved(fresh.select("conv", (F.col("low") + (1 << j)).alias("depth"), F.col("new").alias("name")), f"{folder}/names-{j}"))
    return reduce(DataFrame.union, parts)


def graft(own: DataFrame, paths: DataFrame, levels: int, columns: list[str], folder: str) -> DataFrame:
    """``own`` (depth, name, ``columns``) summed over the subtree of each node."""
    totals = own
    for j in range(levels):
        cut = F.shiftleft(F.shiftright("depth", j) + 1, j)
        lower = totals.where((F.col("depth").bitwiseAND((2 << j) - 1)) == (1 << j)).withColumnsRenamed({"depth": "cut", "name": "conv"})
        upper = paths.where(F.shiftright("depth", j).bitwiseAND(1) == 0).select("conv", cut.alias("cut"), "depth", "name")
        added = lower.join(upper, ["conv", "cut"]).select("depth", "name", *columns)
        sums = totals.union(added).groupBy("depth", "name").agg(*[F.sum(c).alias(c) for c in columns])
        totals = saved(sums, f"{folder}/totals-{j}")
    return totals


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of up to PACK sorted ids of a node as one text."""
    key, ids = None, []

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array([x]) for x in (*key, ids[0], ",".join(map(str, ids)))], names=["depth", "name", "first", "packed"])

    for batch in batches:
        for depth, name, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (depth, name) or len(ids) == PACK:
                if ids:
                    yield out()
                key, ids = (depth, name), []
            ids.append(conv)
    if ids:
        yield out()


def _hash(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the texts of a node in order, with commas between; nodes stand together."""
    key, sha = None, None

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array([x]) for x in (*key, sha.hexdigest())], names=["depth", "name", "ends_sha256"])

    for batch in batches:
        for depth, name, packed in zip(*(batch.column(c).to_pylist() for c in ("depth", "name", "packed")), strict=True):
            if key == (depth, name):
                sha.update(b",")
            else:
                if key is not None:
                    yield out()
                key, sha = (depth, name), hashlib.sha256()
            sha.update(packed.encode())
    if key is not None:
        yield out()


def end_digests(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """(depth, name, ends_sha256): of the ascending ids, joined by commas, of the conversations that end at a node."""
    ends = convs.select("conv", F.col("size").alias("depth")).join(paths, ["conv", "depth"]).select("depth", "name", "conv")
    order = ["depth", "name", "conv"]
    packed = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pack, "depth long, name long, first long, packed string")
    return packed.repartition("depth", "name").sortWithinPartitions("depth", "name", "first").mapInArrow(_hash, "depth long, name long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, folder: str | None = None) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per node.

    The nodes are the distinct sequences of the first turns of the rebuilt
    conversations (``rebuild``); conv_id is the smallest that starts with it.
    saved_tokens sums over the subtree (n_convs - 1) times the words of the
    node's last text. Turns with equal numbers are ordered by role and text,
    repeated rows are turns of their own. No conversation: no row, not even a
    root. Extra columns do not matter.
    """
    folder = folder or shared_dir(conversations.sparkSession)
    convs, steps = rebuild(saved(number_turns(conversations, folder), f"{folder}/turns"), folder)
    longest = convs.agg(F.max("size")).first()[0] or 0
    levels = int(longest).bit_length()
    paths = name_prefixes(convs, run_digests(steps, levels, folder) if levels else [], folder)

    counts = paths.groupBy("depth", "name").agg(F.count("*").alias("n_convs"))
    parents = paths.select(F.col("conv").alias("name"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    words = steps.select(F.col("conv").alias("name"), "depth", "words")
    nodes = saved(counts.join(parents, ["depth", "name"], "left").join(words, ["depth", "name"], "left"), f"{folder}/nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = saved(nodes.join(children, ["depth", "name"], "left").fillna(0, ["n_children", "words"]), f"{folder}/nodes-children")
    own = nodes.select(
        "depth", "name", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    )
    totals = graft(own, paths, levels, ["n_leaves", "saved_tokens"], folder)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.join(totals, ["depth", "name"])
        .join(end_digests(convs, paths), ["depth", "name"], "left")
        .select(
            F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )
