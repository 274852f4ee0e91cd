"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.sources.scratch import saved


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node reachable.

    Every round takes the smallest label among neighbours and then the label's
    own label, so chains halve. Each round is one written table in ``folder``,
    which lost executors do not touch; hubs are combined before the shuffle.
    The driver sees only whether a label changed. No link: no row.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b")
    edges = saved(both.distinct(), f"{folder}/edges")
    labels = saved(
        edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), f"{folder}/labels-0"
    )
    step = 0
    while True:
        step += 1
        near = (
            edges.join(labels.select(F.col("node").alias("b"), F.col("root").alias("seen")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("seen").alias("seen"))
        )
        lower = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "seen").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = saved(
            lower.join(jump, "root", "left").select("node", "old", F.least("root", "next").alias("root")),
            f"{folder}/labels-{step}",
        )
        labels = moved.select("node", "root")
        if moved.where("root != old").isEmpty():
            return labels
