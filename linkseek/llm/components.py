"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkseek.workspace import Workspace


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(`node`, `label`) for every node of (`a`, `b`): the smallest node that it is linked to,
    over any number of links.

    Each round takes the smallest label of the neighbours, then the label of the label, so
    long chains halve. Labels are saved in between.
    """
    both = work.save(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    labels = work.save(
        both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels"
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        nearer = work.save(
            labels.join(near, "node").select("node", F.least("label", "near").alias("next")), "nearer"
        )
        of_label = nearer.select(F.col("node").alias("next"), F.col("next").alias("_label"))
        jumped = work.save(
            nearer.join(of_label, "next").join(labels, "node")
            .select("node", F.col("_label").alias("label"), (F.col("_label") != F.col("label")).alias("moved")),
            "jumped",
        )
        labels = jumped.select("node", "label")
        if jumped.where("moved").isEmpty():
            return labels


def grown_components(labels: DataFrame | None, edges: DataFrame, work: Workspace) -> DataFrame:
    """The components of the edges that gave `labels` (none yet if null) and of further `edges` (`a`, `b`).

    The further edges link whole components, each as its smallest node: what was linked before is not
    gone through again.
    """
    if labels is None:
        return components(edges, work)
    side = lambda node, name: labels.select(F.col("node").alias(node), F.col("label").alias(name))
    ends = edges.join(side("a", "_a"), "a", "left").join(side("b", "_b"), "b", "left").select(
        F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")
    )
    met = components(ends.where("a != b"), work)
    old = labels.join(met.select(F.col("node").alias("label"), F.col("label").alias("_met")), "label", "left").select(
        "node", F.coalesce("_met", "label").alias("label")
    )
    return work.save(old.union(met.join(labels, "node", "left_anti").select("node", "label")), "grown")
