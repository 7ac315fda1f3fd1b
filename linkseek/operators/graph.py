"""The link graph: pages, surviving links with their multiplicity, degrees."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from linkseek.operators.ids import number_rows
from linkseek.workspace import Workspace

# Most edge rows that share one join key in the rank loop, and most links in one array row.
SALT_ROWS = 1_000_000
ADJACENCY_ROWS = 100_000


def valid_links(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Links whose target is a page."""
    target = pages.select(F.col("title").alias("dst_title"))
    return links.join(target, "dst_title", "left_semi")


def red_links(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Targets that are no page, with the number of links to them.

    Counting first leaves one row per target to look up, however often it is linked.
    """
    counted = links.groupBy("dst_title").agg(F.count("*").alias("n_links"))
    return counted.join(
        pages.select(F.col("title").alias("dst_title")), "dst_title", "left_anti"
    )


def link_edges(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Surviving links as (`src_title`, `dst_title`, `mult`)."""
    counted = links.groupBy("src_title", "dst_title").agg(F.count("*").alias("mult"))
    return valid_links(counted, pages)


def out_degrees(edges: DataFrame) -> DataFrame:
    """Surviving links per linking page, repeats counted."""
    return edges.groupBy("src_title").agg(F.sum("mult").alias("outdeg"))


def dead_ends(pages: DataFrame, edges: DataFrame) -> DataFrame:
    """Pages without a surviving link."""
    linking = edges.select(F.col("src_title").alias("title")).distinct()
    return pages.select("title").distinct().join(linking, "title", "left_anti")


def adjacency(
    pages: DataFrame, edges: DataFrame, work: Workspace, max_rows: int = ADJACENCY_ROWS
) -> DataFrame:
    """Array view: every page with its sorted (`dst_title`, `mult`) links.

    A page's links are numbered in the order of their targets and cut into rows of `max_rows`,
    numbered by `part`: all links of a part come before those of the next. No task ever builds
    a longer list, and the numbers come from one distributed sort.
    """
    numbered = number_rows(edges, [F.col("src_title"), F.col("dst_title")], work, "_place")
    first = work.save(numbered.groupBy("src_title").agg(F.min("_place").alias("_first")), "first-links")
    part = F.floor((F.col("_place") - F.col("_first")) / max_rows).cast("int")
    lists = (
        numbered.join(first, "src_title")
        .select(F.col("src_title").alias("title"), part.alias("part"), "dst_title", "mult")
        .repartition("title", "part")
        .groupBy("title", "part")
        .agg(F.sort_array(F.collect_list(F.struct("dst_title", "mult"))).alias("links"))
    )
    none = F.expr("cast(array() as array<struct<dst_title:string,mult:bigint>>)")
    unlinked = dead_ends(pages, edges).select(
        "title", F.lit(0).alias("part"), none.alias("links")
    )
    return lists.unionByName(unlinked)


@dataclass(frozen=True)
class LinkGraph:
    """Graph tables under numeric node keys, which is what the rank loop shuffles.

    nodes(node, title); vertices(node, outdeg, salts); edges(src, dst, mult).
    """

    nodes: DataFrame
    vertices: DataFrame
    edges: DataFrame
    n_total: int
    n_nodes: int
    n_edges: int
    n_dead: int
    max_salts: int


def build_graph(
    pages: DataFrame, links: DataFrame, work: Workspace, salt_rows: int = SALT_ROWS
) -> LinkGraph:
    """Graph of `pages(title)`, one row per input line, and `links(src_title, dst_title)`.

    `n_total` counts lines, so repeated titles count again. The join that resolves a target
    also drops red links. `salts` says over how many keys a page's edges are spread.
    """
    nodes = work.save(
        pages.select("title").distinct().withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    src = nodes.select(F.col("title").alias("src_title"), F.col("node").alias("src"))
    dst = nodes.select(F.col("title").alias("dst_title"), F.col("node").alias("dst"))
    edges = work.save(
        links.join(dst, "dst_title")
        .join(src, "src_title")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("mult")),
        "edges",
    )
    degrees = edges.groupBy("src").agg(
        F.sum("mult").alias("outdeg"), F.count("*").alias("n_targets")
    )
    seen = Observation()
    vertices = nodes.join(degrees, F.col("node") == F.col("src"), "left").select(
        "node",
        F.coalesce("outdeg", F.lit(0)).alias("outdeg"),
        F.greatest(F.lit(1), F.ceil(F.coalesce("n_targets", F.lit(0)) / salt_rows))
        .cast("int").alias("salts"),
        F.coalesce("n_targets", F.lit(0)).alias("n_targets"),
    ).observe(
        seen,
        F.count("*").alias("n_nodes"),
        F.coalesce(F.sum("n_targets"), F.lit(0)).alias("n_edges"),
        F.count_if(F.col("outdeg") == 0).alias("n_dead"),
        F.coalesce(F.max("salts"), F.lit(1)).alias("max_salts"),
    ).drop("n_targets")
    vertices = work.save(vertices, "vertices")
    stats = seen.get
    return LinkGraph(nodes, vertices, edges, pages.count(), **stats)
