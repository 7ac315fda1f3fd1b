"""PageRank over a link graph, turn by turn until the change is small."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from linkseek.functions.scoring import DAMPING, TOLERANCE, teleport
from linkseek.operators.graph import LinkGraph
from linkseek.workspace import Workspace

METRICS_SCHEMA = (
    "turn BIGINT, dead_mass DOUBLE, dead_count BIGINT, total_rank DOUBLE, error DOUBLE"
)


# Edges in a partition of the rank loop.
EDGE_ROWS = 4_000_000


@dataclass(frozen=True)
class RankRun:
    """ranks(title, pr), one metrics row per turn, and the number of turns."""

    ranks: DataFrame
    metrics: DataFrame
    turns: int


def initial_state(graph: LinkGraph) -> DataFrame:
    return graph.vertices.withColumn("pr", F.lit(1.0) / F.lit(graph.n_total))


def edge_keys(graph: LinkGraph) -> list[str]:
    """What edges meet their source's share on: `salt` takes part only if some page needs it."""
    return ["src"] if graph.max_salts == 1 else ["src", "salt"]


def salted_edges(graph: LinkGraph) -> DataFrame:
    """Edges, with the `salt` that spreads a page of very many targets over several keys.

    Only pages above the limit are looked up, at most one per `SALT_ROWS` edges.
    """
    if graph.max_salts == 1:
        return graph.edges
    hot = graph.vertices.where("salts > 1").select(F.col("node").alias("src"), "salts")
    return graph.edges.join(hot, "src", "left").select(
        "src", "dst", "mult",
        F.coalesce(F.expr("pmod(xxhash64(dst), salts)").cast("int"), F.lit(0)).alias("salt"),
    )


def page_shares(state: DataFrame, keys: list[str], share: str) -> DataFrame:
    """What each page's links carry for its share, on the keys of `salted_edges`."""
    shares = state.where("outdeg > 0").selectExpr("node AS src", f"{share} AS share", "salts")
    if "salt" in keys:
        shares = shares.withColumn("salt", F.expr("explode(sequence(0, salts - 1))"))
    return shares


def _inflow(edges: DataFrame, shares: DataFrame, keys: list[str]) -> DataFrame:
    return edges.join(shares, keys).groupBy("dst").agg(F.expr("sum(share * mult) AS inflow"))


def rank_step(
    state: DataFrame,
    edges: DataFrame,
    keys: list[str],
    base: float,
    damping: float = DAMPING,
    unlinked: float | None = None,
) -> DataFrame:
    """One turn: state(node, outdeg, salts, pr) to the same with `prev`.

    Edges stay where they are; the per-page share travels to them, and partial sums per
    target travel on. `base` is what every page gets without links. With `unlinked`, the rank of all pages that
    no link leads to, the links of these may be left out of `edges`: `state` is that of `linked_state`.
    """
    sources, given = (state, "0D") if unlinked is None else (state.where("linked"), f"given * {unlinked!r}D")
    inflow = _inflow(edges, page_shares(sources, keys, "pr / outdeg"), keys)
    kept = [c for c in state.columns if c != "pr"]
    return state.join(inflow, F.expr("node = dst"), "left").selectExpr(
        *kept, "pr AS prev", f"{damping!r}D * (coalesce(inflow, 0D) + {given}) + {base!r}D AS pr",
    )


def linked_state(graph: LinkGraph, work: Workspace) -> DataFrame:
    """The initial state with `linked`, whether a link leads to the page, and `given`, the shares of a rank of 1
    that pages without such links give it.

    These pages all have the same rank in every turn, so what they give is known without their links.
    """
    linked = work.save(graph.edges.select(F.col("dst").alias("_linked")).distinct(), "linked")
    state = initial_state(graph).join(linked, F.expr("node = _linked"), "left").withColumn(
        "linked", F.col("_linked").isNotNull()
    ).drop("_linked")
    state = work.save(state, "linked-state")
    keys = edge_keys(graph)
    shares = page_shares(state.where("NOT linked"), keys, "1D / outdeg")
    given = work.save(_inflow(salted_edges(graph), shares, keys), "given")
    return state.join(given, F.expr("node = dst"), "left").select(
        *state.columns, F.coalesce("inflow", F.lit(0.0)).alias("given")
    )


def pagerank(
    graph: LinkGraph,
    work: Workspace,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
    max_turns: int | None = None,
) -> RankRun:
    """Repeat `rank_step` until the L1 change drops below `tolerance`.

    Each turn is one job: it writes the new state to the shared folder and reports the
    turn's sums from the same pass. Two state tables alternate, so the one being read is
    never overwritten and storage stays at two states. The links of pages that no link leads to
    are gone through once, before the first turn.
    """
    spark = work.spark
    keys = edge_keys(graph)
    state = work.save(linked_state(graph, work), "first-state")
    sources = state.where("linked").select(F.col("node").alias("src"))
    edges = (
        salted_edges(graph).join(sources, "src", "left_semi")
        .repartition(_edge_partitions(graph), *keys)
        .sortWithinPartitions(*keys)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    # Filled before the first turn: only then do plans see how the edges are laid out.
    edges.count()
    unlinked = 1.0 / graph.n_total if graph.n_total else 0.0
    dead_mass = graph.n_dead / graph.n_total if graph.n_total else 0.0
    paths = [work.fresh("state"), work.fresh("state")]
    rows: list[tuple] = []
    try:
        while graph.n_nodes:
            turn = len(rows) + 1
            base = teleport(dead_mass, graph.n_total, damping)
            sums = Observation()
            step = rank_step(state, edges, keys, base, damping, unlinked).observe(
                sums,
                F.expr("sum(pr) AS total_rank"),
                F.expr("sum(abs(prev - pr)) AS error"),
                F.expr("coalesce(sum(CASE WHEN outdeg = 0 THEN pr END), 0D) AS dead_mass"),
            )
            state = work.write(step.drop("prev"), paths[turn % 2])
            seen = sums.get
            rows.append((turn, dead_mass, graph.n_dead, seen["total_rank"], seen["error"]))
            dead_mass, unlinked = seen["dead_mass"], base
            if seen["error"] < tolerance or turn == max_turns:
                break
    finally:
        edges.unpersist()
    ranks = state.join(graph.nodes, "node").select("title", "pr")
    return RankRun(ranks, spark.createDataFrame(rows, METRICS_SCHEMA), len(rows))


def _edge_partitions(graph: LinkGraph) -> int:
    """A partition for each EDGE_ROWS edges, as a target has a partial sum in each; no more than the session's
    shuffle partitions, but for more than 20M edges in each."""
    session = int(graph.edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, min(session, graph.n_edges // EDGE_ROWS + 1), graph.n_edges // 20_000_000)
