"""Nearest neighbours by inner product over a graph that NN-descent builds."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkseek.workspace import Workspace

TOP = 20
# Neighbours of a node in the graph, and as many that it is a neighbour of at most.
NEIGHBOURS = 32
# The graph starts from the best within random splits of the nodes into cells of at most about
# this size.
SPLITS = 6
CELL_NODES = 4096
# NN-descent ends when a round changes less than this share of the graph, or after so many.
LEAST_CHANGE = 0.05
MAX_ROUNDS = 4
# A search keeps so many nodes, goes to the neighbours of this many at each step, and ends when it
# went from all that it keeps.
BEAM = 160
STEP = 32
MAX_STEPS = 12
# Searches also enter at so many of the longest vectors, which are near to few others.
LONGEST = 8


def pack(vectors: np.ndarray, longest: float) -> list[bytes]:
    """Points: a vector in 4-byte floats, and two doubles that tell how much shorter than `longest` it is.

    A point has one more component, root(longest^2 - |v|^2) = longest - short. It is not kept:
    next to it a long vector would leave nothing of the others' components.
    """
    square = (vectors**2).sum(axis=1)
    short = square / (longest + np.sqrt(np.maximum(longest**2 - square, 0)))
    lift = np.stack([short, longest * short], axis=1)
    return [a + b for a, b in zip(map(bytes, lift), map(bytes, vectors.astype(np.float32)))]


def unpack(points: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in doubles, and what each one is short of."""
    rows = len(points)
    data = np.frombuffer(b"".join(points.to_pylist()), np.uint8).reshape(rows, -1)
    if not rows:
        return np.zeros((0, 0)), np.zeros((0, 2))
    lift = np.ascontiguousarray(data[:, :16]).view(np.float64)
    return np.ascontiguousarray(data[:, 16:]).view(np.float32).astype(float), lift


def products(a: np.ndarray, a_lift: np.ndarray, b: np.ndarray, b_lift: np.ndarray) -> np.ndarray:
    """Inner products of all points of `a` with all of `b`, less longest^2, so that little cancels."""
    out = a @ np.swapaxes(b, -1, -2)
    out += a_lift[..., :, None, 0] * b_lift[..., None, :, 0]
    out -= a_lift[..., :, None, 1] + b_lift[..., None, :, 1]
    return out


def valid_vectors(rows: DataFrame, work: Workspace) -> DataFrame:
    """(`vec_id`, `vec`) in doubles, without vectors that are null, zero or not finite throughout, or not as
    long as most are (of equally common lengths the longest): they have no product with those."""
    vec = F.col("embedding").cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    found = work.save(
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).where(
            F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~F.exists("vec", bad)
            & F.exists("vec", lambda x: x != 0)
        ).dropDuplicates(["vec_id", "vec"]),
        "vectors",
    )
    sizes = found.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.agg(F.max(F.struct("n", "size")).alias("most")).first()["most"]
    return found if common is None else found.where(F.size("vec") == common["size"])


def _best(df: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key; Spark already keeps n a task before it shuffles."""
    own = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(own)).where(F.col("_place") <= n).drop("_place")


def _nearest(score: str = "score", node: str = "other") -> list[Column]:
    return [F.col(score).desc(), F.col(node)]


def distinct_nodes(vectors: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Equal vectors as one node: (`node`, `vec`, `point`) and (`vec_id`, `node`).

    Points are the vectors with one more component that makes all equally long, so that the
    nearest by inner product are the nearest by distance too and a graph leads to them.
    """
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    grouped = vectors.groupBy("vec").agg(F.count("*").alias("n")).select("vec", square.alias("square"))
    nodes = work.save(grouped.withColumn("node", F.monotonically_increasing_id()), "distinct")
    most = nodes.agg(F.max("square")).first()[0] or 0.0
    longest = float(most) ** 0.5
    nodes = work.save(
        nodes.mapInArrow(partial(_points, longest=longest), "node long, vec array<double>, point binary"),
        "nodes",
    )
    members = work.save(vectors.join(nodes.select("node", "vec"), "vec").select("vec_id", "node"), "members")
    return nodes, members


def _points(batches: Iterator[pa.RecordBatch], longest: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vec = _matrix(batch.column("vec"), batch.num_rows)
        yield pa.RecordBatch.from_pydict({
            "node": batch.column("node"), "vec": batch.column("vec"),
            "point": pa.array(pack(vec, longest), pa.binary()),
        })


def _cells(split: int, bits: int):
    """The side of `bits` random planes that each point is on; planes depend on the split alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = unpack(batch.column("point"))[0]
            planes = np.random.default_rng([split, points.shape[1]]).normal(size=(points.shape[1], bits))
            side = (points @ planes > 0) @ (1 << np.arange(bits))
            yield pa.RecordBatch.from_pydict({
                "node": batch.column("node"), "point": batch.column("point"),
                "cell": pa.array(side.astype(np.int64)),
            })

    return run


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _within_cell(cell: pd.DataFrame) -> pd.DataFrame:
    points, lift = unpack(pa.array(cell["point"], pa.binary()))
    node = cell["node"].to_numpy()
    n = min(NEIGHBOURS, len(node) - 1)
    best, scores = [np.zeros((0, n), np.int64)], [np.zeros((0, n))]
    for at in range(0, len(node) if n else 0, 256):
        score = products(points[at : at + 256], lift[at : at + 256], points, lift)
        rows = np.arange(len(score))
        score[rows, rows + at] = -np.inf
        best.append(np.argpartition(-score, n - 1, axis=1)[:, :n])
        scores.append(np.take_along_axis(score, best[-1], axis=1))
    best, scores = np.concatenate(best), np.concatenate(scores)
    return pd.DataFrame({
        "node": np.repeat(node[: len(best)], n), "other": node[best].ravel(), "score": scores.ravel()
    })


def start_graph(nodes: DataFrame, n: int, work: Workspace) -> DataFrame:
    """(`node`, `other`, `score`, `new`): the best neighbours inside cells of random splits.

    Cells that hold more nodes than they should are dealt out by a hash; there is always a cell
    with others, as the number of nodes over the size decides.
    """
    bits = ceil(log2(max(1, n / CELL_NODES)))
    found = None
    for split in range(SPLITS if bits else 1):  # without planes all splits are one cell
        celled = work.save(
            nodes.select("node", "point").mapInArrow(
                _cells(split, bits), "node long, point binary, cell long"
            ),
            "celled",
        )
        size = work.save(celled.groupBy("cell").agg(F.count("*").alias("n")), "cells")
        part = F.pmod(F.xxhash64("node", F.lit(split)), F.ceil(F.col("n") / (2 * CELL_NODES)))
        edges = (
            celled.join(size, "cell").withColumn("part", part).groupBy("cell", "part")
            .applyInPandas(_within_cell, "node long, other long, score double")
        )
        found = edges if found is None else found.union(edges)
    return work.save(_merged(found.withColumn("new", F.lit(True))), "graph")


def _merged(edges: DataFrame) -> DataFrame:
    """Each node's best neighbours; an edge that was there before isn't new."""
    once = edges.repartition("node").groupBy("node", "other").agg(
        F.max("score").alias("score"), F.min("new").alias("new")
    )
    return _best(once, "node", _nearest(), NEIGHBOURS)


def both_ways(graph: DataFrame) -> DataFrame:
    """(`node`, `other`, `new`): neighbours, and up to NEIGHBOURS nodes it is a neighbour of."""
    back = graph.select(F.col("other").alias("node"), F.col("node").alias("other"), "score", "new")
    back = _best(back, "node", [F.col("new").desc(), F.xxhash64("node", "other")], NEIGHBOURS)
    return (
        graph.select("node", "other", "new").union(back.select("node", "other", "new"))
        .groupBy("node", "other").agg(F.max("new").alias("new"))
    )


def _local_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of a node's neighbours with a new one, where one is nearer to the other than the
    farthest of its own neighbours."""
    for batch in batches:
        lists = batch.column("near")
        rows = lists.flatten()
        size = np.diff(lists.offsets.to_numpy())
        total, width = len(rows), int(size.max(initial=0))
        if not total:
            continue
        node = rows.field("other").to_numpy(zero_copy_only=False)
        new = rows.field("new").to_numpy(zero_copy_only=False)
        least = rows.field("least").to_numpy(zero_copy_only=False)
        points, lift = unpack(rows.field("point"))
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        for at in range(0, len(size), 64):
            rows_of = start[at : at + 64, None] + np.arange(width)
            inside = np.arange(width) < size[at : at + 64, None]
            rows_of = np.where(inside, rows_of, 0)
            block, short = points[rows_of], lift[rows_of]
            score = products(block, short, block, short)
            go = (new[rows_of][:, :, None] | new[rows_of][:, None, :]) & (score > least[rows_of][:, :, None])
            go &= inside[:, :, None] & inside[:, None, :]
            which, a, b = np.nonzero(go & ~np.eye(width, dtype=bool))
            yield pa.RecordBatch.from_pydict({
                "node": pa.array(node[rows_of[which, a]]), "other": pa.array(node[rows_of[which, b]]),
                "score": pa.array(score[which, a, b].astype(np.float64)),
            })


def descend(graph: DataFrame, nodes: DataFrame, work: Workspace) -> DataFrame:
    """One round: neighbours of a node meet each other, and nodes keep the nearest they met.

    Every node's list is bounded, whatever the number of nodes that it is a neighbour of.
    """
    least = graph.groupBy("node").agg(
        F.when(F.count("*") >= NEIGHBOURS, F.min("score")).otherwise(float("-inf")).alias("least")
    )
    known = work.save(nodes.select("node", "point").join(least, "node"), "known")
    met = both_ways(graph).join(known.withColumnRenamed("node", "other"), "other")
    near = met.groupBy("node").agg(
        F.collect_list(F.struct("other", "new", "least", "point")).alias("near")
    )
    found = near.select("near").mapInArrow(_local_join, "node long, other long, score double")
    old = graph.withColumn("new", F.lit(False))
    return work.save(_merged(old.union(found.withColumn("new", F.lit(True)))), "graph")


def build_graph(nodes: DataFrame, work: Workspace) -> DataFrame:
    """(`node`, `other`): every node with its neighbours, and some it is a neighbour of."""
    n = nodes.count()
    graph = start_graph(nodes, n, work)
    for _ in range(MAX_ROUNDS):
        graph = descend(graph, nodes, work)
        if graph.where("new").count() <= LEAST_CHANGE * NEIGHBOURS * n:
            break
    return work.save(both_ways(graph).select("node", "other"), "links")


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Inner products by which a query's beam may grow."""
    for batch in batches:
        points = unpack(batch.column("point"))[0]
        asked = _matrix(batch.column("asked"), batch.num_rows)
        score = np.einsum("ij,ij->i", asked, points) if len(asked) else np.zeros(0)
        go = pa.array(score > batch.column("least").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_pydict({
            "query": batch.column("query").filter(go), "node": batch.column("node").filter(go),
            "score": pa.array(score).filter(go),
        })


def greedy_search(asked: DataFrame, nodes: DataFrame, links: DataFrame, work: Workspace) -> DataFrame:
    """(`query`, `node`): the BEAM best nodes that each query found.

    `asked` has `query`, its vector `asked`, the node `entry` where it enters the graph and that
    node's `score`; all enter at the longest vectors too. Each step goes from the best nodes not gone
    from yet to all of their neighbours.
    """
    points = nodes.select("node", "point")
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    longest = nodes.orderBy(square.desc(), "node").limit(LONGEST).select("node", "vec")
    far = (
        asked.join(F.broadcast(longest), F.col("query") != F.col("node"))
        .select("query", "node", "asked", "vec")
        .mapInArrow(_exact, "query long, node long, score double").withColumn("gone", F.lit(False))
    )
    order = _nearest(node="node")
    beam = work.save(
        asked.select("query", F.col("entry").alias("node"), "score", F.lit(False).alias("gone")).union(far),
        "beam",
    )
    for _ in range(MAX_STEPS):
        go = work.save(
            _best(beam.where(~F.col("gone")), "query", order, STEP).select(
                "query", "node", F.lit(True).alias("left")),
            "go",
        )
        if go.isEmpty():
            break
        least = beam.groupBy("query").agg(
            F.when(F.count("*") >= BEAM, F.min("score")).otherwise(float("-inf")).alias("least")
        )
        asking = asked.select("query", "asked").join(least, "query")
        reached = go.join(links, "node").select("query", F.col("other").alias("node")).distinct()
        found = (
            reached.join(points, "node").join(asking, "query")
            .select("query", "node", "asked", "point", "least")
            .mapInArrow(_scored, "query long, node long, score double").withColumn("gone", F.lit(False))
        )
        before = beam.join(go, ["query", "node"], "left").select(
            "query", "node", "score", F.coalesce("left", "gone").alias("gone")
        )
        once = before.union(found).repartition("query").groupBy("query", "node").agg(
            F.max("score").alias("score"), F.max("gone").alias("gone")
        )
        beam = work.save(_best(once, "query", order, BEAM), "beam")
    return beam.select("query", "node")


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        asked, vec = _matrix(batch.column("asked"), n), _matrix(batch.column("vec"), n)
        yield pa.RecordBatch.from_pydict({
            "query": batch.column("query"), "node": batch.column("node"),
            "score": pa.array(np.einsum("ij,ij->i", asked, vec) if n else np.zeros(0)),
        })


def nearest_neighbours(rows: DataFrame, is_query: Column, work: Workspace, top: int = TOP) -> DataFrame:
    """(`query_id`, `rank`, `vec_id`, `score`): the `top` nearest found of each query, by largest
    inner product in doubles on the vectors as they are, ties to the smaller `vec_id`.

    `rows` has `vec_id` and `embedding`; queries are those of its rows that `is_query` picks, and
    search all other rows. Vectors that are null, zero, hold anything null or not finite, or are not of
    the commonest length take no part, nor do rows without a `vec_id`. Equal vectors are one node of the graph, with the few
    smallest ids that any result can show; repeated rows count once. Queries enter the graph
    at their own node. One vector alone finds nothing; an empty table gives no rows.
    """
    vectors = valid_vectors(rows, work)
    nodes, members = distinct_nodes(vectors, work)
    links = build_graph(nodes, work)
    asking = work.save(members.where(is_query), "asking")
    asked = work.save(
        nodes.join(asking.select("node").distinct(), "node", "left_semi")
        .select(F.col("node").alias("query"), F.col("vec").alias("asked"), F.col("node").alias("entry"),
                F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x).alias("score")),
        "asked",
    )
    found = (
        greedy_search(asked, nodes, links, work).join(asked.select("query", "asked"), "query")
        .join(nodes.select("node", "vec"), "node").select("query", "node", "asked", "vec")
        .mapInArrow(_exact, "query long, node long, score double")
    )
    shown = work.save(_best(members.distinct(), "node", [F.col("vec_id")], top + 1), "shown")
    listed = found.join(shown, "node").select("query", "vec_id", "score")
    # One more than asked for: the query itself is among its node's own.
    listed = work.save(_best(listed, "query", _nearest(node="vec_id"), top + 1), "listed")
    answers = asking.select(F.col("vec_id").alias("query_id"), F.col("node").alias("query")).join(
        listed, "query"
    ).where("query_id != vec_id")
    own = Window.partitionBy("query_id").orderBy(*_nearest(node="vec_id"))
    return answers.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= top).select(
        "query_id", "rank", "vec_id", "score"
    )
