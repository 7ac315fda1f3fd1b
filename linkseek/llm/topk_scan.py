"""Exact top-k by integer inner product, from sorted lists that are only read in order."""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkseek.workspace import Workspace

TOP = 5
SCALE = 256
# Components in one block of sorted lists, and queries that read a block's lists in one task.
BLOCK_COMPONENTS = 1 << 22
CHUNK_QUERIES = 128
# The first level, as a share of the largest contribution, and each next one of that before it.
FIRST_LEVEL = 0.15
NEXT_LEVEL = 0.65
# Vectors that are few enough to have their scores resolved, as a share of the block.
RESOLVED = 1 / 16


def grid(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as doubles; null for a null or empty vector and for one
    with a null or non-finite component.

    Components whose products could add up to more than 64 bits are held at the largest that can't.
    """
    x = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    most = F.floor(F.sqrt(F.lit(2.0**62) / F.size(vector)))
    held = F.transform(
        x, lambda v: F.floor(F.greatest(F.least(v * scale, most.cast("double")), -most.cast("double")))
    )
    return F.when((F.size(vector) > 0) & F.coalesce(finite, F.lit(False)), held)


class Lists:
    """A block's sorted lists: of each component, places from its smallest value to its largest."""

    def __init__(self, order: list[np.ndarray], value: list[np.ndarray]):
        self.order, self.value = [x.astype(np.intp) for x in order], value
        self.n = len(order[0])

    def vectors(self) -> np.ndarray:
        """The block's vectors by place, from lists read to their ends."""
        out = np.empty((self.n, len(self.order)), np.int64)
        for dim, (order, value) in enumerate(zip(self.order, self.value)):
            out[order, dim] = value
        return out


def scan(lists: Lists, query: np.ndarray, top: int) -> tuple[np.ndarray, int]:
    """Places that may be among the query's `top`, all that can be among them, without looking any
    vector up, and how many list entries were read for it.

    Each list is read from both ends: contributions to the score are large at one and small at the
    other. A round reads on past every contribution above its level, so that what a list has not
    shown yet contributes between minus and plus the level; lists too flat for the level are not
    read and lie between their ends. Contributions seen, with the least or the most of the others,
    are the bounds of a vector's score. The scan ends when few vectors, seen or not, can reach the
    `top`-th largest lower bound; at the ends of the lists the bounds are the scores. Products too
    large for bounds in 64 bits leave all places.
    """
    dims = np.flatnonzero(query).tolist()
    weight = {d: int(query[d]) for d in dims}
    ends = {d: sorted((weight[d] * int(lists.value[d][0]), weight[d] * int(lists.value[d][-1]))) for d in dims}
    reach = {d: max(abs(low), abs(high)) for d, (low, high) in ends.items()}
    # Contributions seen, and in the last digits how many there are.
    digits = 1 << len(dims).bit_length()
    if sum(reach.values()) * digits >= 1 << 62:
        return np.arange(lists.n), 0
    seen = np.zeros(lists.n, np.int64)
    begin, end = dict.fromkeys(dims, 0), dict.fromkeys(dims, lists.n)
    level, n_read = int(max(reach.values(), default=0) * FIRST_LEVEL), 0
    while True:
        active = [d for d in dims if reach[d] > level]
        for d in active:
            value, order, w = lists.value[d], lists.order[d], weight[d]
            bound = level // abs(w)  # contributions above the level are those of values past it
            first = max(begin[d], int(np.searchsorted(value, -bound, "left")))
            last = min(end[d], int(np.searchsorted(value, bound, "right")))
            for a, b in ((begin[d], first), (last, end[d])):
                if a < b:
                    seen[order[a:b]] += w * digits * value[a:b] + 1
                    n_read += b - a
            begin[d], end[d] = first, last
        flat = [ends[d] for d in dims if reach[d] <= level]
        known = seen // digits
        unshown = (len(active) - (seen - known * digits)) * level
        lower = known - unshown + sum(low for low, _ in flat)
        upper = known + unshown + sum(high for _, high in flat)
        needed = np.partition(lower, lists.n - top)[lists.n - top] if lists.n > top else lower.min()
        left = np.flatnonzero(upper >= needed)
        if level == 0 or len(left) <= max(top, RESOLVED * lists.n):
            return left, n_read
        level = int(level * NEXT_LEVEL)


def _sorted_lists(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("place")
    vectors = np.array(block["point"].tolist(), np.int64).T
    order = np.argsort(vectors, axis=1, kind="stable")
    return pd.DataFrame({
        "dims": block["dims"].iloc[0], "block": block["block"].iloc[0], "dim": np.arange(len(order)),
        "places": list(order.astype(np.int32)), "sorted": list(np.take_along_axis(vectors, order, axis=1)),
    })


def _best(lists: pd.DataFrame, queries: pd.DataFrame, top: int) -> pd.DataFrame:
    """The `top` of one block for some queries; of equal scores the first places."""
    found = []
    if len(lists) and len(queries):
        lists = lists.sort_values("dim")
        block = Lists(lists["places"].tolist(), lists["sorted"].tolist())
        vectors = block.vectors()
        for number, point in zip(queries["query"].tolist(), queries["point"]):
            query = np.asarray(point, np.int64)
            left, _ = scan(block, query, top)
            score = vectors[left] @ query
            for i in np.lexsort((left, -score))[:top].tolist():
                found.append((number, lists["dims"].iloc[0], lists["block"].iloc[0], left[i], score[i]))
    return pd.DataFrame(found, columns=["query", "dims", "block", "place", "score"])


def exact_top(
    vectors: DataFrame, is_query: Column, work: Workspace, top: int = TOP, scale: int = SCALE
) -> DataFrame:
    """(`query_id`, `rank`, `vec_id`, `score`): for each row of `vectors` (`vec_id`, `embedding`) that
    `is_query` holds for, its `top` other rows of the largest inner products of components
    floor(scale * x), ties by smaller id; all if there are fewer.

    Vectors are dealt into blocks, each with sorted lists of its components; chunks of queries scan
    each block's lists and the blocks' best are ranked together. Equal vectors are one point with
    its smallest top + 1 ids, which are all that any query can return of them, so that a vector that
    a third of all rows have is scanned, and asked for, once.
    A vector that is null, empty, or has a null or non-finite component takes no part, nor
    does a row without an id. Rows of one id are one vector, the largest if they differ. Vectors
    of different lengths have no product. A query without other rows has no result, an empty table
    gives none.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), grid(F.col("embedding"), scale).alias("point"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    ).where("vec_id IS NOT NULL AND point IS NOT NULL")
    rows = work.save(
        rows.groupBy("vec_id").agg(F.max(F.struct("point", "asked")).alias("row"))
        .select("vec_id", "row.*", F.size("row.point").alias("dims")),
        "points",
    )
    by_id = Window.partitionBy("dims", "point").orderBy("vec_id")
    points = work.save(
        rows.select("dims", "point", "vec_id", F.row_number().over(by_id).alias("n"))
        .where(F.col("n") <= top + 1)
        .groupBy("dims", "point").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")),
        "distinct",
    )
    asked = rows.where("asked")
    queries = work.save(
        asked.select("dims", "point").distinct().withColumn("query", F.monotonically_increasing_id()), "queries"
    )
    parts = work.save(_parts(points, queries), "parts")
    dealt = points.join(parts, "dims").withColumn("block", F.pmod(F.xxhash64("point"), "blocks"))
    in_block = Window.partitionBy("dims", "block").orderBy(F.col("ids")[0])
    dealt = work.save(
        dealt.select("dims", "block", "point", "ids", (F.row_number().over(in_block) - 1).alias("place")), "dealt"
    )
    lists = work.save(
        dealt.groupBy("dims", "block").applyInPandas(
            _sorted_lists, "dims int, block long, dim int, places array<int>, sorted array<long>"
        ),
        "lists",
    )
    chunk = F.pmod(F.xxhash64("query"), "chunks").alias("chunk")
    everywhere = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    best = _chunks(
        lists.join(parts, "dims").select(*lists.columns, everywhere("chunks").alias("chunk")),
        queries.join(parts, "dims").select(*queries.columns, chunk, everywhere("blocks").alias("block")),
        top + 1,
    )
    best = work.save(best, "best")
    ids = dealt.select("dims", "block", "place", "ids")
    order = [F.col("score").desc(), F.col("vec_id")]
    ranked = best.join(ids, ["dims", "block", "place"]).select("query", "score", F.explode("ids").alias("vec_id"))
    ranked = work.save(
        ranked.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
        .where(F.col("n") <= top + 1),
        "ranked",
    )
    asking = asked.join(queries, ["dims", "point"]).select(F.col("vec_id").alias("query_id"), "query")
    own = Window.partitionBy("query_id").orderBy(*order)
    return (
        work.save(asking, "asking").join(ranked, "query").where("vec_id != query_id")
        .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )


def _parts(points: DataFrame, queries: DataFrame) -> DataFrame:
    """(`dims`, `blocks`, `chunks`): how many parts the points and queries of a length are dealt into."""
    size = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_COMPONENTS) / F.col("dims")))
    return points.groupBy("dims").agg(F.count("*").alias("n")).join(
        queries.groupBy("dims").agg(F.count("*").alias("n_queries")), "dims"
    ).select(
        "dims", F.ceil(F.col("n") / size).alias("blocks"),
        F.ceil(F.col("n_queries") / CHUNK_QUERIES).alias("chunks"),
    )


def _chunks(lists: DataFrame, queries: DataFrame, top: int) -> DataFrame:
    keys = ["dims", "block", "chunk"]
    return lists.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        partial(_best, top=top), "query long, dims int, block long, place int, score long"
    )
