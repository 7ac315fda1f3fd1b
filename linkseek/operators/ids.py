"""Dense numbers in a global order, and the checks that use them."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkseek.functions.scoring import rank_order
from linkseek.workspace import Workspace

# monotonically_increasing_id puts the partition above these bits and the row below.
ROW_BITS = 33


def number_rows(
    df: DataFrame, order: list[Column], work: Workspace, column: str, start: int = 0
) -> DataFrame:
    """Number all rows in `order` from `start`, without a single-partition window.

    The rows are range-partitioned, sorted and written once with their place in their
    partition; a row's number is that place plus the sizes of the partitions before it.
    The offset table has one row per written partition.
    """
    placed = work.save(
        df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()),
        f"placed-{column}",
    ).withColumn("_part", F.shiftright("_place", ROW_BITS))
    sizes = sorted(placed.groupBy("_part").count().collect())
    before = accumulate((n for _, n in sizes), initial=start)
    offsets = work.spark.createDataFrame(
        [(part, first) for (part, _), first in zip(sizes, before)], "_part BIGINT, _first BIGINT"
    )
    in_part = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(column, in_part + F.col("_first"))
        .select(column, *df.columns)
    )


def rank_table(ranks: DataFrame, n_docs: int, work: Workspace) -> DataFrame:
    """(`doc_id`, `title`, `pr`): ids from 0 in rank order."""
    return number_rows(ranks.select("title", "pr"), rank_order(n_docs), work, "doc_id")


def titles_without_id(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.select("title").distinct().join(ids.select("title"), "title", "left_anti")


def ids_without_title(doc_ids: DataFrame, ids: DataFrame) -> DataFrame:
    return doc_ids.select("doc_id").distinct().join(ids.select("doc_id"), "doc_id", "left_anti")
