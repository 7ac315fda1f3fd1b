"""A uniform shuffle into shards of exact size, through a drawn communication matrix."""

from __future__ import annotations

from itertools import accumulate
from math import isqrt, lgamma

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkseek.llm.keys import distinct_rows, whole_row_key
from linkseek.operators.ids import number_rows
from linkseek.workspace import Workspace

SHARDS = 16
# Rows of a shard that lie together once moved there.
RANGE_ROWS = 4096
# Populations beyond this are past what numpy's draw takes.
_NUMPY_LIMIT = 10**9


def hypergeometric(good: int, bad: int, draws: int, rng: np.random.Generator) -> int:
    """How many good ones are among `draws` of good + bad, for populations of any size."""
    if good + bad < _NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws)) if draws else 0
    return by_inversion(good, bad, draws, rng)


def by_inversion(good: int, bad: int, draws: int, rng: np.random.Generator) -> int:
    """The same draw by walking outwards from the mode until the probabilities use up a uniform."""
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    choose = lambda n, k: lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
    at_mode = np.exp(choose(good, mode) + choose(bad, draws - mode) - choose(good + bad, draws))
    left = rng.random() - at_mode
    down = up = mode
    p_down = p_up = at_mode
    while left > 0 and (down > low or up < high):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode


def communication_matrix(rows: list[int], shards: int, seed: int) -> np.ndarray:
    """How many rows each part sends to each shard: the counts of a uniform shuffle.

    Row sums are the parts' sizes; column sums differ by one at most, and which shards get one
    more is drawn too. Parts draw one after the other from what the shards still have room for.
    """
    rng = np.random.default_rng(seed)
    total = sum(rows)
    room = np.full(shards, total // shards, np.int64)
    room[rng.permutation(shards)[: total % shards]] += 1
    out = np.zeros((len(rows), shards), np.int64)
    for part, n in enumerate(rows):
        left = int(room.sum())
        for shard in range(shards):
            left -= int(room[shard])
            out[part, shard] = hypergeometric(int(room[shard]), left, n, rng)
            n -= int(out[part, shard])
        room -= out[part]
    return out


def shuffle_to_shards(
    df: DataFrame, keys: list[str], work: Workspace, shards: int = SHARDS, seed: int = 0
) -> DataFrame:
    """All rows of `df` with `shard` and `slot`, uniformly shuffled, shard sizes one apart at most.

    Rows are dealt by a hash of `keys` and their place in the saved table into about the square root of
    their number of parts, so that parts and the matrix on the driver (a row per part) both stay
    small, and rows of the same keys go to different parts. A row's place in
    its part, in an order drawn by hash, and the part's row of the matrix give its shard. A second
    drawn order, over all rows of a shard, gives its slot. Null keys are keys. An empty table
    gives an empty result. Columns of `df` named shard, slot, _part, _ends, _row, _slot or _copy give way.
    """
    df = df.drop("shard", "slot", "_part", "_ends", "_row", "_slot", "_copy")
    rows = work.save(df.withColumn("_copy", F.monotonically_increasing_id()), "rows")
    n = rows.count()
    parts = max(1, isqrt(n))
    drawn = [*keys, "_copy"]
    part = F.pmod(F.xxhash64(F.lit(seed), *drawn), F.lit(parts))
    sizes = dict(rows.groupBy(part.alias("part")).count().collect())
    matrix = communication_matrix([sizes.get(i, 0) for i in range(parts)], shards, seed)
    ends = df.sparkSession.createDataFrame(
        [(i, [int(x) for x in accumulate(row)]) for i, row in enumerate(matrix.tolist())],
        "_part BIGINT, _ends ARRAY<BIGINT>",
    )
    own = Window.partitionBy("_part").orderBy(F.xxhash64(F.lit(seed + 1), *drawn), *drawn)
    shard = F.size(F.filter("_ends", lambda end: end < F.col("_row"))).cast("int")
    sent = (
        rows.withColumn("_part", part)
        .withColumn("_row", F.row_number().over(own))
        .join(ends, "_part")
        .withColumn("shard", shard)
        .select(*rows.columns, "shard")
    )
    order = [F.col("shard"), F.xxhash64(F.lit(seed + 2), *drawn), *(F.col(k) for k in drawn)]
    placed = number_rows(sent, order, work, "_slot")
    first = list(accumulate(matrix.sum(axis=0).tolist(), initial=0))[:shards]
    offsets = F.array(*(F.lit(int(x)).cast("long") for x in first))
    return placed.select(
        *df.columns, "shard", (F.col("_slot") - F.element_at(offsets, F.col("shard") + 1)).alias("slot")
    )


def sharded_texts(docs: DataFrame, work: Workspace, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """The rows of `docs` in their shards, with `shard` and `slot`.

    Places are drawn for short keys of the rows; each row then moves once to meet its
    place, equal rows as one, and once to its shard, where the rows of a range of slots lie together. Nulls are
    values like others; columns named shard and slot give way.
    """
    docs = docs.drop("shard", "slot")
    keyed = docs.withColumn("_row_key", whole_row_key(docs))
    places = shuffle_to_shards(keyed.select("_row_key"), ["_row_key"], work, shards, seed)
    whole = places.join(distinct_rows(keyed, "_row_key"), "_row_key").drop("_row_key")
    return whole.repartition("shard", F.floor(F.col("slot") / RANGE_ROWS)).select(*(F.col(f"`{c}`") for c in docs.columns), "shard", "slot")


def write_shards(df: DataFrame, path: str) -> None:
    """A folder per shard of rows with `shard` and `slot`, in the order of their slots over its files.
    A table without rows makes an empty folder."""
    df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
