"""Exact duplicates by content-defined chunks: texts become lists of chunk identifiers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkseek.llm.batches import starts, text_slices
from linkseek.llm.keys import row_key
from linkseek.workspace import Workspace

# A cut is made where a hash of the last 2**WINDOW_BITS bytes ends in CUT_BITS zeros.
WINDOW_BITS = 5
CUT_BITS = 11
MIN_CHUNK = 256
MAX_CHUNK = 16384
# Bits of the chunk hash that stands for a chunk until it is verified.
HASH_BITS = 64

_BASE = 0x01000193


def cuts(texts: list[bytes]) -> list[list[int]]:
    """Ends of each text's chunks; they depend on that text alone. An empty text has none."""
    start = starts([len(x) for x in texts])
    h = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32) + np.uint32(1)
    for bit in range(WINDOW_BITS):  # the hash of 2n bytes from those of n
        half = 1 << bit
        factor = np.uint32(pow(_BASE, half, 1 << 32))
        h[half:] += h[:-half] * factor
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    marks = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    out = []
    for begin, end, a, b in zip(
        start[:-1].tolist(), start[1:].tolist(),
        np.searchsorted(marks, start[:-1] + MIN_CHUNK), np.searchsorted(marks, start[1:]),
    ):
        last, ends = begin, []
        for mark in [*marks[a:b].tolist(), end] if end > begin else []:
            if mark - last < MIN_CHUNK and mark != end:
                continue
            while mark - last > MAX_CHUNK:
                last += MAX_CHUNK
                ends.append(last - begin)
            if mark > last:
                last = mark
                ends.append(last - begin)
        out.append(ends)
    return out


def _chunks(text: bytes, ends: list[int]) -> list[bytes]:
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _hash(chunk: bytes, bits: int) -> int:
    h = xxhash.xxh3_64_intdigest(chunk) & ((1 << bits) - 1)
    return h - (1 << 64) if h >> 63 else h


def _normalised(batches) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch, texts in text_slices(batches):
        yield batch, [x.lower() for x in texts]  # of bytes: A-Z only


def _recipes(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _normalised(batches):
            recipes = [
                [_hash(c, bits) for c in _chunks(x, ends)] for x, ends in zip(texts, cuts(texts))
            ]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "row": batch.column("row"),
                "row_key": batch.column("row_key"),
                "text_sha256": [hashlib.sha256(x).hexdigest() for x in texts],
                "recipe": pa.array(recipes, pa.list_(pa.int64())),
            })

    return run


def _chunk_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _normalised(batches):
            rows = [
                (hashlib.sha256(x).hexdigest(), place, _hash(c, bits), c)
                for x, ends in zip(texts, cuts(texts)) for place, c in enumerate(_chunks(x, ends))
            ]
            names = ["text_sha256", "place", "hash", "chunk"]
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary()]
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_pydict(
                {n: pa.array(list(c), k) for n, k, c in zip(names, kinds, columns)}
            )

    return run


def exact_groups(docs: DataFrame, work: Workspace, bits: int = HASH_BITS) -> DataFrame:
    """One row per row of `docs` (`doc_id`, `text`): `doc_id`, `keep_id`, `group_size`, `kept`,
    `text_sha256`, `row_key`.

    Texts are equal when identical after lower-casing A-Z; a null text is an empty one. Every
    text is cut where its content says so. Each distinct chunk moves once and is compared byte
    by byte with those of its hash; a hash that stands for one chunk alone is that chunk's
    identifier, else the chunk's number among them is added. Equal texts then have equal
    identifier lists, the only thing that is grouped. The largest `doc_id` stays; of its
    repeated rows one. A null `doc_id` is smaller than any. An empty table gives no rows.
    """
    texts = docs.select("doc_id", "text", row_key(docs["doc_id"], docs["text"]).alias("row_key"))
    recipes = work.save(
        texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
            _recipes(bits), "doc_id long, row long, row_key string, text_sha256 string, recipe array<long>"
        ),
        "recipes",
    )
    chunks = texts.select("text").mapInArrow(
        _chunk_rows(bits), "text_sha256 string, place int, hash long, chunk binary"
    )
    distinct = chunks.select("hash", "chunk").distinct()
    shared = work.save(
        distinct.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "shared"
    )
    numbered = _numbers(chunks, distinct, shared, work)
    recipes = recipes.join(numbered, "text_sha256", "left").withColumn(
        "numbers", F.coalesce("numbers", F.array().cast("array<struct<place:int,number:int>>"))
    ) if numbered is not None else recipes.withColumn("numbers", F.lit(0))
    best = F.max(F.struct("doc_id", "row"))
    groups = work.save(
        recipes.groupBy("recipe", "numbers").agg(best.alias("best"), F.count("*").alias("group_size")),
        "groups",
    )
    return recipes.join(groups, ["recipe", "numbers"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256", "row_key",
    )


def _numbers(chunks: DataFrame, distinct: DataFrame, shared: DataFrame, work: Workspace):
    """Per text, the numbers of its chunks whose hash stands for several; None if none does."""
    if shared.isEmpty():
        return None
    among = Window.partitionBy("hash").orderBy("chunk")
    number = distinct.join(shared, "hash").withColumn("number", F.row_number().over(among))
    return work.save(
        chunks.join(shared, "hash", "left_semi")
        .join(work.save(number, "numbered"), ["hash", "chunk"])
        .groupBy("text_sha256")
        .agg(F.array_sort(F.collect_set(F.struct("place", "number"))).alias("numbers")),
        "numbers",
    )

