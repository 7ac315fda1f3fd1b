"""Repeated runs of lines, found by winnowing and deleted where they come again."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkseek.llm.batches import list_array, signed, span_hashes, starts, text_slices
from linkseek.workspace import Workspace

# Words that a run needs to be deleted, and that each window of lines has at least.
MIN_WORDS = 10

_RECORD = (
    "doc_id long, text_key long, key long, begins array<int>, ends array<int>, lines array<binary>"
)
_TAKEN = np.uint64((1 << 64) - 1)


def windows(
    words: np.ndarray, hashes: np.ndarray, bounds: np.ndarray, least: int = MIN_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and selected line of all shortest runs of lines that have `least` words, by begin.

    They are the shortest from each line on, and the shortest up to each line; `bounds` are where
    each document's lines start (one more than documents). Every line of a longer run is in one
    of them inside that run, so equal runs have equal windows. Selected is the line of the
    smallest hash in the shortest window from the same begin, the last of equal ones; lines
    without words never are.
    """
    n = len(words)
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    doc_end = np.repeat(bounds[1:], np.diff(bounds))
    doc_begin = np.repeat(bounds[:-1], np.diff(bounds))
    line = np.arange(n)
    first_end = np.searchsorted(total, total[:-1] + least)
    begin = line[first_end <= doc_end]
    end = first_end[begin]
    from_ = np.searchsorted(total, total[1:] - least, side="right") - 1
    to = line[from_ >= doc_begin] + 1
    from_ = from_[to - 1]
    # Smallest of 1, 2, 4, ... lines from each on; two such spans make a window.
    weight = np.where(words > 0, hashes, _TAKEN)
    lower = lambda a, b: np.where(weight[b] <= weight[a], b, a)
    selected, best, span = np.zeros(n, np.int64), line, 1
    while len(begin):
        own = (end - begin >= span) & (end - begin < 2 * span)
        selected[begin[own]] = lower(best[begin[own]], best[end[own] - span])
        if span * 2 > (end - begin).max():
            break
        best, span = lower(best, best[np.minimum(line + span, n - 1)]), span * 2
    other = first_end[from_] != to
    begin, end = np.concatenate([begin, from_[other]]), np.concatenate([end, to[other]])
    order = np.argsort(begin, kind="stable")
    return begin[order], end[order], selected[begin[order]]


def fingerprints(words: list[int], hashes: list[int], least: int = MIN_WORDS) -> list[int]:
    """Places of the window minima, in order. Two runs of the same lines with a window in them
    thus select the same line of it."""
    places = windows(np.array(words, np.int64), np.array(hashes, np.uint64), np.array([0, len(words)]), least)[2]
    return np.unique(places).tolist()


def _records(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Each selected line with the windows that selected it, and 128 bits of these windows' lines, from 128 of each."""
    for batch, texts in text_slices(batches):
        split = [[x.strip() for x in text.split(b"\n")] for text in texts]
        bounds = starts([len(x) for x in split])
        digests = b"".join([xxhash.xxh3_128_digest(x) for lines in split for x in lines])
        hashes, others = np.frombuffer(digests, np.uint64).reshape(-1, 2).T
        words = np.array([len(x.split()) for lines in split for x in lines], np.int64)
        begin, end, selected = windows(words, hashes, bounds, least)
        whole = np.stack([span_hashes(hashes, begin, end), span_hashes(others, begin, end)], axis=1)
        first = np.flatnonzero(np.diff(selected, prepend=-1))
        offsets = np.append(first, len(begin))
        doc = np.searchsorted(bounds, selected[first], side="right") - 1
        start = np.repeat(bounds[doc], np.diff(offsets))
        doc_id, text_key = (batch.column(x).take(pa.array(doc)) for x in ("doc_id", "text_key"))
        yield pa.RecordBatch.from_pydict({
            "doc_id": doc_id, "text_key": text_key, "key": signed(hashes[selected[first]]),
            "begins": list_array(pa.array((begin - start).astype(np.int32)), offsets),
            "ends": list_array(pa.array((end - start).astype(np.int32)), offsets),
            "lines": list_array(pa.array(whole.view("V16").ravel().tolist(), pa.binary()), offsets),
        })


def _cleaned(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            out = []
            for ranges, text in zip(batch.column("ranges").to_pylist(), texts):
                lines = text.split(b"\n")
                gone = bytearray(len(lines))
                for x in ranges or []:
                    gone[x["begin"] : x["end"]] = b"\1" * (x["end"] - x["begin"])
                at = 0
                while (begin := gone.find(1, at)) >= 0:
                    at = gone.find(0, begin)
                    at = len(lines) if at < 0 else at
                    if sum(len(x.split()) for x in lines[begin:at]) < least:
                        gone[begin:at] = bytes(at - begin)
                kept = b"\n".join(x for x, g in zip(lines, gone) if not g)
                removed = sum(len(x.split()) for x, g in zip(lines, gone) if g)
                out.append((kept.decode("utf-8", "replace"), len(lines), sum(gone), removed))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "text": pa.array(list(columns[0]), pa.string()),
                **{n: pa.array(list(c), pa.int64()) for n, c in zip(
                    ("n_lines", "removed_lines", "removed_words"), columns[1:])},
            })

    return run


def dedup_lines(docs: DataFrame, work: Workspace, least: int = MIN_WORDS) -> DataFrame:
    """(`doc_id`, `text`, `n_lines`, `removed_lines`, `removed_words`), a row per row of `docs`.

    Lines are compared without white space around them; places are ordered by `doc_id` (null
    last), then line. A run of lines with `least` words or more that is in an earlier place too is
    deleted, whatever other places some of its lines have. Every deleted line has an equal one in
    an earlier place that stays.
    Lines that winnowing selects in one place only are in no such run. Places of the others are joined
    with the first place in the same context, the window's lines as 128 bits tell them, so a line
    of a third of all documents makes no pairs. A match extends both ways over the windows that overlap it
    and are in an earlier place too, up to the run's ends. A null text is empty; rows that agree in `doc_id` and text are one document and get
    the same result; an empty table gives no rows.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    records = work.save(texts.mapInArrow(partial(_records, least=least), _RECORD), "records")
    again = work.save(
        records.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "again"
    )
    found = work.save(
        records.join(again, "key").select(
            "doc_id", "text_key", "key", F.explode(F.arrays_zip("begins", "ends", "lines")).alias("w")
        ).select(
            "doc_id", "text_key", "key", F.col("w.begins").alias("begin"), F.col("w.ends").alias("end"),
            F.col("w.lines").alias("lines"),
        ),
        "windows",
    )
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "begin")
    first = work.save(
        found.groupBy("key", "lines").agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where("n > 1").drop("n"),
        "first",
    )
    later = ~(
        F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("text_key") == F.col("first.text_key")) & (F.col("begin") == F.col("first.begin"))
    )
    ranges = (
        found.join(first, ["key", "lines"]).where(later)
        .select("doc_id", "text_key", F.struct("begin", "end").alias("range"))
        .groupBy("doc_id", "text_key").agg(F.collect_set("range").alias("ranges"))
        .withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    )
    ranges = work.save(ranges, "ranges")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return texts.join(ranges, same, "left").select("doc_id", "text", "ranges").mapInArrow(
        _cleaned(least),
        "doc_id long, text string, n_lines long, removed_lines long, removed_words long",
    )
