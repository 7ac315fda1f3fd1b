"""Mix sources to target weights with quotas from Sainte-Laguë apportionment."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkseek.llm.batches import text_slices, word_spans
from linkseek.llm.keys import distinct_rows, numbered_copies, whole_row_key
from linkseek.operators.ids import number_rows
from linkseek.workspace import Workspace

# Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
# The mix's size as a share of all sizes, and the most it takes of a source.
SHARE = 1.5
MAX_REPEATS = 2
# Words of one block, and documents of one shard of a source on average.
BLOCK_WORDS = 64
SHARD_ROWS = 512


def word_count(text: Column) -> Column:
    r"""Number of `[^\x20\x09-\x0D]+` in the text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(`source`, `source_size`, `source_rows`, `target`) of (`source`, `size`) rows.

    Sources share SHARE of all sizes by weight; none gets more than MAX_REPEATS of its own size,
    and what it can't take is shared again by weight. With sources ordered by size for weight,
    the first one whose share at the level left by its predecessors fits fixes the level.
    The windows hold one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("place")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    everything = Window.partitionBy()
    place = F.row_number().over(by_name)
    weight = reduce(
        lambda other, i: F.when(F.col("place") % len(WEIGHTS) == (i + 1) % len(WEIGHTS), WEIGHTS[i])
        .otherwise(other),
        range(len(WEIGHTS)),
        F.lit(0),
    )
    left = F.sum("source_size").over(everything) * SHARE - F.coalesce(
        F.sum("cap").over(before), F.lit(0)
    )
    others = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.min_by("level", F.when(fits, F.struct(F.col("cap") / F.col("weight"), "place")))
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
        .withColumn("place", place)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(MAX_REPEATS))
        .withColumn("level", left / others)
        .withColumn("final", level.over(everything))
        .select(
            "source", "source_size", "source_rows",
            F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight")).alias("target"),
        )
    )


def apportion(parties: DataFrame, group: list[str], tie: list[str], work: Workspace) -> DataFrame:
    """`parties` with integer `seats`, by highest quotients votes / (2 * seat - 1) in each group.

    `parties` has `votes` and the group's `total` seats. Seats whose quotient lies above the
    group's votes / (total - parties / 2) are sure, none below votes / (total + parties / 2) is
    won; only the few in between are ranked, in one distributed sort. Ties go by `tie`.
    """
    keys = lambda a, b, cols: reduce(
        Column.__and__, (a[c].eqNullSafe(b[c]) for c in cols), F.lit(True)
    )

    def with_sums(rows: DataFrame, name: str, **sums: Column) -> DataFrame:
        """Sums over each group, joined to its rows: no task holds all parties of a large group."""
        own = rows.groupBy(*group).agg(*(x.alias(c) for c, x in sums.items()))
        own = work.save(own, name)
        return rows.join(own, keys(rows, own, group)).select(*(rows[c] for c in rows.columns), *(own[c] for c in sums))

    share = lambda move: F.floor(
        F.when(F.col("_all") > 0, F.col("votes") / F.col("_all")).otherwise(0)
        * F.greatest(F.col("total") + move * F.col("_n") / 2, F.lit(0)) + 0.5
    )
    bounded = with_sums(parties, "votes", _all=F.sum("votes"), _n=F.count("*")).withColumn(
        "_sure", F.greatest(share(-1) - 1, F.lit(0))
    )
    spread = work.save(
        with_sums(bounded, "sure", _sure_all=F.sum("_sure"))
        .withColumn("_most", F.when(F.col("votes") > 0, share(1) + 1).otherwise(0))
        .withColumn("_open", F.col("total") - F.col("_sure_all")),
        "parties",
    )
    contested = spread.where("_most > _sure").select(
        *group, *tie, "votes", "_open", F.explode(F.sequence(F.col("_sure") + 1, "_most")).alias("_seat")
    )
    order = [F.col(c).asc_nulls_last() for c in group]
    ranked = number_rows(
        contested,
        [*order, (F.col("votes") / (2 * F.col("_seat") - 1)).desc(), *tie, F.col("_seat")],
        work, "_place",
    )
    first = work.save(ranked.groupBy(*group).agg(F.min("_place").alias("_first")), "first")
    won = (
        ranked.join(first, keys(ranked, first, group))
        .where(F.col("_place") - F.col("_first") < F.col("_open"))
        .groupBy(*(ranked[c] for c in [*group, *tie]))
        .agg(F.count("*").alias("_won"))
    )
    won = work.save(won, "won")
    return spread.join(won, keys(spread, won, [*group, *tie]), "left").select(
        *(spread[c] for c in parties.columns),
        (spread["_sure"] + F.coalesce(won["_won"], F.lit(0))).alias("seats"),
    )


def _take(seed: int, block: int, carried: list[str], spans: bool):
    def take(shard: pd.DataFrame) -> pd.DataFrame:
        """Words taken of each document of one shard of a source.

        The shard's words, MAX_REPEATS times over in a seeded order of the documents, are cut
        into blocks; as many blocks as the shard has seats are drawn.
        """
        shard = shard.sort_values(["order", "doc_id", "size", *carried], kind="stable")
        sizes = shard["size"].to_numpy(np.int64)
        end = np.cumsum(np.tile(sizes, MAX_REPEATS))
        total = int(end[-1])
        n = -(-total // block)
        key = [seed, int(shard["source_place"].iloc[0]), int(shard["shard"].iloc[0])]
        drawn = np.zeros(n + 1, np.int64)
        seats = int(shard["seats"].iloc[0])
        drawn[np.random.default_rng(key).permutation(total // block)[:seats]] = 1
        if seats > total // block:  # the last words make a short block, drawn after all others
            drawn[total // block : n] = 1
        before = np.concatenate([[0], np.cumsum(drawn * block)])

        def taken_up_to(x):
            return before[x // block] + drawn[x // block] * (x % block)

        if spans:
            # Every stretch of words in which neither the document nor the block changes.
            edges = np.unique(np.concatenate([[0], end, np.minimum(np.arange(n) * block, total)]))
            begin, until = edges[:-1], edges[1:]
            chosen = drawn[begin // block] > 0
            begin, until = begin[chosen], until[chosen]
            of = np.searchsorted(end, begin, side="right")
            first = end - np.tile(sizes, MAX_REPEATS)
            lists = [[] for _ in range(len(shard))]
            for i, a, b in zip(of.tolist(), (begin - first[of]).tolist(), (until - first[of]).tolist()):
                own = lists[i % len(shard)]
                time = i // len(shard)
                if own and own[-1]["time"] == time and own[-1]["end"] == a:
                    own[-1]["end"] = b
                else:
                    own.append({"time": time, "begin": a, "end": b})
            shard["spans"] = lists
        taken = taken_up_to(end) - taken_up_to(end - np.tile(sizes, MAX_REPEATS))
        shard["taken"] = taken.reshape(MAX_REPEATS, -1).sum(axis=0)
        return shard[[*carried, "doc_id", "source", "size", "source_size", "target", "taken",
                      *(["spans"] if spans else [])]]

    return take


def mix_sources(
    docs: DataFrame, work: Workspace, seed: int = 0, block: int = BLOCK_WORDS, spans: bool = False
) -> DataFrame:
    """(`doc_id`, `source`, `size`, `source_size`, `target`, `taken`), a row per document, after
    `row_key` if `docs` has it. Equal rows, however many, are dealt to different shards.

    `docs` has `doc_id`, `source` and `size`. With `spans`, a list of that name says which words
    are taken: the words from `begin` to before `end`, the first or second `time`. Blocks go to sources by Sainte-Laguë's quotients of
    their targets, then to each source's shards by those of their sizes. A source has a shard
    for every SHARD_ROWS documents, so a hot source only has more of them. A null source is a
    source; an empty document takes nothing; the same rows give the same result.
    """
    carried = [c for c in docs.columns if c == "row_key"]
    sized = work.save(numbered_copies(docs.select(*carried, "doc_id", "source", "size")), "sized")
    targets = source_targets(sized)
    targets = work.save(
        targets.withColumn("source_place", F.row_number().over(
            Window.orderBy(F.col("source").asc_nulls_last()))),
        "targets",
    )
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long")
    quota = apportion(
        targets.withColumns({"votes": F.col("target"), "total": blocks, "_all_sources": F.lit(0)}),
        ["_all_sources"], ["source_place"], work,
    )
    quota = work.save(quota.drop("votes", "total", "_all_sources").withColumnRenamed("seats", "total"), "quota")
    shards = F.ceil(F.col("source_rows") / SHARD_ROWS)
    dealt = sized.join(
        quota.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    ).select(
        *carried, "doc_id", "source", "size", "source_size", "target", "source_place", "total",
        F.xxhash64(F.lit(seed), "doc_id", "copy").alias("order"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "size", "copy"), shards).alias("shard"),
    )
    dealt = work.save(dealt, "dealt")
    cells = dealt.groupBy("source_place", "shard").agg(
        F.sum("size").alias("votes"), F.max("total").alias("total")
    )
    seats = work.save(
        apportion(cells, ["source_place"], ["shard"], work).select("source_place", "shard", "seats"),
        "seats",
    )
    return dealt.drop("total").join(seats, ["source_place", "shard"]).groupBy(
        "source_place", "shard"
    ).applyInPandas(
        _take(seed, block, carried, spans),
        ", ".join([
            *(f"{c} string" for c in carried),
            "doc_id long, source string, size long, source_size long, target double, taken long",
            *(["spans array<struct<time:int,begin:long,end:long>>"] if spans else []),
        ]),
    )


def _stretches(text: bytes, spans, begin: np.ndarray, end: np.ndarray, time: int) -> bytes | None:
    """The words of a text that are taken one time: the text itself if all are."""
    own = [(x["begin"], x["end"]) for x in spans or [] if x["time"] == time]
    if not own:
        return None
    if own == [(0, len(begin))]:
        return text
    return b"\n".join(text[begin[x] : end[y - 1]] for x, y in own)


def _taken(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes | None]], np.ndarray]]:
    """Each slice of rows with what is taken of their texts each time, and the texts' sizes."""
    for batch, texts in text_slices(batches):
        begin, end, _, text_start = word_spans(texts)
        first = np.searchsorted(begin, text_start)
        out = []
        for i, (text, spans) in enumerate(zip(texts, batch.column("_spans").to_pylist())):
            b, e = (x[first[i] : first[i + 1]] - text_start[i] for x in (begin, end))
            out.append([_stretches(text, spans, b, e, time) for time in range(MAX_REPEATS)])
        yield batch, out, np.diff(first)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each time that words of a text are taken, holding these words."""
    for batch, taken, _ in _taken(batches):
        rows = [(i, x.decode("utf-8", "replace")) for i, own in enumerate(taken) for x in own if x is not None]
        kept = batch.take(pa.array([i for i, _ in rows], pa.int64())).drop_columns(["_spans"])
        columns = dict(zip(kept.schema.names, kept.columns)) | {"text": pa.array([x for _, x in rows], pa.string())}
        if "n_chars" in columns:
            columns["n_chars"] = pa.array([len(x) for _, x in rows], pa.int64())
        yield pa.RecordBatch.from_pydict(columns)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document: its size, and the words of the texts cut out of it."""
    for batch, taken, size in _taken(batches):
        words = [sum(len(x.split()) for x in own if x is not None) for own in taken]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "size": pa.array(size.astype(np.int64)),
            "source_size": batch.column("source_size"), "target": batch.column("target"),
            "taken": pa.array(words, pa.int64()), "source": batch.column("source"),
        })


def _dealt_texts(docs: DataFrame, work: Workspace, seed: int) -> tuple[DataFrame, DataFrame]:
    """Rows of `docs` as they are, each once, and a row of the mix for each of them, by `_row_key`."""
    keyed = docs.withColumn("_row_key", whole_row_key(docs))
    sizes = keyed.select(
        F.col("_row_key").alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), "source",
        word_count(F.col("text")).alias("size"),
    )
    mixed = mix_sources(sizes, work, seed, spans=True).withColumnRenamed("row_key", "_row_key")
    return distinct_rows(keyed, "_row_key"), work.save(mixed, "mixed")


def mixed_sizes(docs: DataFrame, work: Workspace, seed: int = 0) -> DataFrame:
    """(`doc_id`, `size`, `source_size`, `target`, `taken`, `source`), a row per row of `docs` (`doc_id`,
    `text`, `source`): the mix as its texts have it. `size` and `taken` count words of the text and of
    what was cut out of it. Nulls, empty texts and repeated rows are as in `mix_sources`."""
    rows, mixed = _dealt_texts(docs.select("doc_id", "text", "source"), work, seed)
    placed = mixed.select("_row_key", "source_size", "target", F.col("spans").alias("_spans"))
    return placed.join(rows, "_row_key").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "source", "source_size", "target", "_spans"
    ).mapInArrow(
        _measured, "doc_id long, size long, source_size long, target double, taken long, source string"
    )


def mixed_texts(docs: DataFrame, work: Workspace, seed: int = 0) -> DataFrame:
    """The mix itself, with the columns of `docs` (`doc_id`, `text`, `source` and any others).

    A document has a row for each time that words of it are taken. Texts taken as a whole are as
    they were; of others the taken stretches are put together by new lines, and `n_chars` is
    theirs. A document without words isn't in the mix. Of rows that are equal in all columns each has its
    own place in the mix; their text moves once.
    """
    rows, mixed = _dealt_texts(docs, work, seed)
    spans = mixed.where("taken > 0").select("_row_key", F.col("spans").alias("_spans"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return spans.join(rows, "_row_key").select(*(F.col(f"`{c}`") for c in docs.columns), "_spans").mapInArrow(_cut, fields)
