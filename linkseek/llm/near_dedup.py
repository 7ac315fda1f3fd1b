"""Near duplicates by Order MinHash, verified by banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkseek.llm.batches import list_array, mix, signed, span_hashes, starts, text_slices, words
from linkseek.llm.components import grown_components
from linkseek.llm.keys import row_key
from linkseek.workspace import Workspace

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# Sketches of a text, and shingles in each. Texts at the threshold agree in one sketch with a
# probability of about 0.8 ** 5, and in none of the 24 with about 7e-5.
SKETCHES = 24
SKETCH_SHINGLES = 5
# Texts of up to so many shingles also get a key for all of them and for all but each one.
SHORT = 9
# Rounds in which all of a bucket are compared with one of them, and then rounds in which all that begin or
# cease to miss it at one shingle are compared with the one of them that misses least, before the exact rest.
ROUNDS = 3
PART_ROUNDS = 2
# First nodes of its buckets that a node goes with in the latter: those that it misses least of.
FIRSTS = 3
# Shingles that a sketch's first cut keeps on average; texts it leaves too few of go again.
_CUT = 14

_ODD = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64)) | np.uint64(1)
_SALT = mix(np.arange(101, 101 + SKETCHES, dtype=np.uint64))


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles of all texts, in text order, and where each text's start.
    A text of fewer words has one shingle of all its words, an empty one none."""
    word, start = words(texts)
    n = np.diff(start)
    size = np.where(n >= SHINGLE_WORDS, n - SHINGLE_WORDS + 1, np.minimum(n, 1))
    out_start = np.zeros(len(n) + 1, np.int64)
    np.cumsum(size, out=out_start[1:])
    begin = np.repeat(start[:-1] - out_start[:-1], size) + np.arange(out_start[-1])
    return span_hashes(word, begin, begin + np.repeat(np.minimum(n, SHINGLE_WORDS), size)), out_start


def label_occurrences(shingle: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Shingles told apart by how often their text had them before."""
    key = mix(shingle + mix(text.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    new = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] + np.uint64(1)))
    nth = np.arange(len(key)) - np.repeat(new, np.diff(new, append=len(key)))
    out = np.empty_like(shingle)
    out[order] = mix(shingle[order] + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return out


def sketch_keys(shingle: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all texts and where each text's start: of each sketch's smallest labelled
    shingles, put back in text order; short texts get more (SHORT)."""
    n = np.diff(start)
    text = np.repeat(np.arange(len(n)), n)
    labelled = label_occurrences(shingle, text)
    keys, owner = [], []
    limit = np.full(len(n), np.iinfo(np.uint64).max, np.uint64)
    many = n > _CUT
    limit[many] = (2.0**64 * _CUT / n[many]).astype(np.uint64)
    cut = limit[text]
    for sketch in range(SKETCHES):
        h = (labelled ^ _SALT[sketch]) * _ODD[sketch]
        taken = np.flatnonzero(h <= cut)
        few = np.bincount(text[taken], minlength=len(n)) < np.minimum(n, SKETCH_SHINGLES)
        if few.any():
            taken = np.flatnonzero((h <= cut) | few[text])
        order = taken[np.lexsort((h[taken], text[taken]))]
        owners = text[order]
        first = np.searchsorted(owners, np.arange(len(n)))
        least = np.sort(order[np.arange(len(order)) - first[owners] < SKETCH_SHINGLES])
        owners = text[least]
        which, begin = np.unique(owners, return_index=True)
        keys.append(mix(span_hashes(labelled[least], begin, np.append(begin[1:], len(least)))
                        + _SALT[sketch]))
        owner.append(which)
    for t in np.flatnonzero((n > 0) & (n <= SHORT)).tolist():
        own = labelled[start[t] : start[t + 1]]
        rows = [own, *(np.delete(own, i) for i in range(len(own)) if len(own) > 1)]
        keys.append(np.concatenate([span_hashes(r, np.array([0]), np.array([len(r)])) for r in rows]))
        owner.append(np.full(len(rows), t))
    keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    order = np.argsort(owner, kind="stable")
    return keys[order], np.searchsorted(owner[order], np.arange(len(n) + 1))


def text_keys(texts: list[bytes]) -> list[bytes]:
    """128 bits that stand for a text's words, in lower case (A-Z)."""
    return [xxhash.xxh3_128_digest(b" ".join(x.lower().split())) for x in texts]


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether aligned / (all - aligned) shingles reach the similarity in the best alignment.

    What the threshold leaves unaligned bounds how far a pair's places can differ; the
    alignment only looks in that band, a bit per place, a row per shingle of `b`.
    """
    n, m = len(a), len(b)
    need = ceil(similarity * (n + m) / (1 + similarity) - 1e-9)
    if need > min(n, m):
        return False
    shorter = min(n, m)
    differ = np.flatnonzero(a[:shorter] != b[:shorter])
    head = int(differ[0]) if len(differ) else shorter
    rest = shorter - head
    differ = np.flatnonzero(a[n - rest :][::-1] != b[m - rest :][::-1])
    tail = int(differ[0]) if len(differ) else rest
    score = head + tail
    if score >= need:
        return True
    up, down = n - need, m - need
    a, b = a[head : n - tail].tolist(), b[head : m - tail].tolist()
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    base, row, width = 0, 0, 0  # of `row`, a bit per place of `a` from `base`: 0 where the score grows
    for j, x in enumerate(b):
        low, high = max(0, j - down), min(len(a), j + up + 1)
        if low > base:
            gone = min(low - base, width)
            score += gone - (row & ((1 << gone) - 1)).bit_count()
            row, width, base = row >> gone, width - gone, low
        if high - base > width:
            row |= ((1 << (high - base - width)) - 1) << width
            width = high - base
        full = (1 << width) - 1
        hit = row & (at.get(x, 0) >> base) & full
        row = ((row + hit) | (row - hit)) & full
    score += width - row.bit_count()
    return score >= need


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches):
        keys, start = sketch_keys(*shingles(texts))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "row": batch.column("row"),
            "row_key": batch.column("row_key"), "text_key": pa.array(text_keys(texts), pa.binary()), "keys": list_array(signed(keys), start),
        })


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in text_slices(batches):
        shingle, start = shingles(texts)
        short = (shingle >> np.uint64(32)).astype(np.uint32).view(np.int32)
        yield pa.RecordBatch.from_pydict({
            "text_key": pa.array(text_keys(texts), pa.binary()),
            "sequence": list_array(pa.array(short), start),
        })


def _verified(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("_left"), batch.column("_right")
            good = [
                aligned(a.values.to_numpy(), b.values.to_numpy(), similarity)
                for a, b in zip(left, right)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _links(pairs: DataFrame, sequences: DataFrame, similarity: float, work: Workspace) -> DataFrame:
    """Those of the pairs (`a`, `b`) that alignment confirms."""
    side = lambda node, name: sequences.select(
        F.col("node").alias(node), F.col("sequence").alias(name)
    )
    both = pairs.join(side("a", "_left"), "a").join(side("b", "_right"), "b")
    return work.save(
        both.select("a", "b", "_left", "_right").mapInArrow(_verified(similarity), "a long, b long"),
        "verified",
    )


def near_classes(docs: DataFrame, work: Workspace, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of `docs` (`doc_id`, `text`): `doc_id`, `class_id`, `class_size`, `kept`,
    `row_key`.

    A class is what links of the similarity join, over any number of links; its id is its
    smallest `doc_id`, whose row stays. Texts of the same words are one node from the start, so
    that copies make no pairs. Nodes that share a sketch are candidates. A bucket's nodes that are not
    yet in one class are aligned with one of them, drawn anew in each of a few rounds, so that
    large groups of near copies grow together without pairs of all. Further rounds cut the buckets
    that are still mixed by where the others begin and cease to miss the shingles of one node: copies edited
    in the same place are the nearest to each other. Of what is left, pairs that can reach the similarity at all are found
    by prefixes of their rarest shingles and aligned, so no link of candidates is lost.
    A null text is empty; empty texts are one class. Null ids are larger than any. An empty
    table gives no rows.
    """
    texts = docs.select("doc_id", "text")
    signed_rows = work.save(
        texts.withColumns(
            {"row": F.monotonically_increasing_id(), "row_key": row_key(docs["doc_id"], docs["text"])}
        ).mapInArrow(
            _signatures, "doc_id long, row long, row_key string, text_key binary, keys array<long>"
        ),
        "signatures",
    )
    nodes = work.save(
        signed_rows.groupBy("text_key")
        .agg(F.first("keys").alias("keys"), F.min("doc_id").alias("doc_id"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    posted = nodes.select("node", F.explode("keys").alias("key"))
    buckets = work.save(
        posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets",
    )
    members = work.save(posted.join(buckets.select("key"), "key"), "members")
    sequences = _wanted_sequences(texts, nodes, members, work)
    labels = seen = None
    for turn in range(ROUNDS + PART_ROUNDS):
        labelled = _labelled(members, labels, work)
        drawn = F.xxhash64("node", F.lit(turn))
        if turn < ROUNDS:
            pairs = _led_pairs(labelled, drawn, work)
        else:
            parts = _missing_parts(labelled, drawn, sequences, similarity, work)
            pairs = _led_pairs(_labelled(parts, labels, work), F.col("missing"), work)
        pairs = work.save(pairs if seen is None else pairs.join(seen, ["a", "b"], "left_anti"), "pairs")
        seen = pairs if seen is None else seen.union(pairs)
        labels = grown_components(labels, _links(pairs, sequences, similarity, work), work)
    rest = _rest_pairs(_labelled(members, labels, work), sequences, similarity, work)
    rest = work.save(rest.join(seen, ["a", "b"], "left_anti"), "rest")
    labels = grown_components(labels, _links(rest, sequences, similarity, work), work)
    return _classes(signed_rows, nodes, labels, work)


def _wanted_sequences(texts, nodes, members, work) -> DataFrame:
    """(`node`, `sequence`): shingles of the candidates' texts, read again for them alone."""
    wanted = work.save(
        nodes.join(members.select("node").distinct(), "node", "left_semi").select(
            "node", "text_key", F.col("doc_id").alias("_wanted_id")
        ),
        "wanted",
    )
    rows = texts.join(
        wanted.select("_wanted_id"), F.col("doc_id").eqNullSafe(F.col("_wanted_id")), "left_semi"
    )
    found = rows.select("text").mapInArrow(_sequences, "text_key binary, sequence array<int>")
    return work.save(
        found.join(wanted, "text_key").select("node", "sequence").dropDuplicates(["node"]), "sequences"
    )


def _labelled(members: DataFrame, labels: DataFrame | None, work: Workspace) -> DataFrame:
    """`members` (`key`, `node`) with their `label`, of buckets whose nodes are not all of one class yet."""
    if labels is None:
        return members.withColumn("label", F.col("node"))
    label = F.coalesce("label", "node").alias("label")
    rows = work.save(members.join(labels, "node", "left").select(*members.columns, label), "labelled")
    mixed = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = work.save(mixed.where("low < high").select("key"), "mixed")
    return work.save(rows.join(mixed, "key"), "of-mixed")


def _led_pairs(labelled: DataFrame, order: Column, work: Workspace) -> DataFrame:
    """(`a`, `b`): each bucket's node that comes first in the order, with those of other classes."""
    first = F.min(F.struct(order, "node", "label")).alias("first")
    led = labelled.groupBy("key").agg(first).select(
        "key", F.col("first.node").alias("_node"), F.col("first.label").alias("_label")
    )
    led = work.save(led, "led")  # saved, a bucket of very many nodes can be split in the join
    return labelled.join(led, "key").where("label != _label").select(
        F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")
    ).distinct()


def run_edges(gone: np.ndarray) -> np.ndarray:
    """Where the runs of true values begin and end, each place once, in order."""
    edge = np.diff(gone.astype(np.int8), prepend=0, append=0)
    return np.union1d(np.flatnonzero(edge > 0), np.flatnonzero(edge < 0) - 1)


def _missed(similarity: float):
    """How many shingles of the first sequence the second misses, and those at which a run of missed ones
    begins or ends, if it has half of what a link needs. So an edit gives two, however much it replaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            missed, parts = [], []
            for left, right in zip(batch.column("_left"), batch.column("_right")):
                a, b = (_labels(x.values.to_numpy()) for x in (left, right))
                gone = ~np.isin(a, b)
                n = int(gone.sum())
                near = len(a) - n >= similarity / (1 + similarity) / 2 * (len(a) + len(b))
                missed.append(n)
                parts.append(a[run_edges(gone)] if near else a[:0])
            yield pa.RecordBatch.from_pydict({
                "a": batch.column("a"), "node": batch.column("node"), "missing": pa.array(missed, pa.int64()),
                "parts": list_array(signed(np.concatenate([*parts, np.zeros(0, np.uint64)])), starts([len(x) for x in parts])),
            })

    return run


def _missing_parts(
    labelled: DataFrame, order: Column, sequences: DataFrame, similarity: float, work: Workspace
) -> DataFrame:
    """(`key`, `node`, `missing`): buckets of all nodes of a bucket whose missed runs of its first one's shingles
    begin or end at the same one, and how many of its shingles they miss. A node goes with the FIRSTS first
    nodes of its buckets that it misses least of. One of few edits is in few of the new buckets, as is one
    that lacks a long passage."""
    led = labelled.groupBy("key").agg(F.min(F.struct(order, "node")).alias("first"))
    led = work.save(led.select("key", F.col("first.node").alias("a")), "first-nodes")
    side = lambda node, name: sequences.select(
        F.col("node").alias(node), F.col("sequence").alias(name)
    )
    pairs = work.save(labelled.join(led, "key").where("node != a").select("a", "node").distinct(), "with-first")
    missed = (
        pairs.join(side("a", "_left"), "a").join(side("node", "_right"), "node")
        .select("a", "node", "_left", "_right")
        .mapInArrow(_missed(similarity), "a long, node long, missing long, parts array<long>")
    )
    # Nodes that are near to each other are most like the same first ones.
    nth = F.row_number().over(Window.partitionBy("node").orderBy("missing", "a"))
    nearest = missed.where(F.size("parts") > 0).withColumn("nth", nth).where(F.col("nth") <= FIRSTS)
    parts = nearest.select("a", "node", "missing", F.explode("parts").alias("part"))
    members = work.save(parts.select(F.xxhash64("a", "part").alias("key"), "node", "missing"), "parts")
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return members.join(work.save(shared, "shared-parts"), "key")


def _labels(sequence: np.ndarray) -> np.ndarray:
    own = sequence.view(np.uint32).astype(np.uint64)
    return label_occurrences(own, np.zeros(len(own), np.int64))


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The labelled shingles of each sequence, a row each."""
    for batch in batches:
        for node, sequence in zip(batch.column("node").to_pylist(), batch.column("sequence")):
            tokens = _labels(sequence.values.to_numpy())
            yield pa.RecordBatch.from_pydict({
                "node": pa.array([node] * len(tokens), pa.int64()),
                "size": pa.array([len(tokens)] * len(tokens), pa.int64()), "token": signed(tokens),
            })


def _rest_pairs(mixed: DataFrame, sequences: DataFrame, similarity: float, work: Workspace) -> DataFrame:
    """(`a`, `b`): all nodes of mixed buckets and different classes that may reach the similarity.

    With shingles in one order, rare ones first, the first that two texts share leaves room for
    enough others in both. Prefixes that end where that room does are joined by shingle; what
    belongs to a shingle's most common class isn't joined with itself.
    """
    nodes = work.save(mixed.select("node", "label").distinct(), "mixed-nodes")
    tokens = work.save(
        sequences.join(nodes, "node", "left_semi").mapInArrow(_tokens, "node long, size long, token long"),
        "tokens",
    )
    common = work.save(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "common")
    order = Window.partitionBy("node").orderBy("df", "token")
    placed = (
        tokens.join(common, "token").withColumn("_nth", F.row_number().over(order))
        .withColumn("_own", F.count("*").over(Window.partitionBy("node")))
        # Shingles of one node alone come first: they only take places.
        .withColumn("left", F.col("_own") - F.col("_nth") + 1)
        .where(F.col("left") >= F.ceil(F.col("size") * similarity - 1e-9))
        .select("token", "node", "size", "left").join(nodes, "node")
    )
    placed = work.save(placed, "placed")
    classes = work.save(placed.groupBy("token", "label").agg(F.count("*").alias("n")), "token-classes")
    most = work.save(
        classes.groupBy("token").agg(F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("k"))
        .where("k > 1").select("token", F.col("most.label").alias("most")),
        "most",
    )
    here = work.save(placed.join(most, "token"), "here")
    odd = here.where("label != most").select(
        "token", *(F.col(c).alias(f"_{c}") for c in ("node", "size", "left", "label"))
    )
    need = F.ceil((F.col("size") + F.col("_size")) * similarity / (1 + similarity) - 1e-9)
    room = F.least("left", "_left") >= need
    return here.join(
        odd, (here["token"] == odd["token"]) & (F.col("label") != F.col("_label")) & room
    ).select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct()


def _classes(signed_rows, nodes, labels, work) -> DataFrame:
    label = nodes.select("node", "text_key").join(labels, "node", "left").select(
        "text_key", F.coalesce("label", "node").alias("label")
    )
    rows = work.save(
        signed_rows.select("doc_id", "row", "row_key", "text_key").join(work.save(label, "label"), "text_key"),
        "rows",
    )
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least")
    classes = work.save(
        rows.groupBy("label").agg(least, F.count("*").alias("class_size")), "classes"
    )
    return rows.join(classes, "label").select(
        "doc_id", F.col("least.doc_id").alias("class_id"), "class_size",
        (F.col("row") == F.col("least.row")).alias("kept"), "row_key",
    )
