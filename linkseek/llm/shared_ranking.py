"""Ranked lexical search for many items at once, along a graph of the term sets they share."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkseek.llm.batches import list_array, signed, text_slices, words
from linkseek.workspace import Workspace

TOP = 20
# Terms of items that tasks get to keep only these in documents; of more items all terms are kept.
BROADCAST_TERMS = 1 << 20
# Terms of the items ranked in one pass over the documents, about.
CHUNK_TERMS = 1 << 16
# Accumulators of 8 bytes that one task holds at a time.
CELLS = 1 << 23

# Bytes between terms: ASCII other than letters and digits.
_GAP = np.ones(256, bool)
_GAP[128:] = False
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = False

LEAF, SHARED, ITEM = 0, 1, 2


def _counted(texts: list[bytes], wanted: np.ndarray | None = None):
    """Of each text: the number of its terms, its distinct terms (of the sorted `wanted`, their places)
    and how often it has them, and where each text's start."""
    term, start = words(texts, gap=_GAP)
    text = np.repeat(np.arange(len(texts)), np.diff(start))
    term = term.view(np.int64)
    if wanted is not None:
        at = np.minimum(np.searchsorted(wanted, term), max(len(wanted) - 1, 0))
        known = wanted[at] == term if len(wanted) else np.zeros(len(term), bool)
        term, text = at[known], text[known]
    order = np.lexsort((term, text))
    term, text = term[order], text[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return (
        np.diff(start), term[first].astype(np.int64), np.diff(first, append=len(term)).astype(np.int64),
        np.searchsorted(text[first], np.arange(len(texts) + 1)),
    )


def _postings(wanted: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            n, term, times, start = _counted(texts, wanted)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "n": pa.array(n.astype(np.int64)),
                "terms": list_array(signed(term), start), "times": list_array(signed(times), start),
            })

    return run


def shared_sets(lists: dict[int, list[int]], fresh: int) -> dict[int, tuple[int, int]]:
    """Sets of nodes that several of the `lists` share, as new nodes of two parts each, numbered from
    `fresh`; the lists then hold these instead.

    Lists keep their nodes in order of how many have them, so that common ones are neighbours.
    In each round neighbours that two lists or more have become one node, those that most
    have first; this ends when no two lists have the same neighbours.
    """
    made: dict[int, tuple[int, int]] = {}
    while True:
        having = Counter(x for nodes in lists.values() for x in set(nodes))
        for nodes in lists.values():
            nodes.sort(key=lambda x: (-having[x], x))
        pairs = Counter(p for nodes in lists.values() for p in set(zip(nodes, nodes[1:])))
        common = {p: n for p, n in pairs.items() if n > 1}
        if not common:
            return made
        ranked = {p: i for i, p in enumerate(sorted(common, key=lambda p: (-common[p], p)))}
        joined: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for item, nodes in lists.items():
            taken: set[int] = set()
            for _, at in sorted((ranked[p], i) for i, p in enumerate(zip(nodes, nodes[1:])) if p in ranked):
                if at not in taken and at + 1 not in taken:
                    taken |= {at, at + 1}
                    joined.setdefault((nodes[at], nodes[at + 1]), []).append((item, at))
        gone: dict[int, set[int]] = {}
        useful = {p: places for p, places in joined.items() if len({i for i, _ in places}) > 1}
        if not useful:
            return made
        for pair, places in useful.items():
            made[fresh] = pair
            for item, at in places:
                lists[item][at] = fresh
                gone.setdefault(item, set()).add(at + 1)
            fresh += 1
        for item, places in gone.items():
            lists[item] = [x for i, x in enumerate(lists[item]) if i not in places]


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    """The sharing graph of one chunk's items: its terms, what they share, and each item's parts."""
    chunk = int(rows["chunk"].iloc[0])
    terms = rows.drop_duplicates("term").sort_values("term")
    leaf = {t: i for i, t in enumerate(terms["term"].tolist())}
    lists: dict[int, list[int]] = {}
    for item, term, times in zip(rows["item"].tolist(), rows["term"].tolist(), rows["times"].tolist()):
        lists.setdefault(item, []).extend([leaf[term]] * times)
    shared = shared_sets(lists, len(leaf))
    out = [(chunk, LEAF, t, int(w), None) for t, w in zip(terms["term"].tolist(), terms["weight"].tolist())]
    out += [(chunk, SHARED, node, None, list(parts)) for node, parts in shared.items()]
    out += [(chunk, ITEM, item, None, nodes) for item, nodes in lists.items()]
    return pd.DataFrame(out, columns=["chunk", "kind", "number", "weight", "parts"]).astype({"weight": "Int64"})


class Plan:
    """A chunk's graph: leaves by term, shared nodes in the order they were made, items."""

    def __init__(self, rows):
        leaves = sorted((r["number"], r["weight"]) for r in rows if r["kind"] == LEAF)
        self.terms = np.array([t for t, _ in leaves], np.int64)
        self.weights = np.array([w for _, w in leaves], np.int64)
        self.shared = sorted((r["number"], *r["parts"]) for r in rows if r["kind"] == SHARED)
        self.items = [(r["number"], np.array(r["parts"])) for r in rows if r["kind"] == ITEM]

    def scores(self, doc: np.ndarray, term: np.ndarray, times: np.ndarray, length: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each item with its scores of some documents, of which `doc`, `term` and `times` are the
        terms and `length` their m. Accumulators of shared nodes are filled once for all items."""
        at = np.minimum(np.searchsorted(self.terms, term), max(len(self.terms) - 1, 0))
        known = self.terms[at] == term if len(self.terms) else np.zeros(len(term), bool)
        doc, at, times = doc[known], at[known], times[known]
        held = np.zeros((len(self.terms) + len(self.shared), len(length)), np.int64)
        held[at, doc] = self.weights[at] * (1_000_000_000 * times // (1000 * times + 12 * length[doc]))
        for node, left, right in self.shared:
            np.add(held[left], held[right], out=held[node])
        for item, parts in self.items:
            yield item, held[parts].sum(axis=0)


def _ranked(plan: Plan, n_docs: int, n_terms: int, top: int):
    width = max(1, CELLS // max(1, len(plan.terms) + len(plan.shared)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for at in range(0, len(batch), width):
                part = batch.slice(at, width)
                ids = part.column("id")
                none = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                n = part.column("n").to_numpy()
                terms = part.column("terms")
                doc = np.repeat(np.arange(len(part)), terms.value_lengths().to_numpy())
                length = 100 - 25 + 25 * n * n_docs // max(n_terms, 1)
                for item, score in plan.scores(
                    doc, terms.flatten().to_numpy(), part.column("times").flatten().to_numpy(), length
                ):
                    least = best[item][0][-1] if item in best and len(best[item][0]) == top else 1
                    found = np.flatnonzero(score >= least)
                    if len(found) > top:
                        found = found[score[found] >= np.partition(score[found], -top)[-top]]
                    if len(found):
                        new = score[found], none[found], ids[found]
                        if item in best:
                            new = tuple(np.concatenate(x) for x in zip(best[item], new))
                        order = np.lexsort((new[2], new[1], -new[0]))[:top]
                        best[item] = tuple(x[order] for x in new)
        for item, (score, none, ids) in best.items():
            yield pa.RecordBatch.from_pydict({
                "item": pa.array([item] * len(score), pa.int64()),
                "doc_id": pa.array(ids, pa.int64(), mask=none), "score": pa.array(score),
            })

    return run


def rank_items(docs: DataFrame, items: DataFrame, work: Workspace, top: int = TOP) -> DataFrame:
    """(`item_id`, `rank`, `doc_id`, `score`): for each of `items` (`item_id`, `text`) its `top`
    documents of `docs` (`doc_id`, `text`) with the highest scores above 0, equal ones by `doc_id`.

    Terms are runs of ASCII letters and digits and of all characters past ASCII, A-Z lower-cased, told
    apart by 64 bits of hash. A document's score is the sum over the item's terms, repeats
    included, of weight * (10^9 tf div (1000 tf + 12 m)), in integers; m grows with its length.
    Documents' terms are counted once. Items are dealt into chunks of bounded size; of each, term
    sets that several items share are mined and become nodes of a graph. Each task fills the
    accumulators of its documents for every node once, adds up items from them and keeps the best
    of all that it reads. Documents meet no other document, so none is hot.
    A null text has no terms, an item without terms no rows. Null ids come after all others. Each
    row of `docs` is a document; rows of `items` that agree in both columns are one item. No
    documents or no items give no rows.
    """
    asked = work.save(
        items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
        .distinct().withColumn("id", F.monotonically_increasing_id()), "items",
    )
    columns = "id long, n long, terms array<long>, times array<long>"
    item_terms = work.save(
        asked.select("id", "text").mapInArrow(_postings(None), columns)
        .select(F.col("id").alias("item"), F.explode(F.arrays_zip("terms", "times")).alias("t"))
        .select("item", F.col("t.terms").alias("hash"), "t.times"),
        "item-terms",
    )
    distinct = work.save(item_terms.select("hash").distinct(), "terms")
    wanted = None
    if distinct.count() <= BROADCAST_TERMS:
        wanted = np.sort(np.array([r["hash"] for r in distinct.collect()], np.int64))
        terms = work.spark.createDataFrame(
            pd.DataFrame({"hash": wanted, "term": np.arange(len(wanted))}), "hash long, term long"
        )
    else:
        terms = distinct.select("hash", F.col("hash").alias("term"))
    postings = work.save(
        docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(_postings(wanted), columns),
        "postings",
    )
    sizes = postings.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    share = F.lit(2 * sizes["docs"] + 2).cast("double") / (2 * F.col("df") + 1)
    weights = df.join(terms, "term").select("term", "hash", F.floor(1000 * F.log(share)).alias("weight"))
    rows = item_terms.join(weights.where("weight > 0"), "hash").select("item", "term", "times", "weight")
    rows = work.save(rows, "weighted")
    chunks = max(1, -(-rows.count() // CHUNK_TERMS))
    plans = work.save(
        rows.withColumn("chunk", F.pmod(F.xxhash64("item"), F.lit(chunks))).groupBy("chunk").applyInPandas(
            _plan, "chunk long, kind int, number long, weight long, parts array<long>"
        ),
        "plans",
    )
    found = [
        postings.mapInArrow(
            _ranked(Plan(plans.where(F.col("chunk") == chunk).collect()), sizes["docs"], sizes["terms"], top),
            "item long, doc_id long, score long",
        )
        for chunk in range(chunks)
    ]
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= top).join(
        asked.select(F.col("id").alias("item"), "item_id"), "item"
    ).select("item_id", "rank", "doc_id", "score")
