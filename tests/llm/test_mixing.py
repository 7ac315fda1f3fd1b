from collections import Counter, defaultdict

import pytest
from samples import FOLDER, ODD_ROWS
from pyspark.sql import functions as F

from linkseek.llm.mixing import (
    MAX_REPEATS, SHARE, WEIGHTS, apportion, mix_sources, mixed_sizes, mixed_texts, word_count,
)
from linkseek.llm.queries import QUERIES


def targets(sizes):
    """Shares by weight, the excess over the bound shared again until there is none."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: [ord(c) for c in s])
    names += [None] * (None in sizes)
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
    left, open_, out = SHARE * sum(sizes.values()), set(names), {}
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * weight[s] > MAX_REPEATS * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = float(MAX_REPEATS * sizes[s])
            left -= out[s]
        open_ -= over


def seats(votes, total):
    quotients = sorted(((-v / (2 * k + 1), p) for p, v in votes.items() for k in range(total)))
    return Counter(p for _, p in quotients[:total])


@pytest.mark.parametrize("votes,total", [
    ([53, 24, 23], 7), ([100, 80, 30, 20], 8), ([1, 1, 1], 2), ([10**9, 1, 1], 50), ([5, 0, 7], 30),
    ([7, 7, 7, 7], 9), ([3], 4), ([100_000, *range(1, 40)], 60),
])
def test_apportionment(spark, work, votes, total):
    parties = spark.createDataFrame(
        [(g, p, v, total) for g in ("a", None) for p, v in enumerate(votes)],
        "g string, p int, votes long, total long")
    got = defaultdict(dict)
    for r in apportion(parties, ["g"], ["p"], work).collect():
        got[r.g][r.p] = r.seats
    want = {p: seats(dict(enumerate(votes)), total)[p] for p in range(len(votes))}
    assert got == {"a": want, None: want}


def check(rows, tolerance=128):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= MAX_REPEATS * r.size
    want = targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= tolerance
    assert all(r.source_size == sizes[r.source] for r in rows)


def test_query(spark):
    rows = QUERIES["op7_mixing"](spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    import re

    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs}
    assert {r.doc_id: r.size for r in rows} == words and len(rows) == len(docs)
    check(rows)
    again = QUERIES["op7_mixing"](spark, FOLDER).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in again}


def test_odd_documents(odd, no_rows, work):
    sized = odd.withColumn("size", word_count(F.col("text")))
    rows = mix_sources(sized, work).collect()
    assert len(rows) == len(ODD_ROWS)
    check(rows)
    assert mix_sources(no_rows, work).collect() == []


def test_hot_source(spark, work):
    """A source of many shards, and small ones; a seed gives its own mix."""
    docs = spark.range(4000).selectExpr(
        "id as doc_id", "if(id % 3 = 0, 'hot', concat('s', cast(id % 40 as string))) as source",
        "id % 97 as size")
    rows = mix_sources(docs, work, seed=1).collect()
    check(rows, tolerance=200)
    other = mix_sources(docs, work, seed=2).collect()
    assert {(r.doc_id, r.taken) for r in rows} != {(r.doc_id, r.taken) for r in other}


def test_copies(spark, work):
    """Rows that are equal, a third of all, share a source's blocks; the result depends on rows alone."""
    docs = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 0, id) AS doc_id", "if(id % 3 = 0, 'a b c d e f g', repeat('w ', cast(id % 50 as int))) AS text",
        "if(id % 3 = 0, 's', concat('t', id % 5)) AS source", "id % 2 AS other")
    rows = mixed_sizes(docs, work).collect()
    check(rows, tolerance=200)
    assert len(rows) == 3000 and sum(r.source == "s" for r in rows) == 1000
    again = mixed_sizes(docs.repartition(5), work).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    got = Counter(r.source for r in mixed_texts(docs, work).collect() for _ in r.text.split())
    assert all(abs(got[s] - sum(r.taken for r in rows if r.source == s)) <= 128 for s in got)


def test_texts_hold_the_words_taken(odd, no_rows, work):
    docs = odd.drop("row", "size", "keys")
    sized = docs.withColumn("size", word_count(F.col("text")))
    taken = defaultdict(int)
    for r in mix_sources(sized, work).collect():
        taken[r.source] += r.taken
    mixed = mixed_texts(docs, work)
    assert mixed.schema.names == docs.schema.names
    got = defaultdict(int)
    for r in mixed.collect():
        got[r.source] += len(r.text.encode().split())
        assert r.n_chars == len(r.text)
    # Shards are dealt by other keys here, so blocks differ, but not what sources get.
    assert all(abs(got[s] - taken[s]) <= 128 for s in taken)
    assert mixed_texts(no_rows, work).collect() == []
