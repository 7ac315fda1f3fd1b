import random

import pytest
from pyspark.sql import functions as F

from linkseek.operators import blocks as O
from linkseek.operators import search as S
from linkseek.operators.tables import MissingKeys
from linkseek.plans.build import SearchTables, with_blocks

QUERIES = [(1, ["a"]), (2, ["a", "b"]), (3, ["b", "a", "b"]), (4, ["a", "b", "c"]), (5, ["rare", "a"]),
           (6, ["nothing"]), (7, ["a", "nothing"]), (8, ["everywhere"]), (9, ["everywhere", "rare"])]


@pytest.fixture(scope="module")
def corpus():
    """(word, doc_id, tf) and ranks that don't follow the ids everywhere; some ranks are equal."""
    rng = random.Random(3)
    n = 500
    share = {"a": 0.8, "b": 0.5, "c": 0.1, "rare": 0.01, "everywhere": 1}
    tf = [(w, d, rng.choice([1, 1, 1, 2, 5])) for w, s in share.items() for d in range(n) if rng.random() <= s]
    ranks = [(d, f"T{d:03d}", round(rng.random() / (1 + d // 20), 3)) for d in range(n)]
    return tf, ranks


@pytest.fixture(scope="module")
def frames(spark, corpus):
    tf, ranks = corpus
    return (spark.createDataFrame(tf, "word string, doc_id long, tf long"),
            spark.createDataFrame(ranks, "doc_id long, title string, pr double"),
            spark.createDataFrame(QUERIES, "query_id int, words array<string>"))


def rows(df):
    return sorted((r.query_id, r["rank"], r.title, round(r.score, 12), r.df, r.tf) for r in df.collect())


@pytest.mark.parametrize("block,k", [(1, 3), (7, 10), (64, 10), (O.BLOCK, 10), (16, 1000)])
def test_same_results_as_the_term_rows(frames, work, block, k):
    tf, ranks, queries = frames
    tables = with_blocks(SearchTables(ranks, tf, None, 500, None), work, block)
    got = O.search_blocks(queries, tables.blocks, ranks, tables.block_ranks, 500, work, k)
    assert rows(got) == rows(S.search(queries, tf, ranks, 500, work, k))


def test_headers(frames, corpus):
    tf, _ = corpus
    got = {(r.word, r.block): r for r in O.posting_blocks(frames[0], 64).collect()}
    for word, block in got:
        own = sorted((d, n) for w, d, n in tf if w == word and d // 64 == block)
        row = got[word, block]
        assert (row.n, row.low, row.high, row.max_tf) == (len(own), own[0][0], own[-1][0], max(n for _, n in own))
        assert [tuple(p) for p in row.postings] == own
        assert [i for i in range(64) if row.bits[i // 8] >> (i % 8) & 1] == [d % 64 for d, _ in own]
    assert sum(r.n for r in got.values()) == len(tf)


def test_most_blocks_stay_unread(spark, work):
    """With ids in rank order, the first blocks of frequent words hold the best results."""
    n = 5000
    ranks = spark.range(n).selectExpr("id AS doc_id", "format_string('T%05d', id) AS title", "1D / (id + 1) AS pr")
    tf = spark.range(n).where("id % 7 <> 3").selectExpr("explode(array('the', 'of')) AS word", "id AS doc_id",
                                                        "1 + id % 3 AS tf")
    tables = with_blocks(SearchTables(ranks, tf, None, n, None), work, 50)
    queries = spark.createDataFrame([(1, ["the", "of"])], "query_id int, words array<string>")
    sets, _ = S.word_sets(queries, work)
    bounded = O.bounded_blocks(O.common_blocks(sets, tables.blocks, work), tables.block_ranks, n, work)
    assert bounded.count() == 100 and bounded.agg(F.max("df")).first()[0] == tf.where("word = 'of'").count()
    first = bounded.where(F.col("before") < 10)
    best = O.matches_in(first, sets, tables.blocks)
    sizes = bounded.groupBy("query_id").agg(F.max("df").alias("df"))
    more = O.further_blocks(bounded, best, ranks, sizes, n, 10)
    assert first.count() + more.count() <= 5
    got = O.search_blocks(queries, tables.blocks, ranks, tables.block_ranks, n, work)
    assert rows(got) == rows(S.search(queries, tf, ranks, n, work))


def test_strict_and_no_rows(spark, frames, work):
    tf, ranks, queries = frames
    tables = with_blocks(SearchTables(ranks, tf, None, 500, None), work, 64)
    with pytest.raises(MissingKeys):
        O.search_blocks(queries, tables.blocks, ranks, tables.block_ranks, 500, work, strict=True)
    none = queries.where("query_id = 6")
    assert O.search_blocks(none, tables.blocks, ranks, tables.block_ranks, 500, work).collect() == []
    empty = with_blocks(SearchTables(ranks.limit(0), tf.limit(0), None, 0, None), work)
    assert O.search_blocks(queries, empty.blocks, ranks.limit(0), empty.block_ranks, 0, work).collect() == []
