import re
from collections import Counter
from functools import reduce

import pytest

from linkseek.operators import ids as N
from linkseek.operators import index as I
from linkseek.operators import search as S
from linkseek.operators import tables as K
from pyspark.sql import functions as F

DOCS = [
    "red fruit red tree", "red red red", "fruit Fruit apple", "the red apple of the tree",
    "the the the of of", "of the", "", "x1y2z", "tree,tree;tree red.fruit", "the of red fruit",
]
QUERIES = [
    ["red"], ["red", "fruit"], ["the", "of"], ["the", "the", "of"], ["tree", "red", "fruit"],
    ["nothing"], ["red", "nothing"], ["apple", "Fruit"], ["x", "y", "z"], ["Red"],
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [(i, f"T{i}", text) for i, text in enumerate(DOCS)],
        "seq BIGINT, title STRING, raw_text STRING",
    )


@pytest.fixture(scope="module")
def ids(spark):
    return spark.createDataFrame(
        [(i, f"T{i}", 0.1) for i in range(len(DOCS))], "doc_id BIGINT, title STRING, pr DOUBLE"
    )


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(list(enumerate(QUERIES)), "query_id BIGINT, words ARRAY<STRING>")


COUNTS = [Counter(re.findall("[a-zA-Z]+", text)) for text in DOCS]


def matches_by_hand():
    return {
        (q, d): min(counts[w] for w in words)
        for q, words in enumerate(QUERIES)
        for d, counts in enumerate(COUNTS) if all(counts[w] for w in words)
    }


def test_term_frequencies(docs, ids):
    tf = I.term_frequencies(docs, ids)
    got = {(r.word, r.doc_id): r.tf for r in tf.collect()}
    assert got == {(w, d): n for d, counts in enumerate(COUNTS) for w, n in counts.items()}
    df = {r.word: r.df for r in I.document_frequencies(tf).collect()}
    assert df == Counter(w for counts in COUNTS for w in counts)
    lower = {(r.word, r.doc_id): r.tf for r in I.term_frequencies(docs, ids, lower=True).collect()}
    assert lower[("fruit", 2)] == 2 and ("Fruit", 2) not in lower


def test_positions(docs, ids):
    got = {(r.seq, r.word): r.positions for r in I.positional_postings(docs, ids).collect()}
    want = {}
    for d, text in enumerate(DOCS):
        for m in re.finditer("[a-zA-Z]+", text):
            want.setdefault((d, m.group()), []).append(m.start())
    assert got == want


def test_unknown_title(docs, ids):
    fewer = ids.where("doc_id <> 3")
    with pytest.raises(Exception, match="no id for title T3"):
        I.term_frequencies(docs, fewer).collect()
    got = I.term_frequencies(docs, fewer, strict=False).select("doc_id").distinct().collect()
    assert 3 not in {r.doc_id for r in got}
    assert [r.title for r in N.titles_without_id(docs, fewer).collect()] == ["T3"]
    assert [r.doc_id for r in N.ids_without_title(ids, fewer).collect()] == [3]


@pytest.mark.parametrize("broadcast_checks", [200_000, 0])
@pytest.mark.parametrize("literal_keys", [1000, 0])
def test_intersection(docs, ids, queries, work, monkeypatch, literal_keys, broadcast_checks):
    """Pruned scan or join, broadcast or exchange: the documents are the same."""
    monkeypatch.setattr(K, "MAX_LITERAL_KEYS", literal_keys)
    monkeypatch.setattr(S, "MAX_BROADCAST_CHECKS", broadcast_checks)
    tf = work.save(I.term_frequencies(docs, ids), "tf")
    got = {(r.query_id, r.doc_id): r.tf for r in S.intersect_postings(queries, tf, work).collect()}
    assert got == matches_by_hand()
    missing = {(r.query_id, r.word) for r in S.missing_words(queries, tf).collect()}
    known = set().union(*COUNTS)
    assert missing == {(q, w) for q, ws in enumerate(QUERIES) for w in ws if w not in known}


def test_intersection_equals_chained_intersect(docs, ids, queries, work):
    tf = work.save(I.term_frequencies(docs, ids), "tf")
    got = S.intersect_postings(queries, tf, work).where("query_id = 4").select("doc_id")
    lists = [tf.where(F.col("word") == w).select("doc_id") for w in QUERIES[4]]
    chained = reduce(lambda a, b: a.intersect(b), lists)
    assert sorted(got.collect()) == sorted(chained.collect())
    removed = S.removed_documents(lists[0], lists[1]).collect()
    assert {r.doc_id for r in removed} == {
        d for d, c in enumerate(COUNTS) if c["tree"] and not c["red"]
    }


def test_scores_and_top_k(docs, ids, queries, work):
    import math

    tf = work.save(I.term_frequencies(docs, ids), "tf")
    got = S.search(queries, tf, ids, len(DOCS), work, k=2).collect()
    hits = matches_by_hand()
    sizes = Counter(q for q, _ in hits)
    want = []
    for q in sizes:
        scored = sorted(
            (-0.1 * (n * math.log10(len(DOCS) / sizes[q])) ** 2, f"T{d}")
            for (p, d), n in hits.items() if p == q
        )
        want += [(q, i + 1, t, round(-s, 9)) for i, (s, t) in enumerate(scored[:2])]
    assert sorted((r.query_id, r["rank"], r.title, round(r.score, 9)) for r in got) == sorted(want)


def test_words_of_every_document_score_zero(spark, work):
    """Such results sort by title."""
    tf = spark.createDataFrame(
        [("w", i, 5 - i) for i in range(3)], "word STRING, doc_id BIGINT, tf BIGINT"
    )
    ranks = spark.createDataFrame(
        [(0, "C", 0.5), (1, "A", 0.3), (2, "B", 0.2)], "doc_id BIGINT, title STRING, pr DOUBLE"
    )
    query = spark.createDataFrame([(1, ["w"])], "query_id BIGINT, words ARRAY<STRING>")
    got = S.search(query, tf, ranks, 3, work).orderBy("rank").collect()
    assert [(r.title, r.score) for r in got] == [("A", 0.0), ("B", 0.0), ("C", 0.0)]


def test_query_words_keep_order_and_repeats(queries):
    got = S.query_words(queries).where("query_id = 3").orderBy("ord").collect()
    assert [r.word for r in got] == QUERIES[3]


def test_word_of_nearly_every_document(spark, work):
    """However little a query's words weigh, the best ranked come first."""
    n = 1000
    ranks = spark.range(n).selectExpr(
        "id as doc_id", "format_string('T%05d', id) as title", f"(0.8 + 0.4 * id / {n}) / {n} as pr")
    tf = ranks.where("doc_id > 0").selectExpr("'w' as word", "doc_id", "1L as tf")
    queries = spark.createDataFrame([(1, ["w"]), (2, ["w", "w"])], "query_id int, words array<string>")
    found = S.search(queries, tf, ranks, n, work).collect()
    assert len(found) == 20
    assert {(r.rank, r.title) for r in found} == {(i + 1, f"T{n - 1 - i:05d}") for i in range(10)}


def test_word_of_every_document(spark, work):
    """All scores are zero: titles decide."""
    ranks = spark.range(30).selectExpr(
        "id as doc_id", "format_string('T%05d', id) as title", "(1 + id) / 465 as pr")
    tf = ranks.selectExpr("'w' as word", "doc_id", "1L as tf")
    queries = spark.createDataFrame([(1, ["w"])], "query_id int, words array<string>")
    found = sorted(S.search(queries, tf, ranks, 30, work).collect(), key=lambda r: r.rank)
    assert [r.title for r in found] == [f"T{i:05d}" for i in range(10)]


def test_missing_text_raises(spark):
    results = spark.createDataFrame([("A",), ("B",)], "title string")
    texts = spark.createDataFrame([("A", "x")], "title string, text string")
    with pytest.raises(Exception, match="no stored text for title B"):
        S.with_texts(results, texts).collect()
