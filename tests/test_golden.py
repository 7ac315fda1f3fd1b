import pytest
from golden import FIRST_TURN, LINES, POSTINGS, RANKS, SEARCHES, TITLES
from pyspark.sql import functions as F

from linkseek.operators import documents as D
from linkseek.operators import index as I
from linkseek.operators import pagerank as P
from linkseek.operators import search as S
from linkseek.operators.graph import build_graph
from linkseek.operators.tables import MissingKeys
from linkseek.plans.build import answer, build, build_stats
from linkseek.sources.files import posting_text
from linkseek.workspace import Workspace


def corpus(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "seq BIGINT, value STRING")


@pytest.fixture(scope="module")
def built(spark):
    work = Workspace(spark)
    return work, *build(corpus(spark, LINES), work)


def test_titles(spark):
    got = D.documents(corpus(spark, LINES)).orderBy("seq").collect()
    assert [r.title for r in got] == TITLES


def test_first_turn(spark, work):
    lines = corpus(spark, LINES)
    graph = build_graph(D.titles(lines), D.link_rows(D.linked_titles(lines)), work)
    run = P.pagerank(graph, work, max_turns=1)
    assert {r.title: round(r.pr, 9) for r in run.ranks.collect()} == FIRST_TURN
    row = run.metrics.first()
    assert round(row.dead_mass, 9) == 0.333333333
    assert round(row.error, 9) == 0.425 and round(row.total_rank, 9) == 1.0


def test_converged_ranks(built):
    _, ranked, _ = built
    got = ranked.ranks.orderBy("doc_id").collect()
    assert [(r.title, round(r.pr, 9)) for r in got] == RANKS
    assert [r.doc_id for r in got] == list(range(6))
    last = ranked.run.metrics.orderBy(F.desc("turn")).first()
    assert ranked.run.turns == last.turn == 10
    assert round(last.error, 9) == 0.000816332 and round(last.dead_mass, 9) == 0.375760875
    assert last.dead_count == 2 and round(last.total_rank, 9) == 1.0


@pytest.mark.parametrize("salt_rows", [1, 2])
def test_salted_sources_give_the_same_ranks(spark, work, salt_rows):
    lines = corpus(spark, LINES)
    graph = build_graph(D.titles(lines), D.link_rows(D.linked_titles(lines)), work, salt_rows=salt_rows)
    assert graph.max_salts == (2 if salt_rows == 1 else 1)
    got = {r.title: round(r.pr, 9) for r in P.pagerank(graph, work).ranks.collect()}
    assert got == dict(RANKS)


def test_repeated_line(spark, work):
    ranked, tables = build(corpus(spark, LINES[:1] + LINES), work)
    assert ranked.graph.n_total == 7 and ranked.n_docs == 6 and ranked.run.turns == 18
    want = {
        "Cherry": 0.196824784, "Banana": 0.149959707, "Apple": 0.115483526, "R&D": 0.095585093,
        "Empty": 0.051642719, "R&amp;D": 0.051642719,
    }
    got = ranked.ranks.orderBy("doc_id").collect()
    assert {r.title: round(r.pr, 9) for r in got} == want
    assert [r.title for r in got] == [t for t, _ in RANKS]
    assert round(sum(r.pr for r in got), 9) == 0.661138549
    red = tables.tf.where("word = 'red'").orderBy("doc_id").collect()
    assert [(r.doc_id, r.tf) for r in red] == [(0, 3), (2, 4), (3, 1), (5, 1)]


def test_postings(built):
    _, _, tables = built
    got = {r.word: r.entries for r in posting_text(I.postings(tables.tf)).collect()}
    assert got == POSTINGS


def test_search(spark, built):
    work, _, tables = built
    queries = spark.createDataFrame(
        list(enumerate(map(list, SEARCHES))), "query_id BIGINT, words ARRAY<STRING>"
    )
    rows = S.search(queries, tables.tf, tables.ranks, tables.n_docs, work).collect()
    for query_id, want in enumerate(SEARCHES.values()):
        got = sorted(
            (r["rank"], r.title, r.tf, round(r.tfidf, 9), round(r.score, 12))
            for r in rows if r.query_id == query_id
        )
        assert got == want
    missing = S.missing_words(queries, tables.tf).collect()
    assert [(r.query_id, r.word) for r in missing] == [(3, "absent")]
    with pytest.raises(MissingKeys):
        S.search(queries, tables.tf, tables.ranks, tables.n_docs, work, strict=True)


def test_answer_and_stats(spark, built):
    work, _, tables = built
    queries = spark.createDataFrame([(0, ["red", "fruit"])], "query_id INT, words ARRAY<STRING>")
    rows = answer(queries, tables, work).orderBy("rank").collect()
    assert rows[0].title == "Cherry"
    # The snippet ends at the unpadded length, one letter early in the padded text.
    assert rows[0].snippets[0] == " fruit red red tre"
    stats = {r.name: r.n for r in build_stats(tables).collect()}
    assert stats == {
        "ranked_documents": len(RANKS), "index_words": len(POSTINGS), "stored_documents": 6,
        "term_rows": sum(len(entries.split(";")) for entries in POSTINGS.values()),
    }
