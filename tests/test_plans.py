import re

import pytest

from linkseek.operators import blocks as O
from linkseek.operators import documents as D
from linkseek.operators import graph as G
from linkseek.operators import index as I
from linkseek.operators import pagerank as P
from linkseek.operators import search as S
from linkseek.operators import tables as K
from linkseek.sources import adapters as A

FOLDER = "/root/testdata/sf0.001"
PYTHON = ("EvalPython", "InPandas", "InArrow")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def docs(spark):
    return A.document_corpus(A.table(spark, FOLDER, "documents"))


@pytest.fixture(scope="module")
def ids(spark, docs):
    return docs.selectExpr("seq AS doc_id", "title", "0.1D AS pr")


@pytest.mark.parametrize("salt_rows", [2, 1_000_000])
def test_edges_stay_in_place(spark, work, no_broadcast, salt_rows):
    graph = G.build_graph(
        A.entity_pages(spark, FOLDER), A.entity_links(spark, FOLDER), work, salt_rows
    )
    keys = P.edge_keys(graph)
    edges = P.salted_edges(graph).repartition(4, *keys).sortWithinPartitions(*keys).persist()
    edges.count()
    text = plan(P.rank_step(P.initial_state(graph), edges, keys, 0.1))
    step = text[: text.index("InMemoryRelation")]
    above = step[step.rindex("SortMergeJoin") :]
    assert "InMemoryTableScan" in above
    assert "Exchange" not in above and "Sort [" not in above
    edges.unpersist()


def test_index_plan(docs, ids, no_broadcast):
    """Texts are counted where they lie: the join of ids moves counts."""
    tf = I.term_frequencies(docs, ids)
    text = plan(I.postings(tf))
    assert not any(p in text for p in PYTHON)
    assert "SinglePartition" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    assert not re.search(r"Exchange.*\n(?!.*partial_count).*raw_text", text)
    assert text.count("partial_count(1)") >= 2


def test_positions_move_lists_not_texts(docs, ids):
    text = plan(I.positional_postings(docs, ids))
    assert not any(p in text for p in PYTHON) and "SinglePartition" not in text and "Window" not in text
    assert text.count("Exchange hashpartitioning") == 1
    below = text[text.index("Exchange hashpartitioning") :]
    assert "partial_collect_list" in below and "Generate inline" in below


def test_search_plan(spark, docs, ids, work):
    tf = work.save(I.term_frequencies(docs, ids), "tf")
    query = spark.createDataFrame([(1, ["the", "of"])], "query_id BIGINT, words ARRAY<STRING>")
    text = plan(S._intersected(query, tf, work, None))
    assert "PushedFilters: [In(word, [of,the])" in text or "In(word, [the,of])" in text
    assert not any(p in text for p in PYTHON) and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    matches = work.save(S.intersect_postings(query, tf, work), "matches")
    top = plan(S.search(query, tf, ids, 10, work))
    assert "WindowGroupLimit" in top and "Partial" in top
    assert "SinglePartition" not in plan(S.score(matches, ids, 10, work))


def test_hot_query_is_cut_before_it_gathers(spark, docs, ids, work, no_broadcast):
    """Without broadcasts too, ranking keeps the best of each task before the exchange."""
    matches = work.save(ids.selectExpr("1L AS query_id", "doc_id", "1L AS tf"), "matches")
    text = plan(S.top_results(S.score(matches, ids, 10, work), 10))
    first, last = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert "Exchange hashpartitioning(query_id" in text[first:last]
    assert "Final" in text[first : first + 200] and "Partial" in text[last : last + 200]


def test_stored_texts_do_not_move(spark, docs, work):
    """Few lines are written over, so they are broadcast against the texts."""
    text = plan(D.latest_documents(docs, work))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_lookup_reaches_the_scan(spark, docs):
    spark.sql("DROP TABLE IF EXISTS bucketed")
    table = K.replace_table(docs.select("title", "raw_text"), "bucketed", "title", buckets=8)
    assert len(table.inputFiles()) == 8
    keys = docs.where("seq < 2").select("title")
    found = K.lookup_many(table, keys, "title", "raw_text")
    assert "PushedFilters: [In(title" in plan(found) and found.count() == 2
    K.drop_table(spark, "bucketed")


def test_blocks_are_chosen_by_their_headers(spark, docs, ids, work):
    blocks = work.save(O.posting_blocks(I.term_frequencies(docs, ids), 16), "blocks")
    query = spark.createDataFrame([(1, ["the", "of"])], "query_id BIGINT, words ARRAY<STRING>")
    sets, _ = S.word_sets(query, work)
    headers = plan(S.word_lists(blocks, S.wanted_words(sets)).select("word", "block", "low", "max_tf"))
    assert "postings" not in headers and "bits" not in headers
    common = O.common_blocks(sets, blocks, work).where("block IN (2, 3)")
    text = plan(O.matches_in(work.save(common, "chosen"), sets, blocks))
    assert "In(block, [2,3])" in text and "In(word, [of,the])" in text.replace("[the,of]", "[of,the]")
    assert "bits" not in text and not any(p in text for p in PYTHON)
