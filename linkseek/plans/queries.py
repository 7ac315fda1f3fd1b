"""The registered queries: each operator over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkseek.functions import text as T
from linkseek.functions.scoring import teleport
from linkseek.operators import blocks as O
from linkseek.operators import documents as D
from linkseek.operators import graph as G
from linkseek.operators import ids as N
from linkseek.operators import index as I
from linkseek.operators import pagerank as P
from linkseek.operators import search as S
from linkseek.operators import snippets as X
from linkseek.operators import tables as K
from linkseek.plans import build as B
from linkseek.sources import adapters as A
from linkseek.sources import files as L
from linkseek.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

# Word lists asked of the corpora, in query order.
WORD_LISTS = [
    ["the", "of"],
    ["de", "la"],
    ["the"],
    ["que", "la", "en"],
    ["der", "die"],
    ["of", "the", "of", "and"],
    ["amp"],
    ["the", "noSuchWord"],
]

QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return A.page_lines(A.table(spark, folder, "pages"))


def _named_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages under the names by which links know them."""
    return A.page_lines(A.table(spark, folder, "pages"), named=True)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return A.document_corpus(A.table(spark, folder, "documents"))


def _page_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    linked = D.linked_titles(_named_pages(spark, folder))
    linked = Workspace(spark).save(linked.select("title", "links"), "linked")
    return linked.select("title"), D.link_rows(linked)


def _page_edges(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    pages, links = _page_graph(spark, folder)
    return pages, G.link_edges(links, pages)


def _ranked_pages(spark: SparkSession, folder: str, work: Workspace) -> B.RankedCorpus:
    return B.rank_corpus(_named_pages(spark, folder), work)


def _page_tables(spark: SparkSession, folder: str, work: Workspace) -> B.SearchTables:
    """Pages under their whole titles, each with the rank of the name that links know it by."""
    pages = work.save(A.page_documents(A.table(spark, folder, "pages")), "pages")
    linked = pages.select(F.col("name").alias("title"), "links")
    ranks = B.rank_links(linked.select("title"), D.link_rows(linked), work).ranks
    named = pages.select("title", "name").distinct().join(ranks.withColumnRenamed("title", "name"), "name")
    ranked = work.save(named.groupBy("title").agg(F.max("pr").alias("pr")), "ranked")
    n_docs = ranked.count()
    docs = pages.select("seq", "title", "raw_text")
    return B.index_corpus(docs, N.rank_table(ranked, n_docs, work), n_docs, work)


def _document_ranks(spark: SparkSession, folder: str, work: Workspace) -> DataFrame:
    """Rank table of the documents: without links all share one rank and sort by title."""
    docs = A.document_corpus(A.table(spark, folder, "documents"))
    n_docs = docs.count()
    return N.rank_table(
        docs.select("title", (F.lit(1.0) / F.lit(n_docs)).alias("pr")), n_docs, work
    )


def _document_tf(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    return I.term_frequencies(docs, _document_ranks(spark, folder, Workspace(spark)))


def _word_list_queries(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, words) for i, words in enumerate(WORD_LISTS)]
    return spark.createDataFrame(rows, "query_id BIGINT, words ARRAY<STRING>")


def _passage_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark passage as a query for all of its words."""
    return A.table(spark, folder, "benchmark").select(
        F.col("item_id").cast("bigint").alias("query_id"), T.words(F.col("text")).alias("words")
    )


def _scores(df: DataFrame) -> DataFrame:
    return df.select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "title",
        F.round("score", 12).alias("score"), F.round("pr", 12).alias("pr"),
        F.round("tfidf", 9).alias("tfidf"),
    )


@registered
def corpus_titles(spark: SparkSession, folder: str) -> DataFrame:
    return D.titles(_pages(spark, folder)).select("seq", "title")


@registered
def corpus_text(spark: SparkSession, folder: str) -> DataFrame:
    docs = D.documents(A.document_lines(A.table(spark, folder, "documents")))
    return docs.select("seq", "title", T.decode_entities(F.col("raw_text")).alias("text"))


@registered
def page_text(spark: SparkSession, folder: str) -> DataFrame:
    return D.documents(_pages(spark, folder)).select("seq", "title", "raw_text")


@registered
def corpus_stats(spark: SparkSession, folder: str) -> DataFrame:
    pages = D.documents(_pages(spark, folder)).withColumn("corpus", F.lit("pages"))
    docs = D.documents(A.document_lines(A.table(spark, folder, "documents")))
    return (
        pages.unionByName(docs.withColumn("corpus", F.lit("documents")))
        .groupBy("corpus")
        .agg(
            F.count("*").alias("n_lines"),
            F.count_distinct("title").alias("n_titles"),
            F.sum(F.length(T.decode_entities(F.col("raw_text")))).alias("n_chars"),
            F.count_if(F.col("raw_text") == "").alias("n_empty"),
        )
    )


@registered
def repeated_titles(spark: SparkSession, folder: str) -> DataFrame:
    return D.repeated_titles(D.titles(_pages(spark, folder)))


@registered
def bad_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Rendered pages are good lines; raw html lacks a text and plain text a title."""
    lines = _pages(spark, folder).withColumn("corpus", F.lit("lines")).unionByName(
        A.table(spark, folder, "pages").select(
            F.col("page_id").alias("seq"), F.col("html").alias("value"),
            F.lit("html").alias("corpus"),
        )
    ).unionByName(
        A.table(spark, folder, "documents").select(
            F.col("doc_id").alias("seq"), F.col("text").alias("value"),
            F.lit("text").alias("corpus"),
        )
    )
    return D.bad_lines(lines).select("corpus", "seq", "reason")


@registered
def link_extract(spark: SparkSession, folder: str) -> DataFrame:
    return D.link_rows(D.linked_titles(_named_pages(spark, folder)))


@registered
def link_edges(spark: SparkSession, folder: str) -> DataFrame:
    return _page_edges(spark, folder)[1]


@registered
def red_links(spark: SparkSession, folder: str) -> DataFrame:
    pages, links = _page_graph(spark, folder)
    return G.red_links(links, pages)


@registered
def out_degree(spark: SparkSession, folder: str) -> DataFrame:
    return G.out_degrees(_page_edges(spark, folder)[1])


@registered
def adjacency(spark: SparkSession, folder: str) -> DataFrame:
    return _adjacency(G.adjacency(*_page_edges(spark, folder), Workspace(spark)))


@registered
def adjacency_small_parts(spark: SparkSession, folder: str) -> DataFrame:
    """As `adjacency` in rows of two links."""
    return _adjacency(G.adjacency(*_page_edges(spark, folder), Workspace(spark), max_rows=2))


def _adjacency(lists: DataFrame) -> DataFrame:
    pairs = F.transform("links", lambda e: F.concat_ws("*", e["dst_title"], e["mult"]))
    return lists.select(
        "title", F.col("part").cast("bigint").alias("part"),
        F.array_join(pairs, " ").alias("links"),
    )


@registered
def dead_ends(spark: SparkSession, folder: str) -> DataFrame:
    return G.dead_ends(*_page_edges(spark, folder))


@registered
def entity_edges(spark: SparkSession, folder: str) -> DataFrame:
    return G.link_edges(A.entity_links(spark, folder), A.entity_pages(spark, folder))


@registered
def pagerank_step(spark: SparkSession, folder: str) -> DataFrame:
    graph = G.build_graph(*_page_graph(spark, folder), Workspace(spark))
    base = teleport(graph.n_dead / graph.n_total, graph.n_total)
    step = P.rank_step(
        P.initial_state(graph), P.salted_edges(graph), P.edge_keys(graph), base
    )
    return step.join(graph.nodes, "node").select("title", F.round("pr", 12).alias("pr"))


@registered
def pagerank_pages(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark)
    run = P.pagerank(G.build_graph(*_page_graph(spark, folder), work), work)
    return run.ranks.select("title", F.round("pr", 12).alias("pr"))


@registered
def pagerank_metrics(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark)
    run = P.pagerank(G.build_graph(*_page_graph(spark, folder), work), work)
    rounded = [
        F.round(c, 10).alias(c) for c in ("dead_mass", "total_rank", "error")
    ]
    return run.metrics.select("turn", "dead_count", *rounded)


@registered
def pagerank_entities(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark)
    graph = G.build_graph(A.entity_pages(spark, folder), A.entity_links(spark, folder), work)
    return P.pagerank(graph, work).ranks.select("title", F.round("pr", 12).alias("pr"))


@registered
def rank_ids(spark: SparkSession, folder: str) -> DataFrame:
    return _ranked_pages(spark, folder, Workspace(spark)).ranks.select("doc_id", "title")


@registered
def rank_topk(spark: SparkSession, folder: str) -> DataFrame:
    ranked = _ranked_pages(spark, folder, Workspace(spark))
    top = ranked.ranks.orderBy("doc_id").limit(S.TOP_K)
    return top.select(
        (F.col("doc_id") + 1).alias("rank"), "title", F.round("pr", 12).alias("pr")
    )


@registered
def rank_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks written as sorted text and read back."""
    work = Workspace(spark)
    ranked = _ranked_pages(spark, folder, work)
    path = work.fresh("rank-lines")
    L.write_lines(L.rank_lines(ranked.ranks.orderBy("doc_id")), path)
    read = L.parse_rank_lines(spark.read.text(path))
    return read.select("title", F.round("pr", 12).alias("pr"))


@registered
def titles_without_id(spark: SparkSession, folder: str) -> DataFrame:
    """Link targets looked up in the id map."""
    pages, links = _page_graph(spark, folder)
    ranked = B.rank_links(pages, links, Workspace(spark))
    return N.titles_without_id(links.withColumnRenamed("dst_title", "title"), ranked.ranks)


@registered
def ids_without_title(spark: SparkSession, folder: str) -> DataFrame:
    """Document ids looked up in the id map of the pages."""
    ranked = _ranked_pages(spark, folder, Workspace(spark))
    return N.ids_without_title(A.table(spark, folder, "documents"), ranked.ranks)


@registered
def exported_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The id map exported as text in rank order, and read back by line number."""
    work = Workspace(spark)
    path = work.fresh("export")
    ranks = _ranked_pages(spark, folder, work).ranks
    L.export_lines(L.id_lines(ranks.orderBy("doc_id")), path)
    return L.read_export(spark, path).select("line", "value")


@registered
def term_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return _document_tf(spark, folder)


@registered
def doc_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return I.document_frequencies(_document_tf(spark, folder))


@registered
def postings(spark: SparkSession, folder: str) -> DataFrame:
    return L.posting_text(I.postings(_document_tf(spark, folder)))


@registered
def postings_small_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """As `postings` with rows of 64 document ids, and each word's document frequency."""
    work = Workspace(spark)
    tf = work.save(_document_tf(spark, folder), "tf")
    df = work.save(I.document_frequencies(tf), "df")
    return L.posting_text(I.postings(tf, block=64)).join(df, "word")


@registered
def postings_text(spark: SparkSession, folder: str) -> DataFrame:
    return L.posting_lines(I.postings(_document_tf(spark, folder)))


@registered
def postings_decode(spark: SparkSession, folder: str) -> DataFrame:
    return L.parse_posting_lines(L.posting_lines(I.postings(_document_tf(spark, folder))))


@registered
def tf_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Term frequencies written as text and read back."""
    path = Workspace(spark).fresh("tf-lines")
    L.write_lines(L.tf_lines(_document_tf(spark, folder)), path)
    return L.parse_tf_lines(spark.read.text(path))


@registered
def word_positions(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    lists = I.positional_postings(docs, _document_ranks(spark, folder, Workspace(spark)))
    return lists.select(
        "word", "doc_id", "seq", "tf", F.array_join(F.col("positions").cast("array<string>"), " ")
        .alias("positions"),
    )


@registered
def page_term_frequency(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with the same title add up under its rank-ordered id."""
    return _page_tables(spark, folder, Workspace(spark)).tf


@registered
def build_stats(spark: SparkSession, folder: str) -> DataFrame:
    return B.build_stats(_page_tables(spark, folder, Workspace(spark)))


@registered
def posting_intersection(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark)
    tf = work.save(_document_tf(spark, folder), "tf")
    return S.intersect_postings(_word_list_queries(spark), tf, work)


@registered
def intersection_size(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark)
    tf = work.save(_document_tf(spark, folder), "tf")
    matches = S.intersect_postings(_passage_queries(spark, folder), tf, work)
    return matches.groupBy("query_id").agg(
        F.count("*").alias("df"), F.max("tf").alias("max_tf")
    )


@registered
def removed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """For each word list of two words, documents with the first but not the second."""
    work = Workspace(spark)
    tf = work.save(_document_tf(spark, folder), "tf")
    pairs = _word_list_queries(spark).where("size(words) = 2")
    found = [
        S.intersect_postings(pairs.select("query_id", F.slice("words", i, 1).alias("words")), tf, work)
        for i in (1, 2)
    ]
    return S.removed_documents(*(x.select("query_id", "doc_id") for x in found), by=["query_id", "doc_id"])


@registered
def search_topk(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark)
    tables = _page_tables(spark, folder, work)
    return _scores(
        S.search(_word_list_queries(spark), tables.tf, tables.ranks, tables.n_docs, work)
    )


@registered
def search_batch(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark)
    tf = work.save(_document_tf(spark, folder), "tf")
    ranks = _document_ranks(spark, folder, work)
    return _scores(S.search(_passage_queries(spark, folder), tf, ranks, ranks.count(), work))


def _block_search(
    queries: DataFrame, tf: DataFrame, ranks: DataFrame, n_docs: int, work: Workspace, block: int
) -> DataFrame:
    tables = B.with_blocks(B.SearchTables(ranks, tf, None, n_docs, None), work, block)
    return _scores(O.search_blocks(queries, tables.blocks, ranks, tables.block_ranks, n_docs, work))


@registered
def search_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """As `search_batch`, from posting blocks of 64 document ids."""
    work = Workspace(spark)
    ranks = work.save(_document_ranks(spark, folder, work), "ranks", tidy=True)
    tf = I.term_frequencies(_documents(spark, folder), ranks, block=64)
    return _block_search(_passage_queries(spark, folder), tf, ranks, ranks.count(), work, 64)


@registered
def search_early_end(spark: SparkSession, folder: str) -> DataFrame:
    """As `search_topk`, from posting blocks of 16 document ids."""
    work = Workspace(spark)
    tables = _page_tables(spark, folder, work)
    return _block_search(_word_list_queries(spark), tables.tf, tables.ranks, tables.n_docs, work, 16)


@registered
def posting_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Headers of posting blocks of 64 document ids, with the number of bits set."""
    blocks = O.posting_blocks(_document_tf(spark, folder), 64)
    return blocks.select(
        "word", "block", "n", "low", "high", "max_tf", F.bitmap_count("bits").alias("n_bits"),
        F.size("postings").cast("bigint").alias("n_postings"),
    )


@registered
def common_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Of each passage, the blocks of 64 document ids with documents that have all of its words."""
    work = Workspace(spark)
    blocks = work.save(O.posting_blocks(_document_tf(spark, folder), 64), "blocks")
    sets, askers = S.word_sets(_passage_queries(spark, folder), work)
    found = O.common_blocks(sets, blocks, work).join(askers, "query_id")
    return found.select(F.col("_asked").alias("query_id"), "block", "hits")


@registered
def search_missing_words(spark: SparkSession, folder: str) -> DataFrame:
    """Passage words that no page contains."""
    tf = _page_tables(spark, folder, Workspace(spark)).tf
    return S.missing_words(_passage_queries(spark, folder), tf)


@registered
def search_snippets(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark)
    found = B.answer(_word_list_queries(spark), _page_tables(spark, folder, work), work)
    return found.select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "title",
        F.array_join("snippets", "\n").alias("snippets"),
    )


@registered
def search_report(spark: SparkSession, folder: str) -> DataFrame:
    work = Workspace(spark)
    found = B.answer(_word_list_queries(spark), _page_tables(spark, folder, work), work)
    return X.report(found, places=9).withColumn("rank", F.col("rank").cast("bigint"))


@registered
def document_table(spark: SparkSession, folder: str) -> DataFrame:
    return D.latest_documents(D.documents(_pages(spark, folder)), Workspace(spark))


@registered
def table_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Customer segments overwritten by the priority of the customer's last order."""
    base = A.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("value")
    )
    changes = A.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("value"),
        F.col("o_orderkey").alias("seq"),
    )
    return K.put_rows(base, changes, "key", "seq")


def _urgent_customers(spark: SparkSession, folder: str) -> DataFrame:
    urgent = A.table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    return urgent.select(F.col("o_custkey").alias("c_custkey"))


@registered
def table_delete(spark: SparkSession, folder: str) -> DataFrame:
    """Customers left after deleting those with an urgent order."""
    base = A.table(spark, folder, "customer").select("c_custkey", "c_name")
    return K.delete_rows(base, _urgent_customers(spark, folder), "c_custkey")


@registered
def table_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return K.lookup(A.table(spark, folder, "documents"), "doc_id", 7, "text")


@registered
def table_multi_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the documents labelled toxic."""
    toxic = A.table(spark, folder, "labels").where("toxic = 1")
    return K.lookup_many(
        A.table(spark, folder, "documents"), toxic, "doc_id", "lang", "n_chars"
    )


@registered
def missing_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Customers looked up among those with an urgent order."""
    return K.missing_keys(
        _urgent_customers(spark, folder), A.table(spark, folder, "customer"), "c_custkey"
    )


@registered
def table_scan(spark: SparkSession, folder: str) -> DataFrame:
    return K.scan_column(A.table(spark, folder, "documents"), "doc_id", "source")


@registered
def input_file_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Files of all tables, by the table's name and file's place in the folder."""
    names = ["documents", "pages", "orders", "lineitem", "customer", "part", "supplier"]
    files = L.input_files([A.table(spark, folder, name) for name in names], Workspace(spark))
    return files.select("file_id", F.regexp_extract("file_path", r"([^/]+\.parquet.*)$", 1).alias("file"), "n_rows")


def _stored(spark: SparkSession, folder: str, name: str, work: Workspace) -> DataFrame:
    """A new keyed table of customers (`key`, `value`) to write to."""
    K.create_keyed_table(spark, name, "key BIGINT, value STRING", "key")
    base = A.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("value"), F.lit(0).alias("seq")
    )
    return K.put_stored(spark, name, base, "seq", work)


def _dropped(spark: SparkSession, found: DataFrame, name: str) -> DataFrame:
    found = Workspace(spark).save(found, "found")
    K.drop_table(spark, name)
    return found


def _new_name() -> str:
    return f"stored_{uuid.uuid4().hex}"


@registered
def table_put_stored(spark: SparkSession, folder: str) -> DataFrame:
    """As `table_upsert`, on a stored table."""
    name, work = _new_name(), Workspace(spark)
    _stored(spark, folder, name, work)
    changes = A.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("value"),
        F.col("o_orderkey").alias("seq"),
    )
    return _dropped(spark, K.put_stored(spark, name, changes, "seq", work), name)


@registered
def table_delete_stored(spark: SparkSession, folder: str) -> DataFrame:
    """As `table_delete`, on a stored table."""
    name, work = _new_name(), Workspace(spark)
    _stored(spark, folder, name, work)
    keys = _urgent_customers(spark, folder).withColumnRenamed("c_custkey", "key")
    return _dropped(spark, K.delete_stored(spark, name, keys, work), name)


@registered
def table_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Customers, then those without an urgent order, published under one name; the last are read."""
    name = _new_name()
    base = A.table(spark, folder, "customer").select("c_custkey", "c_name")
    K.replace_table(base, name, "c_custkey", buckets=4)
    rest = K.delete_rows(spark.table(name), _urgent_customers(spark, folder), "c_custkey")
    return _dropped(spark, K.replace_table(rest, name, "c_custkey"), name)


@registered
def table_create_drop(spark: SparkSession, folder: str) -> DataFrame:
    """A table is there once created and filled, and gone once dropped."""
    name = _new_name()
    rows = _stored(spark, folder, name, Workspace(spark)).count()
    there = spark.catalog.tableExists(name)
    K.drop_table(spark, name)
    gone = not spark.catalog.tableExists(name)
    counted = A.table(spark, folder, "customer").agg(F.count("*").alias("n_rows"))
    return counted.select("n_rows", (F.col("n_rows") == rows).alias("filled"),
                          F.lit(there).alias("created"), F.lit(gone).alias("dropped"))


def _text_files(spark: SparkSession, lines: DataFrame, work: Workspace) -> str:
    """Lines in files of unequal size, of which Spark reads the larger ones first."""
    path = work.fresh("corpus")
    for part, where in enumerate(("seq % 7 = 0", "seq % 7 IN (1, 2)", "seq % 7 > 2")):
        L.write_lines(lines.where(where).orderBy("seq"), f"{path}/part={part}")
    return path


@registered
def corpus_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Page lines written to text files and read back in the files' order."""
    work = Workspace(spark)
    return L.numbered_lines(spark, _text_files(spark, _pages(spark, folder), work), work)


@registered
def lines_document_table(spark: SparkSession, folder: str) -> DataFrame:
    """The last text of each title, by the order of text files that repeat titles."""
    work = Workspace(spark)
    read = L.read_lines(spark, _text_files(spark, _pages(spark, folder), work))
    return D.latest_documents(D.documents(read), work)


@registered
def lines_search(spark: SparkSession, folder: str) -> DataFrame:
    """From text files with broken lines in between to ranked results."""
    work = Workspace(spark)
    broken = A.table(spark, folder, "documents").select(
        F.col("doc_id").alias("seq"), F.translate("text", "\r\n", "  ").alias("value")
    )
    path = _text_files(spark, _named_pages(spark, folder).unionByName(broken), work)
    tables = B.build(L.read_lines(spark, path), work, mode="permissive")[1]
    return _scores(
        S.search(_word_list_queries(spark), tables.tf, tables.ranks, tables.n_docs, work, df=tables.df)
    )


@registered
def id_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The id map written as text among lines without a tab, and read back."""
    work = Workspace(spark)
    ranked = _ranked_pages(spark, folder, work)
    path = work.fresh("id-lines")
    broken = ranked.ranks.select(F.concat(F.lit("no tab "), "doc_id").alias("value"))
    L.write_lines(L.id_lines(ranked.ranks).unionByName(broken), path)
    return L.parse_id_lines(spark.read.text(path))


@registered
def bad_rank_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Rank lines with a second tab among good ones."""
    titles = D.titles(_pages(spark, folder)).select(
        F.when(F.col("seq") % 3 == 0, F.concat_ws("\t", "title", F.lit("x"))).otherwise(F.col("title"))
        .alias("title"), F.col("seq").cast("double").alias("pr"),
    )
    return L.bad_rank_lines(L.rank_lines(titles)).groupBy("value").agg(F.count("*").alias("n"))


@registered
def publish_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Search tables published, read back with their saved size, and searched."""
    work = Workspace(spark)
    database = f"published_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    B.publish(_page_tables(spark, folder, work), database)
    stored = B.published(spark, database)
    found = B.answer(_word_list_queries(spark), stored, work)
    found = work.save(_scores(found), "found")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return found
