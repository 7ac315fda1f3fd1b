"""From corpus lines to ranked, indexed, searchable tables."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkseek.operators import blocks as blocks_op
from linkseek.operators import documents as docs_op
from linkseek.operators import index as index_op
from linkseek.operators.graph import LinkGraph, build_graph
from linkseek.operators.ids import rank_table
from linkseek.operators.pagerank import RankRun, pagerank
from linkseek.operators.search import TOP_K, search, with_texts
from linkseek.operators.snippets import snippets
from linkseek.operators.tables import replace_table
from linkseek.workspace import Workspace


@dataclass(frozen=True)
class RankedCorpus:
    """graph and rank run, with ranks(doc_id, title, pr) in rank order."""

    graph: LinkGraph
    run: RankRun
    ranks: DataFrame

    @property
    def n_docs(self) -> int:
        """Ranked documents: distinct titles, not lines."""
        return self.graph.n_nodes


@dataclass(frozen=True)
class SearchTables:
    """What a query needs: ranks, tf(word, doc_id, tf), documents(title, text), df(word, df).

    `bad(seq, value, reason)` are the lines that a permissive build left out. Tables with posting
    `blocks` and `block_ranks` are searched by these instead of `tf`.
    """

    ranks: DataFrame
    tf: DataFrame
    documents: DataFrame
    n_docs: int
    df: DataFrame
    bad: DataFrame | None = None
    blocks: DataFrame | None = None
    block_ranks: DataFrame | None = None


def rank_links(pages: DataFrame, links: DataFrame, work: Workspace) -> RankedCorpus:
    graph = build_graph(pages, links, work)
    run = pagerank(graph, work)
    return RankedCorpus(graph, run, rank_table(run.ranks, graph.n_nodes, work))


def rank_corpus(lines: DataFrame, work: Workspace) -> RankedCorpus:
    """Titles and links are cut out of the texts once and saved."""
    linked = work.save(docs_op.linked_titles(lines).select("title", "links"), "linked")
    return rank_links(linked.select("title"), docs_op.link_rows(linked), work)


def index_corpus(docs: DataFrame, ranks: DataFrame, n_docs: int, work: Workspace) -> SearchTables:
    """Index and stored texts of `docs(seq, title, raw_text)`, under the ids of `ranks`.

    The index is saved in word order so lookups skip files. The texts are saved as they lie;
    `publish` lays them out for repeated lookups.
    """
    tf = index_op.term_frequencies(docs, ranks)
    tf = tf.repartitionByRange("word", "doc_id").sortWithinPartitions("word", "doc_id")
    texts = docs_op.latest_documents(docs, work)
    tf = work.save(tf, "tf")
    df = work.save(index_op.document_frequencies(tf), "df")
    return SearchTables(ranks, tf, work.save(texts, "documents"), n_docs, df)


def build(
    lines: DataFrame, work: Workspace, mode: str = "strict"
) -> tuple[RankedCorpus, SearchTables]:
    """Ranks and search tables of corpus lines, each of which is cut up once. A malformed line raises,
    or in "permissive" mode goes to a table of bad lines."""
    docs, bad = docs_op.cut_lines(lines, work, strict=mode != "permissive")
    ranked = rank_links(docs.select("title"), docs_op.link_rows(docs.select("title", "links")), work)
    tables = index_corpus(docs.select("seq", "title", "raw_text"), ranked.ranks, ranked.n_docs, work)
    return ranked, replace(tables, bad=bad)


def answer(
    queries: DataFrame, tables: SearchTables, work: Workspace, k: int = TOP_K, strict: bool = False
) -> DataFrame:
    """Top results with their snippets; texts are fetched for the results alone."""
    asked = work.save(queries.select("query_id", "words"), "queries")
    if tables.blocks is None:
        found = search(asked, tables.tf, tables.ranks, tables.n_docs, work, k, strict, tables.df)
    else:
        found = blocks_op.search_blocks(
            asked, tables.blocks, tables.ranks, tables.block_ranks, tables.n_docs, work, k, strict
        )
    results = work.save(found, "results")
    return snippets(with_texts(results, tables.documents), asked)


def build_stats(tables: SearchTables) -> DataFrame:
    """(`name`, `n`): ranked documents, indexed words, term rows, stored documents."""
    counts = {
        "ranked_documents": tables.ranks.agg(F.count("*").alias("n")),
        "index_words": index_op.document_frequencies(tables.tf).agg(F.count("*").alias("n")),
        "term_rows": tables.tf.agg(F.count("*").alias("n")),
        "stored_documents": tables.documents.agg(F.count("*").alias("n")),
    }
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("name"), "n") for name, df in counts.items()],
    )


def with_blocks(tables: SearchTables, work: Workspace, block: int = blocks_op.BLOCK) -> SearchTables:
    """The same tables with posting blocks, in word order so that lookups skip files.

    Blocks put together from rows that lie by `block` stay in the files of their ids, so that none moves: each
    file is in word order, and lookups skip its pages of other words and files of other ids.
    """
    rows = blocks_op.posting_blocks(tables.tf, block)
    if "block" not in tables.tf.columns:
        rows = rows.repartitionByRange("word", "block")
    rows = rows.sortWithinPartitions("word", "block")
    return replace(
        tables, blocks=work.save(rows, "posting-blocks", tidy=True),
        block_ranks=work.save(blocks_op.rank_blocks(tables.ranks, block), "block-ranks"),
    )


def publish(tables: SearchTables, database: str, buckets: int | None = None) -> None:
    """Replace the stored tables of `database`, each laid out for lookups by its key.

    Tables with unique keys are bucketed, by default into the session's shuffle partitions;
    those keyed by word are split by range, as one word may have very many rows.
    """
    spark = tables.tf.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    replace_table(tables.ranks, f"{database}.rank_table", "doc_id", buckets=buckets)
    replace_table(tables.documents, f"{database}.document_table", "title", buckets=buckets)
    replace_table(tables.tf, f"{database}.index_table", "word", "doc_id", ordered=True)
    replace_table(tables.df, f"{database}.frequency_table", "word")
    replace_table(blocks_op.posting_blocks(tables.tf), f"{database}.posting_table", "word", "block")
    replace_table(blocks_op.rank_blocks(tables.ranks), f"{database}.block_table", "block")
    build_stats(tables).write.mode("overwrite").format("parquet").saveAsTable(
        f"{database}.build_stats"
    )


def published(spark: SparkSession, database: str) -> SearchTables:
    """The tables `publish` stored; the collection size comes from the saved counts."""
    stats = spark.table(f"{database}.build_stats").where("name = 'ranked_documents'")
    return SearchTables(
        spark.table(f"{database}.rank_table"),
        spark.table(f"{database}.index_table"),
        spark.table(f"{database}.document_table"),
        stats.first()["n"],
        spark.table(f"{database}.frequency_table"),
        blocks=spark.table(f"{database}.posting_table"),
        block_ranks=spark.table(f"{database}.block_table"),
    )
