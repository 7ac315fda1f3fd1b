"""Ranked AND search for a whole table of queries at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkseek.functions import scoring
from linkseek.operators.tables import MissingKeys, literal_keys
from linkseek.workspace import Workspace

# Fixed value: results per query.
TOP_K = 10

# Checks broadcast to the word lists; more are joined by exchange.
MAX_BROADCAST_CHECKS = 200_000

# Documents broadcast to the word lists, so that only their rows are exchanged for more checks.
MAX_BROADCAST_CANDIDATES = 1_000_000

# Results of one query that share one key while they are scored.
SALT_ROWS = 1_000_000


def query_words(queries: DataFrame) -> DataFrame:
    """`queries(query_id, words)` as (`query_id`, `ord`, `word`), order and repeats kept."""
    return queries.select("query_id", F.posexplode("words").alias("ord", "word"))


def wanted_words(queries: DataFrame) -> DataFrame:
    """Distinct (`query_id`, `word`)."""
    return query_words(queries).select("query_id", "word").distinct()


def word_lists(tf: DataFrame, words: DataFrame) -> DataFrame:
    """The term-frequency rows of `words`: by pruned scan for few words, by join for many."""
    return _lists_of(tf, words, literal_keys(words, "word"))


def _lists_of(tf: DataFrame, words: DataFrame, few: list | None) -> DataFrame:
    if few is not None:
        return tf.where(F.col("word").isin(few))
    return tf.join(words.select("word").distinct(), "word", "left_semi")


def missing_words(queries: DataFrame, tf: DataFrame) -> DataFrame:
    """(`query_id`, `word`) of words that are not in the index."""
    words = wanted_words(queries)
    absent = words.select("word").distinct().join(
        word_lists(tf, words).select("word").distinct(), "word", "left_anti"
    )
    return words.join(absent, "word", "left_semi").select("query_id", "word")


def word_sets(queries: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Queries of the same words as one: (`query_id`, `words`), each word once, and who asked
    (`_asked`, `query_id`)."""
    words = F.array_sort(F.array_distinct("words"))
    asked = queries.select(F.col("query_id").alias("_asked"), words.alias("words"))
    sets = work.save(asked.groupBy("words").agg(F.min("_asked").alias("query_id")), "word-sets")
    return sets, asked.join(sets, "words").select("_asked", "query_id")


def intersect_postings(
    queries: DataFrame, tf: DataFrame, work: Workspace, df: DataFrame | None = None
) -> DataFrame:
    """(`query_id`, `doc_id`, `tf`): documents with all words; `tf` is the least of them.

    Queries of the same words are answered once. `df(word, df)`, if there is one, saves counting
    the words' lists. Each query starts from its rarest word, and every candidate is checked against all its
    words by (word, document). Rows moved follow the rarest words, also where there are too many checks
    to broadcast but not too many candidates, and a frequent word spreads by document. The result isn't
    saved; who reads it twice should.
    """
    sets, askers = word_sets(queries, work)
    return (
        _intersected(sets, tf, work, df).join(askers, "query_id")
        .select(F.col("_asked").alias("query_id"), "doc_id", "tf")
    )


def _intersected(sets: DataFrame, tf: DataFrame, work: Workspace, df: DataFrame | None) -> DataFrame:
    wanted = wanted_words(sets)
    few = literal_keys(wanted, "word")
    lists = _lists_of(tf, wanted, few)
    frequencies = lists.groupBy("word").agg(F.count("*").alias("df")) if df is None else _lists_of(df, wanted, few)
    found = wanted.join(frequencies, "word")
    sizes = wanted.groupBy("query_id").agg(F.count("*").alias("n_words"))
    rarest = work.save(
        found.groupBy("query_id")
        .agg(F.min(F.struct("df", "word")).alias("first"), F.count("*").alias("n_found"))
        .join(sizes, "query_id")
        .where("n_found = n_words")
        .select("query_id", "n_words", "first.word", "first.df"),
        "rarest",
    )
    candidates = lists.join(rarest, "word").select("query_id", "n_words", "doc_id")
    n_candidates, n_checks = _check_rows(rarest)
    if n_checks > MAX_BROADCAST_CHECKS and n_candidates <= MAX_BROADCAST_CANDIDATES:
        candidates = work.save(candidates, "candidates")
        lists = lists.join(F.broadcast(candidates.select("doc_id").distinct()), "doc_id", "left_semi")
    checks = candidates.join(wanted, "query_id")
    if n_checks <= MAX_BROADCAST_CHECKS:
        checks = F.broadcast(checks)
    return (
        lists.join(checks, ["word", "doc_id"])
        .groupBy("query_id", "n_words", "doc_id")
        .agg(F.min("tf").alias("tf"), F.count("*").alias("n_hit"))
        .where("n_hit = n_words")
        .select("query_id", "doc_id", "tf")
    )


def _check_rows(rarest: DataFrame) -> tuple[int, int]:
    """How many (query, document) candidates and (query, document, word) checks there will be."""
    sums = (F.coalesce(F.sum(x), F.lit(0)) for x in (F.col("df"), F.col("df") * F.col("n_words")))
    return tuple(rarest.agg(*sums).first())


def removed_documents(
    first: DataFrame, other: DataFrame, by: tuple[str, ...] | list[str] = ("doc_id",)
) -> DataFrame:
    """Documents of one list, or of each query's, that are not in another."""
    return first.select(*by).join(other.select(*by).distinct(), list(by), "left_anti")


def score(
    matches: DataFrame, ranks: DataFrame, n_docs: int, work: Workspace, sizes: DataFrame | None = None
) -> DataFrame:
    """Score columns for `matches(query_id, doc_id, tf)`.

    `df` is the size of the query's own result: as `sizes(query_id, df)` has it, for matches that are
    only part of the result, else counted apart and joined back. Past
    broadcasting size that join goes by query and salt, so a query with very many results
    is spread out and reaches the ranking as the best few of each task.
    """
    df = matches.groupBy("query_id").agg(F.count("*").alias("df")) if sizes is None else sizes
    # Over as many keys as the largest result needs; small tables are broadcast anyway.
    df = work.save(df, "result-sizes")
    salts = -(-(df.agg(F.max("df")).first()[0] or 1) // SALT_ROWS)
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    weight = scoring.tfidf(F.col("tf"), F.lit(float(n_docs)), F.col("df"))
    return (
        matches.join(ranks.select("doc_id", "title", "pr"), "doc_id")
        .withColumn("salt", F.pmod("doc_id", F.lit(salts)).cast("int"))
        .join(df.withColumn("salt", salt), ["query_id", "salt"])
        .withColumn("tfidf", weight)
        .withColumn("score", scoring.total_score(F.col("pr"), F.col("tfidf")))
    )


def top_results(scored: DataFrame, n_docs: int, k: int = TOP_K) -> DataFrame:
    """The best `k` per query, numbered from 1: by score, then title.

    The group limit runs inside each task first.
    """
    order = scoring.score_order(F.col("pr"), F.col("tf"), F.col("df"), F.lit(n_docs))
    best = W.partitionBy("query_id").orderBy(order.desc(), F.col("title"))
    return (
        scored.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "doc_id", "title", "score", "pr", "tfidf", "tf", "df")
    )


def search(
    queries: DataFrame,
    tf: DataFrame,
    ranks: DataFrame,
    n_docs: int,
    work: Workspace,
    k: int = TOP_K,
    strict: bool = False,
    df: DataFrame | None = None,
) -> DataFrame:
    """Ranked results of `queries(query_id, words)`; `strict` raises on an unknown word.

    The matches are read twice, for their number and their rows, so they are saved first.
    """
    if strict:
        absent = missing_words(queries, tf).first()
        if absent is not None:
            raise MissingKeys(absent["word"])
    matches = work.save(intersect_postings(queries, tf, work, df), "matches")
    return top_results(score(matches, ranks, n_docs, work), n_docs, k)


def with_texts(results: DataFrame, documents: DataFrame) -> DataFrame:
    """Texts of the results only; a result without a stored text raises.

    `results` should be a saved table: it is read twice, and its size decides how it is joined.
    """
    few = literal_keys(results, "title")
    texts = documents.select("title", "text")
    if few is not None:
        texts = texts.where(F.col("title").isin(few))
    missing = F.raise_error(F.concat(F.lit("no stored text for title "), F.col("title")))
    return results.join(texts, "title", "left").withColumn(
        "text", F.coalesce("text", missing.cast("string"))
    )
