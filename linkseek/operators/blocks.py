"""Ranked AND search over posting blocks, which are read only as far as they can matter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkseek.functions import scoring
from linkseek.operators import search as S
from linkseek.operators.tables import MissingKeys, literal_keys
from linkseek.workspace import Workspace

# Document ids of one block: as many as Spark's bitmaps have bits.
BLOCK = 32_768


def posting_blocks(tf: DataFrame, block: int = BLOCK) -> DataFrame:
    """(`word`, `block`, `n`, `low`, `high`, `max_tf`, `bits`, `postings`): a word's documents within
    one range of ids.

    `n` of them from id `low` to `high`, the largest frequency, a bitmap of their places in the
    block, and entries in id order. A block holds at most `block` (BLOCK at most) entries, however
    frequent the word. Readers that choose blocks leave the last two columns in the files. Rows that
    lie by their `block` already (`term_frequencies`, of as many ids) aren't moved.
    """
    if "block" not in tf.columns:
        tf = tf.withColumn("block", F.floor(F.col("doc_id") / block))
    place = F.pmod("doc_id", F.lit(block))
    aggregated = [
        F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        F.max("tf").alias("max_tf"), F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings"),
    ]
    if block <= 64:
        rows = tf.groupBy("word", "block").agg(*aggregated, F.bit_or(_bit(place)).alias("own"))
        bits = F.unhex(_hex("own"))
    else:
        rows = tf.groupBy("word", "block").agg(*aggregated)
        places = F.transform("postings", lambda p: F.pmod(p["doc_id"], F.lit(block)))
        rows = rows.withColumn("places", places).withColumn("ends", _chunk_ends("places"))
        bits = _bitmap("places", "ends")
    return rows.select("word", "block", "n", "low", "high", "max_tf", bits.alias("bits"), "postings")


def _chunk(place: Column) -> Column:
    return F.shiftright(place, 6)


def _chunk_ends(places: str) -> Column:
    """Where the sorted places go on to another 64 bits, counted from 1."""
    at = lambda i: _chunk(F.get(places, i))
    return F.filter(
        F.sequence(F.lit(1), F.size(places)), lambda i: (i == F.size(places)) | (at(i - 1) != at(i))
    )


def _bit(place: Column) -> Column:
    """The place's bit of its 64: their highest byte comes first, and its lowest bit."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (56 - place % 64 + 2 * (place % 8)).cast("int"))


def _hex(bits: Column | str) -> Column:
    return F.lpad(F.hex(bits), 16, "0")


def _bitmap(places: str, ends: str) -> Column:
    """A bit for each of the sorted places, as Spark's bitmaps have them, up to the 64 that hold the last.

    It is put together in the row: an aggregated bitmap has the bytes of the largest block from the
    first place on, whatever a block's size.
    """
    def piece(end: Column, i: Column) -> Column:
        begin = F.when(i > 0, F.get(ends, i - 1)).otherwise(F.lit(0))
        before = F.when(i > 0, _chunk(F.get(places, begin - 1))).otherwise(F.lit(-1))
        skipped = (_chunk(F.get(places, end - 1)) - before - 1).cast("int")
        own = F.aggregate(
            F.slice(places, begin + 1, end - begin), F.lit(0).cast("bigint"),
            lambda bits, place: bits.bitwiseOR(_bit(place)),
        )
        return F.concat(F.repeat(F.lit("0" * 16), skipped), _hex(own))

    return F.unhex(F.array_join(F.transform(ends, piece), ""))


def rank_blocks(ranks: DataFrame, block: int = BLOCK) -> DataFrame:
    """(`block`, `max_pr`): the best rank in each block of ids."""
    return ranks.groupBy(F.floor(F.col("doc_id") / block).alias("block")).agg(F.max("pr").alias("max_pr"))


def common_blocks(sets: DataFrame, blocks: DataFrame, work: Workspace) -> DataFrame:
    """(`query_id`, `block`, `n_words`, `low`, `high`, `max_tf`, `hits`): blocks with documents that have all
    words of a query (`query_id`, `words`), and how many.

    Headers alone rule out blocks without one of the words or where the words' ids lie apart. In
    the others the words' bitmaps are laid over each other; a single word has its number in
    the header.
    """
    wanted = S.wanted_words(sets)
    sizes = wanted.groupBy("query_id").agg(F.count("*").alias("n_words"))
    headers = S.word_lists(blocks, wanted).select("word", "block", "n", "low", "high", "max_tf")
    met = (
        headers.join(wanted, "word").groupBy("query_id", "block")
        .agg(F.count("*").alias("found"), F.max("low").alias("low"), F.min("high").alias("high"),
             F.min("max_tf").alias("max_tf"), F.min("n").alias("hits"))
        .join(sizes, "query_id").where("found = n_words AND low <= high")
    )
    met = work.save(met.select("query_id", "block", "n_words", "low", "high", "max_tf", "hits"), "met", tidy=True)
    several = met.where("n_words > 1")
    laid = (
        _rows(blocks, several.join(wanted, "query_id").select("query_id", "word", "block"), "bits")
        .groupBy("query_id", "block").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("hits"))
        .where("hits > 0")
    )
    return work.save(
        met.where("n_words = 1").unionByName(several.drop("hits").join(laid, ["query_id", "block"])), "common", tidy=True
    )


def _rows(blocks: DataFrame, chosen: DataFrame, column: str) -> DataFrame:
    """`chosen` (`word`, `block` and others) with one column of these blocks; few words and blocks
    become literals that prune the files.

    `chosen` is broadcast if it is small enough, or else what tells its blocks or words, so that no other
    rows are exchanged: Spark can't know how few there are.
    """
    read = blocks
    words, few = literal_keys(chosen, "word"), literal_keys(chosen, "block")
    if words is not None:
        read = read.where(F.col("word").isin(words))
    if few is not None:
        read = read.where(F.col("block").isin(few))
    read = read.select("word", "block", column)
    if chosen.count() <= S.MAX_BROADCAST_CHECKS:
        return read.join(F.broadcast(chosen), ["word", "block"])
    for key in (F.xxhash64("word", "block"), F.xxhash64("word")):
        told = chosen.select(key.alias("told")).distinct()
        if told.count() <= S.MAX_BROADCAST_CANDIDATES:
            read = read.withColumn("told", key).join(F.broadcast(told), "told", "left_semi").drop("told")
            break
    return read.join(chosen, ["word", "block"])


def matches_in(chosen: DataFrame, sets: DataFrame, blocks: DataFrame) -> DataFrame:
    """(`query_id`, `doc_id`, `tf`): documents with all words within `chosen` blocks of the queries."""
    words = chosen.join(S.wanted_words(sets), "query_id").select(
        "query_id", "word", "block", "n_words", "low", "high"
    )
    shared = F.filter("postings", lambda p: p["doc_id"].between(F.col("low"), F.col("high")))
    return (
        _rows(blocks, words, "postings")
        .select("query_id", "n_words", F.inline(shared))
        .groupBy("query_id", "n_words", "doc_id").agg(F.min("tf").alias("tf"), F.count("*").alias("n_hit"))
        .where("n_hit = n_words").select("query_id", "doc_id", "tf")
    )


def bounded_blocks(common: DataFrame, block_ranks: DataFrame, n_docs: int, work: Workspace) -> DataFrame:
    """`common` with `df`, the query's number of results, `bound`, which no document of the block
    exceeds in score order, and `before`, how many results the query has in blocks of higher bounds."""
    df = common.groupBy("query_id").agg(F.sum("hits").alias("df"))
    bound = scoring.score_order(F.col("max_pr"), F.col("max_tf"), F.col("df"), F.lit(n_docs))
    first = W.partitionBy("query_id").orderBy(F.col("bound").desc(), "block")
    before = F.sum("hits").over(first.rowsBetween(W.unboundedPreceding, -1))
    return work.save(
        common.join(df, "query_id").join(block_ranks, "block").withColumn("bound", bound)
        .withColumn("before", F.coalesce(before, F.lit(0))),
        "bounded",
    )


def search_blocks(
    queries: DataFrame,
    blocks: DataFrame,
    ranks: DataFrame,
    block_ranks: DataFrame,
    n_docs: int,
    work: Workspace,
    k: int = S.TOP_K,
    strict: bool = False,
) -> DataFrame:
    """The results of `search`, from posting blocks.

    A query first reads its blocks of the highest bounds that together hold `k` results. Of the others
    only those are read whose bound reaches the `k`-th best so far; as bounds are never too
    low and equal ones are read, the results are exact.
    """
    if strict:
        absent = S.missing_words(queries, blocks).first()
        if absent is not None:
            raise MissingKeys(absent["word"])
    sets, askers = S.word_sets(queries, work)
    bounded = bounded_blocks(common_blocks(sets, blocks, work), block_ranks, n_docs, work)
    sizes = bounded.groupBy("query_id").agg(F.max("df").alias("df"))
    first = bounded.where(F.col("before") < k)
    best = work.save(matches_in(first, sets, blocks), "first-matches", tidy=True)
    more = further_blocks(bounded, best, ranks, sizes, n_docs, k)
    matches = best.unionByName(matches_in(work.save(more, "further", tidy=True), sets, blocks))
    results = S.top_results(S.score(matches, ranks, n_docs, work, sizes), n_docs, k)
    return results.withColumnRenamed("query_id", "_set").join(
        askers.withColumnRenamed("query_id", "_set"), "_set"
    ).select(F.col("_asked").alias("query_id"), *(c for c in results.columns if c != "query_id"))


def further_blocks(
    bounded: DataFrame, best: DataFrame, ranks: DataFrame, sizes: DataFrame, n_docs: int, k: int
) -> DataFrame:
    """Blocks not read first that may hold one of the best `k`."""
    order: Column = scoring.score_order(F.col("pr"), F.col("tf"), F.col("df"), F.lit(n_docs))
    ordered = best.join(ranks.select("doc_id", "pr"), "doc_id").join(sizes, "query_id").select(
        "query_id", order.alias("least")
    )
    nth = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("least").desc()))
    least = ordered.withColumn("nth", nth).where(F.col("nth") <= k).where(F.col("nth") == k).drop("nth")
    return bounded.where(F.col("before") >= k).join(least, "query_id").where("bound >= least").drop("least")
