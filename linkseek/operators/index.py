"""Inverted index: term frequencies, document frequencies, postings, positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkseek.functions import text as T

# Document ids covered by one posting row; a frequent word has several rows.
POSTING_BLOCK = 65_536

# Pieces of a text whose offsets are added up together.
RUN_PIECES = 64

# Documents whose words are put into posting blocks by one task.
TASK_DOCUMENTS = 2_048

# Fixed value: gaps between words.
_GAP_OR_WORD = r"[a-zA-Z]+|[^a-zA-Z]+"


def with_doc_ids(docs: DataFrame, ids: DataFrame, strict: bool = True) -> DataFrame:
    """`docs` with the `doc_id` of their title; a title without one raises, or is left out."""
    known = ids.select("title", "doc_id")
    if not strict:
        return docs.join(known, "title")
    return docs.join(known, "title", "left").withColumn("doc_id", _required_id())


def _required_id() -> Column:
    missing = F.raise_error(F.concat(F.lit("no id for title "), F.col("title")))
    return F.coalesce("doc_id", missing.cast("bigint"))


def term_frequencies(
    docs: DataFrame, ids: DataFrame, lower: bool = False, strict: bool = True, block: int | None = None
) -> DataFrame:
    """(`word`, `doc_id`, `tf`) of `docs(title, raw_text)`; repeated titles add up.

    Words are counted within the row, and a line's counts move as one row: no text moves, and nothing
    has to be gathered for the lines that alone have their title. Lines of repeated titles are counted
    by title and word together, so that neither a frequent word nor a title with very many lines piles up.

    With `block`, also the `block` of that many ids. A block's rows lie in one partition, and partitions go on
    in id order: a line's counts move there as one row again, so that posting blocks are put together
    without moving words one by one. It is for blocks of fewer ids than TASK_DOCUMENTS, as a task takes whole ones.
    """
    text = F.col("raw_text")
    found = T.words(F.lower(text) if lower else text)
    counted = _counted(docs.where(F.rlike(text, F.lit(T.WORD))).select("title", found.alias("found")))
    # One string moves in about half of the bytes of an array; words hold no spaces.
    counted = counted.withColumn("words", F.array_join("words", " "))
    # Both kinds of lines meet the same table in the same way, so that Spark moves them once.
    lines = docs.groupBy("title").agg(F.count("*").alias("lines"))
    known = ids.select(F.col("title").alias("_known"), "doc_id")
    keyed = lines.join(known, F.expr("title = _known AND lines = 1"), "left").select(
        F.col("title").alias("_title"), "lines", "doc_id"
    )
    met = counted.join(keyed, F.col("title").eqNullSafe(F.col("_title")))
    pair = F.inline(F.arrays_zip(F.split("words", " "), "tfs")).alias("word", "tf")
    alone = met.where("lines = 1")
    alone = alone.withColumn("doc_id", _required_id()) if strict else alone.where("doc_id IS NOT NULL")
    summed = (
        met.where("lines > 1").select("title", pair).groupBy("title", "word").agg(F.sum("tf").alias("tf"))
    )
    summed = with_doc_ids(summed, ids, strict)
    if block is None:
        return alone.select("doc_id", pair).select("word", "doc_id", "tf").unionByName(
            summed.select("word", "doc_id", "tf")
        )
    counts = alone.select("doc_id", "words", "tfs").unionByName(
        summed.select("doc_id", F.col("word").alias("words"), F.array("tf").alias("tfs"))
    )
    parts = -(-ids.count() // TASK_DOCUMENTS) or 1
    counts = counts.withColumn("block", F.floor(F.col("doc_id") / block)).repartitionByRange(parts, "block")
    return counts.select("doc_id", "block", pair).select("word", "doc_id", "tf", "block")


def _ends(found: str, differ) -> Column:
    """Where the runs of a sorted array end, counted from 1: before entries that differ, and at its end."""
    last = lambda i: F.get(found, i)
    return F.filter(
        F.sequence(F.lit(1), F.size(found)),
        lambda i: (i == F.size(found)) | differ(last(i - 1), last(i)),
    )


def _begin(i: Column) -> Column:
    """How many entries lie before the run of this number."""
    return F.when(i > 0, F.get("ends", i - 1)).otherwise(F.lit(0))


def _counted(docs: DataFrame) -> DataFrame:
    """(`title`, `words`, `tfs`): the distinct words of `docs(title, found)`, in order, and how often each
    was found."""
    ordered = docs.select("title", F.sort_array("found").alias("found"))
    runs = ordered.select("title", "found", _ends("found", lambda x, y: x != y).alias("ends"))
    return runs.select(
        "title", F.transform("ends", lambda end: F.get("found", end - 1)).alias("words"),
        F.transform("ends", lambda end, i: (end - _begin(i)).cast("bigint")).alias("tfs"),
    )


def document_frequencies(tf: DataFrame) -> DataFrame:
    return tf.groupBy("word").agg(F.count("*").alias("df"))


def postings(tf: DataFrame, block: int = POSTING_BLOCK) -> DataFrame:
    """(`word`, `block`, `n`, `postings`): entries in id order, `n` of them in the row's block.

    Ids are dense, so a block holds at most `block` entries however frequent the word; the
    word's list is its rows in block order.
    """
    entry = F.struct("doc_id", "tf")
    return tf.groupBy("word", F.floor(F.col("doc_id") / block).alias("block")).agg(
        F.count("*").alias("n"), F.sort_array(F.collect_list(entry)).alias("postings")
    )


def _sums(lengths: Column) -> Column:
    """The sum of all lengths before each one, and of all."""
    add = lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n))
    return F.aggregate(lengths, F.array(F.lit(0).cast("bigint")), add)


def _piece_runs(docs: DataFrame) -> DataFrame:
    """(`seq`, `title`, `start`, `run`, `before`): each line's words and gaps in runs of RUN_PIECES, the run's
    offset in the line's text and those of its pieces in the run.

    Offsets add up within the row, in runs of RUN_PIECES pieces and then over the runs, so that
    a long text doesn't cost its length squared.
    """
    pieces = F.regexp_extract_all("raw_text", F.lit(_GAP_OR_WORD), F.lit(0))
    n_runs = F.ceil(F.size("pieces") / RUN_PIECES).cast("int")
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(n_runs, F.lit(1))),
        lambda i: F.slice("pieces", (i - 1) * RUN_PIECES + 1, F.lit(RUN_PIECES)),
    )
    run_size = lambda run: F.aggregate(run, F.lit(0).cast("bigint"), lambda n, x: n + F.length(x))
    return (
        docs.select("seq", "title", pieces.alias("pieces")).select("seq", "title", runs.alias("runs"))
        .withColumn("starts", _sums(F.transform("runs", run_size)))
        .select("seq", "title", F.inline(F.arrays_zip("runs", F.slice("starts", F.lit(1), F.size("runs")))).alias("run", "start"))
        .withColumn("before", F.slice(_sums(F.transform("run", F.length)), F.lit(1), F.size("run")))
    )


def _word_offsets(docs: DataFrame) -> DataFrame:
    """(`seq`, `title`, `word`, `pos`): every word with its offset in the line's text."""
    return (
        _piece_runs(docs)
        .select("seq", "title", "start", F.inline(F.arrays_zip("run", "before")).alias("word", "pos"))
        .where(F.col("word").rlike("^[a-zA-Z]"))
        .select("seq", "title", "word", (F.col("start") + F.col("pos")).alias("pos"))
    )


def occurrences(docs: DataFrame, ids: DataFrame, strict: bool = True) -> DataFrame:
    """(`seq`, `doc_id`, `word`, `pos`): every word with its offset in the line's text. `seq` is
    unique per line."""
    return with_doc_ids(_word_offsets(docs), ids, strict).select("seq", "doc_id", "word", "pos")


def positional_postings(docs: DataFrame, ids: DataFrame, strict: bool = True) -> DataFrame:
    """(`word`, `doc_id`, `seq`, `tf`, `positions`), one row per word and line.

    An offset only means something within one text, and a text bounds the list. Words stay together in
    runs of their line, which meet the line's id and each other as few rows; its lists are cut out of the
    line's sorted words in the row.
    """
    placed = F.zip_with(
        "run", "before", lambda x, pos: F.struct(x.alias("word"), (F.col("start") + pos).alias("pos"))
    )
    words = F.filter(placed, lambda x: F.rlike(x["word"], F.lit("^[a-zA-Z]")))
    runs = _piece_runs(docs.where(F.rlike("raw_text", F.lit(T.WORD)))).select("seq", "title", words.alias("found"))
    lines = (
        with_doc_ids(runs, ids, strict).groupBy("seq", "title", "doc_id")
        .agg(F.collect_list("found").alias("found"))
        .select("seq", "doc_id", F.sort_array(F.flatten("found")).alias("found"))
    )
    ends = _ends("found", lambda x, y: x["word"] != y["word"])
    lists = lines.select("seq", "doc_id", "found", ends.alias("ends")).select(
        "seq", "doc_id", F.transform("ends", lambda end: F.get("found", end - 1)["word"]).alias("words"),
        F.transform("ends", lambda end, i: F.slice("found", _begin(i) + 1, end - _begin(i))["pos"]).alias("lists"),
    )
    return lists.select("seq", "doc_id", F.inline(F.arrays_zip("words", "lists")).alias("word", "positions")).select(
        "word", "doc_id", "seq", F.size("positions").cast("bigint").alias("tf"), "positions"
    )
