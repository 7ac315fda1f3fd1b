"""Spelling variants: frequent words one edit away, found by asymmetric q-chunks."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkseek.workspace import Workspace

# Fixed value: what words are made of.
LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
# A form is at least so many times as frequent as the word.
RATIO = 10
# A run whose checksum this divides loses a letter.
SLIP = 31
# Pairs that one chunk may give; of more, the rest of the words is cut into chunks too.
CROWD = 1024

CHUNK, GRAM = 0, 1


def word_counts(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """(`word`, `n`) of `docs` (`doc_id`, `text`): runs of letters, A-Z lower-cased, without the letter
    that a checksum of document and run strikes out of some; LEAST_COUNT times or more."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))).alias("_run"),
    ).select("_id", F.translate("_run", string.ascii_uppercase, string.ascii_lowercase).alias("_run"))
    struck = runs.withColumn("_sum", F.crc32(F.concat_ws(":", "_id", "_run").cast("binary"))).withColumn(
        "_at", (F.col("_sum") % F.length("_run")).cast("int")
    )
    shorter = F.concat(F.substr("_run", F.lit(1), F.col("_at")), F.substr("_run", F.col("_at") + 2))
    word = F.when(F.col("_sum") % SLIP == 0, shorter).otherwise(F.col("_run")).alias("word")
    return (
        struck.select(word).where(F.length("word") >= least)
        .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)
    )


def _cut(rows: DataFrame) -> DataFrame:
    """Chunks and grams of what is left of each word, from `begin` to before `end`.

    Of `size` letters that a word is to have left, its two chunks are the first half and the last
    half (without the middle one). The other word has as many left or one more: an edit before a
    chunk moves its copy by the difference, one after it doesn't. Of all the positional grams
    of a chunk's length, those at other places can't be its copies and are left out.
    """
    half = F.floor(F.col("size") / 2).cast("int")
    place = F.when(F.col("side") == 0, 0).otherwise(F.col("size") - F.col("half"))
    moved = F.col("end") - F.col("begin") - F.col("size")
    at = F.explode(F.array_distinct(F.array(F.col("place"), F.col("place") + F.col("moved"))))
    start = F.col("begin") + F.col("at")
    return (
        rows.withColumn("half", half).withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumns({"place": place, "moved": moved}).withColumn("at", at)
        .select(
            "word", "n", "role",
            F.xxhash64("key", "side", F.substr("word", start + 1, F.col("half"))).alias("key"),
            F.when(F.col("side") == 0, start + F.col("half")).otherwise(F.col("begin")).alias("begin"),
            F.when(F.col("side") == 0, F.col("end")).otherwise(start).alias("end"),
            (F.col("size") - F.col("half")).alias("size"),
        )
    )


def _roles(words: DataFrame) -> DataFrame:
    """Each word as the one with chunks, and as the one with grams for words as long or one shorter."""
    length = F.length("word")
    role = lambda kind, size: F.struct(F.lit(kind).alias("role"), size.alias("size"))
    roles = F.array(role(CHUNK, length), role(GRAM, length), role(GRAM, length - 1))
    return words.select("word", "n", F.explode(roles).alias("as")).select(
        "word", "n", "as.role", F.col("as.size").cast("long").alias("key"),
        F.lit(0).alias("begin"), F.length("word").alias("end"), "as.size",
    ).where("size > 1")


def near_words(words: DataFrame, work: Workspace, crowd: int = CROWD) -> DataFrame:
    """(`word`, `n`, `other`, `other_n`): all pairs of `words` (`word`, `n`) that differ by exactly
    one inserted, deleted or replaced letter, both ways round.

    One edit leaves one of a word's two chunks as it is, so each pair meets in a chunk of its shorter
    word and a gram of the other. Where a chunk would give more than `crowd` pairs, its words are
    cut again within the rest, whose one edit again leaves one of two chunks, until a
    letter is left: then all that meet are pairs to return, or differ in two places.
    """
    met, rows = [], _cut(_roles(words))
    while True:
        count = lambda role: F.count_if(F.col("role") == role)
        crowded = rows.where("size > 1").groupBy("key").agg((count(CHUNK) * count(GRAM)).alias("pairs"))
        crowded = work.save(crowded.where(F.col("pairs") > crowd).select("key"), "crowded")
        if crowded.isEmpty():
            met.append(rows)
            break
        met.append(rows.join(crowded, "key", "left_anti"))
        rows = work.save(_cut(rows.join(crowded, "key", "left_semi")), "cut-again")
    met = reduce(DataFrame.unionByName, [x.select("key", "role", "word", "n") for x in met])
    chunks = met.where(F.col("role") == CHUNK).drop("role")
    grams = met.where(F.col("role") == GRAM).select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    once = (F.length("word") < F.length("other")) | (F.col("word") < F.col("other"))
    pairs = chunks.join(grams, "key").where(once & (F.levenshtein("word", "other", 1) == 1))
    pairs = work.save(pairs.select("word", "n", "other", "other_n").distinct(), "pairs")
    return pairs.union(pairs.select("other", "other_n", "word", "n"))


def _roots(forms: DataFrame, work: Workspace) -> DataFrame:
    """(`word`, `root`): where the forms of (`word`, `form`) lead. A form is more frequent than
    its word, so chains end; each round takes the root of the root, so that they halve."""
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        roots = work.save(
            roots.join(further, "root", "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")
            ),
            "roots",
        )
        if roots.where("moved").isEmpty():
            return roots.drop("moved")
        roots = roots.drop("moved")


def spelling_variants(docs: DataFrame, work: Workspace, ratio: int = RATIO, crowd: int = CROWD) -> DataFrame:
    """(`word`, `form`, `root`, `n`, `n_near`, `form_n`), a row per word of `docs` (`doc_id`, `text`).

    A word's form is the most frequent word one edit away, the first in code-point order of
    equally frequent ones, if it is `ratio` times as frequent or more; its root is where forms lead
    in the end. A word of very many neighbours is summed up in each task first. A null text has
    no words, a null id counts as empty, repeated rows count each; words may be of any length. An
    empty table gives no rows.
    """
    words = work.save(word_counts(docs), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = near_words(words, work, crowd).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= F.col("n") * ratio
    forms = work.save(
        words.join(near, "word", "left").select(
            "word", F.when(enough, F.col("best.other")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(forms.where("form IS NOT NULL"), work)
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
