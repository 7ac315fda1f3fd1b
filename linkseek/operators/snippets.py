"""Snippets: where the query words occur in a result's text, and the result report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkseek.functions import text as T

# Characters shown after a match; matches per word, words and snippets used.
TAIL = 50
MAX_PARTS = 3


def snippets(results: DataFrame, queries: DataFrame) -> DataFrame:
    """`results` that carry a `text`, with at most three `snippets` in its place.

    Words are looked up as ` word ` in the masked, padded text; a match uses up its spaces.
    Up to three words that occur count, of a third only its first match does. First matches
    come first, the last such word leading; further matches follow by word. A snippet runs
    from its match to `TAIL` characters past it, but never beyond the length of the unpadded
    text. All of it is one row's work, so nothing is exchanged.
    """
    kept = [c for c in results.columns if c != "text"]
    return (
        results.join(queries.select("query_id", "words"), "query_id")
        .withColumn("padded", T.pad(F.col("text")))
        .withColumn("masked", T.mask_non_letters(F.col("padded")))
        .withColumn("found", F.transform("words", _pieces))
        .withColumn("found", F.filter("found", lambda w: F.size(w["gaps"]) > 1))
        .withColumn("found", F.transform(F.slice("found", 1, MAX_PARTS), _matches))
        .withColumn("firsts", F.reverse(F.transform("found", lambda w: _span(w["starts"][0], w))))
        .withColumn("others", F.flatten(F.transform("found", _further_spans)))
        .withColumn("chosen", F.slice(F.concat("firsts", "others"), 1, MAX_PARTS))
        .select(*kept, F.transform("chosen", _cut).alias("snippets"))
    )


def _pieces(word: Column) -> Column:
    """Lengths of the pieces when the masked text is split at the word's first matches.

    Only a word of letters can match masked text.
    """
    needle = F.when(F.rlike(word, F.lit("^[A-Za-z]+$")), T.pad(word)).otherwise(F.lit("(?!)"))
    lengths = F.transform(F.split(F.col("masked"), needle, MAX_PARTS + 1), F.length)
    return F.struct((F.length(word) + 2).alias("width"), lengths.alias("gaps"))


def _matches(word: Column) -> Column:
    """Offsets of the matches: one starts after the pieces and matches before it."""
    width, gaps = word["width"], word["gaps"]
    starts = F.transform(
        F.slice(gaps, F.lit(1), F.size(gaps) - 1),
        lambda _, i: F.aggregate(
            F.slice(gaps, F.lit(1), i + 1), F.lit(0), lambda n, gap: n + gap
        ) + i * width,
    )
    return F.struct(width.alias("width"), starts.alias("starts"))


def _span(start: Column, word: Column) -> Column:
    return F.struct(start.alias("start"), word["width"].alias("width"))


def _further_spans(word: Column, i: Column) -> Column:
    more = F.when(i < MAX_PARTS - 1, MAX_PARTS - 1).otherwise(0)
    return F.transform(F.slice(word["starts"], F.lit(2), more), lambda s: _span(s, word))


def _cut(span: Column) -> Column:
    end = F.least(F.length("masked") - 2, span["start"] + span["width"] + TAIL)
    return F.substr(F.col("padded"), span["start"] + 1, end - span["start"])


def _number(value: Column, places: int | None) -> Column:
    return value.cast("string") if places is None else F.format_string(f"%.{places}f", value)


def report(results: DataFrame, places: int | None = None) -> DataFrame:
    """One printable block per result; numbers in full, or at `places` decimals."""
    lines = F.transform("snippets", lambda s: F.concat(F.lit("\t"), s, F.lit("\n")))
    # Fixed value: the report format.
    block = F.concat(
        F.lit("#"), F.col("rank").cast("string"), F.lit(" ["), F.col("title"),
        F.lit("]\tScore = "), _number(F.col("score"), places), F.lit("\n"),
        F.lit("PageRank = "), _number(F.col("pr"), places),
        F.lit(", TF-IDF = "), _number(F.col("tfidf"), places), F.lit("\n"),
        F.array_join(lines, ""),
        F.lit("======\n\n"),
    )
    return results.select("query_id", "rank", block.alias("report"))
