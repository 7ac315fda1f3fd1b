"""Documents and links from corpus lines, one document per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkseek.functions import text as T
from linkseek.workspace import Workspace

NO_TITLE = "line has no title"
NO_BODY = "line has no text"


def titles(lines: DataFrame) -> DataFrame:
    """`title` of every line, other columns but `value` kept; a line without one raises."""
    kept = [c for c in lines.columns if c != "value"]
    found = lines.select(*kept, T.raw_title(F.col("value")).alias("title"))
    return found.select(*kept, _name().alias("title"))


def documents(lines: DataFrame) -> DataFrame:
    """`title` and undecoded `raw_text` of every line; a malformed line raises when read."""
    kept = [c for c in lines.columns if c != "value"]
    body = F.coalesce(
        F.when(F.col("raw_text") != "", F.col("raw_text")),
        F.when(T.has_empty_body(F.col("value")), F.lit("")),
        F.raise_error(F.lit(NO_BODY)).cast("string"),
        F.lit(""),
    )
    return _extracted(lines).select(*kept, _name().alias("title"), body.alias("raw_text"))


def _extracted(lines: DataFrame) -> DataFrame:
    value = F.col("value")
    return lines.select(
        "*", T.raw_title(value).alias("title"), T.raw_body(value).alias("raw_text")
    )


def _name():
    return T.normalize_name(T.required(F.col("title"), NO_TITLE))


def bad_lines(lines: DataFrame) -> DataFrame:
    """Lines a strict read would stop at, with the `reason`."""
    return _with_reason(lines).where(F.col("reason").isNotNull())


def good_lines(lines: DataFrame) -> DataFrame:
    return _with_reason(lines).where(F.col("reason").isNull()).drop("reason")


def _with_reason(lines: DataFrame) -> DataFrame:
    return _extracted(lines).select(*lines.columns, _reason().alias("reason"))


def _reason():
    return F.when(F.col("title") == "", F.lit(NO_TITLE)).when(
        (F.col("raw_text") == "") & ~T.has_empty_body(F.col("value")), F.lit(NO_BODY)
    )


def cut_lines(lines: DataFrame, work: Workspace, strict: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """All that is cut out of lines, in one pass: `title`, `links` as written, `raw_text`, and all columns
    but `value`; saved. A malformed line raises, or, if not `strict`, is in the second table,
    whole and with its `reason`."""
    kept = [c for c in lines.columns if c != "value"]
    linked = lines.withColumn("links", T.raw_links(F.col("value")))
    if strict:
        return work.save(documents(linked).select(*kept, "title", "links", "raw_text"), "cut"), None
    cut = _extracted(linked).withColumn("reason", _reason()).select(
        *kept, T.normalize_name(F.col("title")).alias("title"), "links", "raw_text", "reason",
        F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"),
        F.col("reason").isNotNull().alias("broken"),
    )
    saved = work.save(cut, "cut", by="broken")
    good = saved.where("NOT broken").select(*kept, "title", "links", "raw_text")
    return good, saved.where("broken").select(*kept, "value", "reason")


def linked_titles(lines: DataFrame) -> DataFrame:
    """`title` of every line with its `links` as written: the small part of a corpus, which
    the graph reads several times and is worth saving."""
    return titles(lines.withColumn("links", T.raw_links(F.col("value"))))


def link_rows(linked: DataFrame) -> DataFrame:
    """One row (`src_title`, `dst_title`) per link, repeats and self links kept.

    Links come from the whole line. They are decoded as plain rows, not inside arrays, which
    keeps the work in generated code.
    """
    rows = linked.select(F.col("title").alias("src_title"), F.explode("links").alias("link"))
    name = T.normalize_name(F.coalesce("link", F.lit("")))
    return rows.select("src_title", name.alias("dst_title"))


def repeated_titles(docs: DataFrame) -> DataFrame:
    """(`title`, `n`) of titles with more than one line."""
    return docs.groupBy("title").agg(F.count("*").alias("n")).where("n > 1")


def latest_documents(docs: DataFrame, work: Workspace) -> DataFrame:
    """Stored document per title: decoded `text` of its last line by `seq`.

    Only titles and line numbers are exchanged to find the lines that were written over.
    Those are saved, so as long as they are few Spark broadcasts them and no text moves;
    otherwise texts are joined by line number, which is unique.
    """
    keys = work.save(docs.select("title", "seq"), "titles")
    last = keys.groupBy("title").agg(F.max("seq").alias("last"), F.count("*").alias("n"))
    last = work.save(last.where("n > 1"), "rewritten")
    stale = keys.join(last, "title").where("seq < last").select("seq")
    stale = work.save(stale, "stale")
    return docs.join(stale, "seq", "left_anti").select(
        "title", T.decode_entities(F.col("raw_text")).alias("text")
    )
