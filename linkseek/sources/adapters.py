"""Corpora and graphs from plain tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkseek.functions import text as T
from linkseek.operators.documents import NO_TITLE, documents


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _lines(parts: DataFrame) -> DataFrame:
    """One document per line, as corpus files hold them."""
    text = F.when(F.col("text") == "", F.lit('<text xml:space="preserve" />')).otherwise(
        F.concat(F.lit('<text xml:space="preserve">'), "text", F.lit("</text>"))
    )
    return parts.select(
        "seq",
        F.concat(F.lit("<page><title>"), "title", F.lit("</title>"), text, F.lit("</page>"))
        .alias("value"),
    )


def _one_line(text: Column) -> Column:
    return F.translate(text, "\r\n", "  ")


def page_lines(pages: DataFrame, named: bool = False) -> DataFrame:
    """Web pages as corpus lines (`seq`, `value`).

    Title is the whole page title; the text is all of the page without tags, followed by its
    own-site links as `[[target]]`. Links name a page by the first token of its title: with
    `named`, for the link graph alone, that name stands for the title.
    """
    parts = _page_parts(pages)
    return _lines(parts.select("seq", (_first("title") if named else F.col("title")).alias("title"), "text"))


def _first(title: str) -> Column:
    return F.split_part(title, F.lit(" "), F.lit(1))


def _page_parts(pages: DataFrame) -> DataFrame:
    title = F.trim(T.raw_title(F.col("html")))
    parts = pages.select(
        F.col("page_id").alias("seq"), _one_line(F.col("html")).alias("html")
    ).select(
        "seq", title.alias("title"),
        F.regexp_replace("html", "<[^>]*>", " ").alias("text"),
        F.regexp_extract_all("html", F.lit('href="/([^"]+)"'), F.lit(1)).alias("hrefs"),
    )
    marked = F.concat(F.lit(" [["), F.array_join("hrefs", "]] [["), F.lit("]]"))
    links = F.when(F.size("hrefs") > 0, marked).otherwise("")
    return parts.select("seq", "title", F.concat("text", links).alias("text"))


def page_documents(pages: DataFrame) -> DataFrame:
    """All that is cut out of pages, in one pass: (`seq`, `title`, `name`, `links`, `raw_text`), where
    `name` is what links know the page by."""
    lines = _lines(_page_parts(pages))
    first = T.normalize_name(_first("_title"))
    cut = documents(lines.select("*", T.raw_links(F.col("value")).alias("links"),
                                 T.raw_title(F.col("value")).alias("_title")))
    return cut.select("seq", "title", T.required(first, NO_TITLE).alias("name"), "links", "raw_text")


def document_lines(documents: DataFrame) -> DataFrame:
    """A document table as corpus lines (`seq`, `value`), markup characters encoded."""
    text = T.encode_entities(_one_line(F.col("text")))
    return _lines(
        documents.select(
            F.col("doc_id").alias("seq"), _document_title().alias("title"), text.alias("text")
        )
    )


def document_corpus(documents: DataFrame) -> DataFrame:
    """A document table as parsed documents (`seq`, `title`, `raw_text`), text as it is."""
    return documents.select(
        F.col("doc_id").alias("seq"), _document_title().alias("title"),
        F.col("text").alias("raw_text"),
    )


def _document_title() -> Column:
    return F.concat(F.lit("Doc "), F.col("doc_id").cast("string"))


def _named(kind: str, key: str) -> Column:
    return F.concat(F.lit(f"{kind} "), F.col(key).cast("string"))


def entity_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer, part, supplier, nation and region as a page."""
    keys = {
        "Customer": ("customer", "c_custkey"), "Part": ("part", "p_partkey"),
        "Supplier": ("supplier", "s_suppkey"), "Nation": ("nation", "n_nationkey"),
        "Region": ("region", "r_regionkey"),
    }
    return reduce(
        DataFrame.unionByName,
        [
            table(spark, folder, name).select(_named(kind, key).alias("title"))
            for kind, (name, key) in keys.items()
        ],
    )


def entity_links(spark: SparkSession, folder: str) -> DataFrame:
    """Customer to parts ordered and nation, part to suppliers, supplier to nation to region."""
    lineitem = table(spark, folder, "lineitem")
    ordered = table(spark, folder, "orders").join(
        lineitem, F.col("o_orderkey") == F.col("l_orderkey")
    )
    hops = [
        (ordered, "Customer", "o_custkey", "Part", "l_partkey"),
        (lineitem, "Part", "l_partkey", "Supplier", "l_suppkey"),
        (table(spark, folder, "supplier"), "Supplier", "s_suppkey", "Nation", "s_nationkey"),
        (table(spark, folder, "nation"), "Nation", "n_nationkey", "Region", "n_regionkey"),
        (table(spark, folder, "customer"), "Customer", "c_custkey", "Nation", "c_nationkey"),
    ]
    return reduce(
        DataFrame.unionByName,
        [
            df.select(_named(a, src).alias("src_title"), _named(b, dst).alias("dst_title"))
            for df, a, src, b, dst in hops
        ],
    )
