"""Rows found again by what they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Copies of a row that one task numbers.
COPIES = 10_000


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits of a document's id and text, never null. Null texts count as empty."""
    parts = F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))
    return F.md5(F.concat(parts[0], F.lit(" "), parts[1]).cast("binary"))


def whole_row_key(df: DataFrame) -> Column:
    """128 bits of all that a row holds: rows of one key are the same in every column."""
    return F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"}))


def numbered_copies(df: DataFrame) -> DataFrame:
    """The rows of `df` with `copy`, by which equal rows are numbered from 0.

    Equal rows are counted, in each task first, and told apart anew, so that no task ever holds all
    copies of a row, and the numbers depend on the rows alone.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    counted = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    parts = counted.withColumn("_part", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPIES).cast("int"))))
    first = F.col("_part").cast("long") * COPIES
    last = F.least(F.col("_n"), first + COPIES) - 1
    return parts.repartition(*columns, "_part").select(*columns, F.explode(F.sequence(first, last)).alias("copy"))


def distinct_rows(df: DataFrame, key: str) -> DataFrame:
    """One row of each `key`, by which rows are equal in every column."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(*(F.first(f"`{c}`").alias(c) for c in others)).select(df.columns)


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of `docs` whose key is in `kept` (`row_key`); of rows of one id and text that with the
    smallest other columns, nulls first."""
    keyed = docs.withColumn("_row_key", row_key(docs["doc_id"], docs["text"]))
    keys = kept.select(F.col("row_key").alias("_row_key"))
    least = F.min(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias("_row")
    return keyed.join(keys, "_row_key", "left_semi").groupBy("_row_key").agg(least).select("_row.*")
