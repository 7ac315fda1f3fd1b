"""Text forms of the tables, and their readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkseek.operators.ids import ROW_BITS, number_rows
from linkseek.workspace import Workspace

# Most lines that one file gets.
SINGLE_FILE_ROWS = 100_000

# Folder of an export that lists its parts; readers of the lines pass over it.
MANIFEST = "_manifest"

TOO_MANY_TABS = "more than one tab in a rank line"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Corpus lines of a file or folder as (`value`, `seq`): files in the order of their paths, lines as
    in the file.

    `seq` is an order key, (file, start of the split, place), which the scan itself knows: Spark deals
    splits out by size, but a split's lines are read by one task in order. Nothing is copied;
    `numbered_lines` gives numbers where they are asked for.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    key = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        place.alias("place"),
    )
    return spark.read.text(path).select("value", key.alias("seq"))


def numbered_lines(spark: SparkSession, path: str, work: Workspace) -> DataFrame:
    """Corpus lines as (`value`, `seq`), numbered from 0 in the order of `read_lines`.

    A split's first number is the number of lines of all splits before it, from a table with
    a row per split; the lines are read again and stay where they are.
    """
    lines = read_lines(spark, path).select("value", "seq.*")
    before = W.orderBy("file", "start").rowsBetween(W.unboundedPreceding, -1)
    splits = work.save(
        lines.groupBy("file", "start").agg(F.min("place").alias("least"), F.count("*").alias("n"))
        .withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("least"))
        .select("file", "start", "first"),
        "splits",
    )
    return lines.join(splits, ["file", "start"]).select("value", (F.col("first") + F.col("place")).alias("seq"))


def rank_lines(ranks: DataFrame) -> DataFrame:
    """`title \\t score` lines, in the order of the input."""
    return ranks.select(F.concat_ws("\t", "title", F.col("pr").cast("string")).alias("value"))


def parse_rank_lines(lines: DataFrame) -> DataFrame:
    """(`title`, `pr`); a line with a second tab raises."""
    fields = F.split("value", "\t")
    title = F.when(F.size(fields) > 2, F.raise_error(F.lit(TOO_MANY_TABS)).cast("string"))
    return lines.select(
        title.otherwise(fields[0]).alias("title"), fields[1].cast("double").alias("pr")
    )


def bad_rank_lines(lines: DataFrame) -> DataFrame:
    """Lines that `parse_rank_lines` raises at."""
    return lines.where(F.size(F.split("value", "\t")) > 2).select("value")


def id_lines(ids: DataFrame) -> DataFrame:
    """`id \\t title` lines."""
    return ids.select(F.concat_ws("\t", F.col("doc_id").cast("string"), "title").alias("value"))


def parse_id_lines(lines: DataFrame) -> DataFrame:
    """(`doc_id`, `title`); lines without a tab are skipped."""
    fields = F.split("value", "\t", 2)
    return lines.where(F.size(fields) == 2).select(
        fields[0].cast("bigint").alias("doc_id"), fields[1].alias("title")
    )


def tf_lines(tf: DataFrame) -> DataFrame:
    """`word \\t id tf` lines."""
    return tf.select(
        F.concat(F.col("word"), F.lit("\t"), F.concat_ws(" ", "doc_id", "tf")).alias("value")
    )


def parse_tf_lines(lines: DataFrame) -> DataFrame:
    fields = F.split("value", r"\s", 3)
    return lines.select(
        fields[0].alias("word"),
        fields[1].cast("bigint").alias("doc_id"),
        fields[2].cast("bigint").alias("tf"),
    )


def posting_text(postings: DataFrame) -> DataFrame:
    """(`word`, `block`, `n`, `entries`) with entries as `id tf;id tf`."""
    pairs = F.transform("postings", lambda p: F.concat_ws(" ", p["doc_id"], p["tf"]))
    return postings.select("word", "block", "n", F.array_join(pairs, ";").alias("entries"))


def posting_lines(postings: DataFrame) -> DataFrame:
    """`word \\t id tf;id tf` lines, one per posting row, in word order."""
    ordered = posting_text(postings).orderBy("word", "block")
    return ordered.select(F.concat_ws("\t", "word", "entries").alias("value"))


def parse_posting_lines(lines: DataFrame) -> DataFrame:
    """Long form (`word`, `doc_id`, `tf`) of posting lines."""
    fields = lines.select(F.split("value", "\t", 2).alias("fields"))
    pair = F.split("entry", " ")
    # A line is cut before its entries become rows, or each of them would cut the whole line again.
    return (
        fields.select(F.col("fields")[0].alias("word"), F.col("fields")[1].alias("entries"))
        .select("word", F.explode(F.split("entries", ";")).alias("entry"))
        .select(
            "word", pair[0].cast("bigint").alias("doc_id"), pair[1].cast("bigint").alias("tf")
        )
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """Replace `path` with these lines, one file per partition."""
    lines.select("value").write.mode("overwrite").text(path)


def write_single_file(lines: DataFrame, path: str) -> None:
    """As `write_lines` but in one file, for small results such as a top-k report; more than
    SINGLE_FILE_ROWS lines become the ordered parts of an export instead."""
    if lines.select("value").limit(SINGLE_FILE_ROWS + 1).count() > SINGLE_FILE_ROWS:
        export_lines(lines, path)
    else:
        lines.select("value").coalesce(1).write.mode("overwrite").text(path)


def export_lines(lines: DataFrame, path: str) -> DataFrame:
    """Write sorted `lines` of any number as text parts and a manifest of where each belongs.

    The parts, put together in the manifest's order, are the single file: a part holds `n_lines`
    from line `first_line` on, and `n_bytes` from byte `first_byte` on. A sorted table's partitions are
    ranges in order, and a part's name tells its partition. The manifest has a row per part.
    """
    write_lines(lines, path)
    spark = lines.sparkSession
    parts = spark.read.text(path).groupBy(
        F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_size").alias("n_bytes")
    ).agg(F.count("*").alias("n_lines"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = {f"first_{x}": F.coalesce(F.sum(f"n_{x}s").over(before), F.lit(0)) for x in ("line", "byte")}
    parts.withColumns(sums).coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(`part`, `n_bytes`, `n_lines`, `first_line`, `first_byte`) of an export."""
    return spark.read.parquet(f"{path}/{MANIFEST}")


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """(`line`, `value`): the lines of an export, numbered from 0 over all parts."""
    lines = read_lines(spark, path).select("value", "seq.*").withColumn("part", F.element_at(F.split("file", "/"), -1))
    splits = lines.groupBy("part", "start").agg(F.min("place").alias("least"), F.count("*").alias("n"))
    before = W.partitionBy("part").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    first = splits.withColumn("in_part", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("least")).join(
        read_manifest(spark, path).select("part", "first_line"), "part"
    )
    line = F.col("first_line") + F.col("in_part") + F.col("place")
    return lines.join(first, ["part", "start"]).select(line.alias("line"), "value")


def input_files(dfs: list[DataFrame], work: Workspace) -> DataFrame:
    """(`file_id`, `file_path`, `n_rows`) of the files behind tables, numbered from 1 by path."""
    found = [df.groupBy(F.col("_metadata.file_path").alias("file_path")).count() for df in dfs]
    files = reduce(DataFrame.unionByName, found).groupBy("file_path").agg(
        F.sum("count").alias("n_rows")
    )
    return number_rows(files, [F.col("file_path")], work, "file_id", start=1)
