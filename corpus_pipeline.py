"""Documents to encoded training data, in stages.

Quality (documents without words go too), exact copies (the largest doc_id stays), near copies (the
smallest stays), mixing of sources (rows repeat or shrink to the words taken), encoding.

Every stage takes nulls in any column, texts of any length, repeated rows and tables without rows, which
give none; columns beyond those of `documents` are carried along until the last stage.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linkseek.llm.exact_dedup import exact_groups
from linkseek.llm.keys import keep_rows
from linkseek.llm.mixing import mixed_texts
from linkseek.llm.near_dedup import near_classes
from linkseek.llm.pieces import encode_pieces
from linkseek.llm.quality import fit_quality, score_quality
from linkseek.llm.workers import reach
from linkseek.sources.adapters import table
from linkseek.workspace import Workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer takes for good. A null, empty or blank text is not; rows of equal texts go
    or stay together."""
    reach(spark)
    weights = fit_quality(docs.select("doc_id", "text"))
    return score_quality(docs, weights).where("kept").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, A-Z in either case: that of the largest id, a null one smaller than any.
    Null and empty texts are one text."""
    reach(spark)
    work = Workspace(spark)
    groups = exact_groups(docs, work)
    return keep_rows(docs, work.save(groups.where("kept").select("row_key"), "kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that of the smallest id, a null one larger than any.
    Texts without words are one class."""
    reach(spark)
    work = Workspace(spark)
    classes = near_classes(docs, work)
    return keep_rows(docs, work.save(classes.where("kept").select("row_key"), "kept"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, as documents. A null source is a source; texts without words are
    not in the mix."""
    return mixed_texts(docs, Workspace(reach(spark)))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(`doc_id`, `n_pieces`, `ids`, `lossless`) of each row; a null text has no pieces."""
    reach(spark)
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
    ("mixing", mixing), ("encoding", encoding),
]

# Fitted weights and drawn blocks have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each saved and read again before the next."""
    work = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    *before, (_, last) = STAGES
    docs = reduce(lambda df, stage: work.save(stage[1](spark, df, sf_dir), stage[0]), before, docs)
    return last(spark, docs, sf_dir)
