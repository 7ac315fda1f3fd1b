"""The operators over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkseek.llm.exact_dedup import exact_groups
from linkseek.llm.html_text import main_text
from linkseek.llm.line_dedup import dedup_lines
from linkseek.llm.mixing import mixed_sizes
from linkseek.llm.near_dedup import near_classes
from linkseek.llm.nn_graph import nearest_neighbours
from linkseek.llm.pieces import encode_pieces
from linkseek.llm.quality import fit_quality, score_quality
from linkseek.llm.shared_ranking import rank_items
from linkseek.llm.sharding import sharded_texts
from linkseek.llm.token_counts import count_tokens
from linkseek.llm.topk_scan import exact_top
from linkseek.llm.variants import spelling_variants
from linkseek.llm.workers import reach
from linkseek.sources.adapters import table
from linkseek.workspace import Workspace


def pieces(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return encode_pieces(table(spark, folder, "documents"), path)


def nearest(spark: SparkSession, folder: str) -> DataFrame:
    is_query = F.col("vec_id") % 20 == 0
    return nearest_neighbours(table(spark, folder, "embeddings"), is_query, Workspace(spark))


def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, folder, "documents"), path)


def quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return score_quality(docs, fit_quality(docs)).drop("text")


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(table(spark, folder, "documents"), Workspace(spark))


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"), Workspace(spark)).drop("row_key")


def mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixed_sizes(table(spark, folder, "documents"), Workspace(spark))


def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_classes(table(spark, folder, "documents"), Workspace(spark)).drop("row_key")


def sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes and checksums are those of the texts that have arrived in a shard."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return sharded_texts(docs, Workspace(spark)).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def html_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages"), Workspace(spark))


def ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return rank_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"), Workspace(spark))


def variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"), Workspace(spark))


def top_products(spark: SparkSession, folder: str) -> DataFrame:
    is_query = F.col("vec_id") % 50 == 0
    return exact_top(table(spark, folder, "embeddings"), is_query, Workspace(spark))


def _reached(query):
    return lambda spark, folder: query(reach(spark), folder)


_ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pieces": pieces,
    "op2_nearest": nearest,
    "op3_token_counts": token_counts,
    "op4_quality": quality,
    "op5_line_dedup": line_dedup,
    "op6_exact_dedup": exact_dedup,
    "op7_mixing": mixing,
    "op8_near_dedup": near_dedup,
    "op9_sharding": sharding,
    "op10_html_text": html_text,
    "op11_ranked_search": ranked_search,
    "op12_variants": variants,
    "op13_top_products": top_products,
}

QUERIES = {name: _reached(query) for name, query in _ALL.items()}

# Near words share what is left without the letter at one place, or one is what is left of the other.
_VARIANTS = """
    WITH RECURSIVE polynomial AS (
        SELECT list(c ORDER BY i) AS by_byte FROM (
            SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384)
                                                              ELSE c >> 1 END, i) AS c
            FROM range(256) r(i))
    ), runs AS (
        SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
               translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]{7,}')),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM documents
    ), counted AS (
        SELECT run, count(*) AS n, id || ':' || run AS x FROM runs GROUP BY id, run
    ), summed AS (
        SELECT run, n, xor(4294967295, list_reduce(
            list_transform(range(strlen(x)), lambda i: CAST('0x' || hex(encode(x))[2*i+1 : 2*i+2] AS BIGINT)),
            lambda c, b: xor(by_byte[(xor(c, b) & 255) + 1], c >> 8), 4294967295)) AS h
        FROM counted, polynomial
    ), words AS MATERIALIZED (
        SELECT CASE WHEN h % 31 = 0 THEN run[: h % len(run)] || run[h % len(run) + 2 :] ELSE run END AS word,
               CAST(sum(n) AS BIGINT) AS n
        FROM summed GROUP BY 1 HAVING len(word) >= 7 AND sum(n) >= 2
    ), cut AS MATERIALIZED (
        SELECT word, n, i, word[: i - 1] || word[i + 1 :] AS rest
        FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words)
    ), pairs AS MATERIALIZED (
        SELECT a.word, a.n, b.word AS other, b.n AS other_n
        FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
        UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
    ), best AS MATERIALIZED (
        SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
        QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1
    ), forms AS MATERIALIZED (
        SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
               CASE WHEN b.other_n >= 10 * w.n THEN b.other END AS form,
               CASE WHEN b.other_n >= 10 * w.n THEN b.other_n END AS form_n
        FROM words w LEFT JOIN best b ON b.word = w.word
    ), chain AS (
        SELECT word, word AS root, form AS further FROM forms
        UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.further
    )
    SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
    FROM forms f JOIN chain c ON c.word = f.word AND c.further IS NULL
"""

ORACLE: dict[str, str] = {
    "op6_exact_dedup": """
        WITH docs AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM docs WINDOW same AS (PARTITION BY norm)
    """,
    "op11_ranked_search": r"""
        WITH split AS (
            SELECT kind, id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM (SELECT 'doc' AS kind, doc_id AS id, text FROM documents
                  UNION ALL SELECT 'item', item_id, text FROM benchmark)
        ), sizes AS (
            SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM split WHERE kind = 'doc' AND len(terms) > 0
        ), tf AS MATERIALIZED (
            SELECT id, term, n, count(*) AS tf FROM (
                SELECT id, len(terms) AS n, unnest(terms) AS term FROM split WHERE kind = 'doc') GROUP BY ALL
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, sizes GROUP BY term, n_docs
        ), parts AS (
            SELECT id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms)))) AS part
            FROM tf JOIN weights USING (term), sizes
        ), scored AS (
            SELECT i.id AS item_id, p.id AS doc_id, CAST(sum(part) AS BIGINT) AS score
            FROM (SELECT id, unnest(terms) AS term FROM split WHERE kind = 'item') i JOIN parts p USING (term)
            GROUP BY 1, 2 HAVING sum(part) > 0
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
               doc_id, score
        FROM scored QUALIFY rank <= 20
    """,
    "op12_variants": _VARIANTS,
    "op13_top_products": """
        WITH points AS (
            SELECT vec_id, max(list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT))) AS point
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
            GROUP BY vec_id
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.point, c.point), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM points q JOIN points c ON c.vec_id <> q.vec_id AND len(c.point) = len(q.point)
            WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scored QUALIFY rank <= 5
    """,
}
