"""The registered queries in DuckDB SQL over the same tables."""

from __future__ import annotations

from linkseek.plans.queries import WORD_LISTS


# Patterns, entities, names and the report's format are those of functions and
# operators.


def _decode(text: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&quot;", '"'),
                         ("&apos;", "''")):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


def _encode(text: str) -> str:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"),
                         ("''", "&apos;")):
        text = f"replace({text}, '{char}', '{entity}')"
    return text


def _name(text: str) -> str:
    decoded = _decode(text)
    return (
        f"CASE WHEN regexp_matches({decoded}, '^[a-z]') "
        f"THEN upper(substring({decoded}, 1, 1)) || substring({decoded}, 2) ELSE {decoded} END"
    )


def _line(title: str, body: str) -> str:
    return (
        f"'<page><title>' || {title} || '</title>' || CASE WHEN {body} = '' "
        "THEN '<text xml:space=\"preserve\" />' "
        f"ELSE '<text xml:space=\"preserve\">' || {body} || '</text>' END || '</page>'"
    )


_TITLE = "regexp_extract(value, '<title>(.+?)</title>', 1)"
_BODY = r"regexp_extract(value, '<text.*?>([\S\s]+?)</text>', 1)"

_PAGE_LINES = f"""
page_flat AS MATERIALIZED (
  SELECT page_id AS seq, translate(html, chr(13) || chr(10), '  ') AS html FROM pages),
page_parts AS MATERIALIZED (
  SELECT seq,
    trim(regexp_extract(html, '<title>(.+?)</title>', 1)) AS head,
    regexp_replace(html, '<[^>]*>', ' ', 'g')
      || CASE WHEN len(regexp_extract_all(html, 'href="/([^"]+)"', 1)) > 0
         THEN ' [[' || array_to_string(regexp_extract_all(html, 'href="/([^"]+)"', 1), ']] [[')
              || ']]' ELSE '' END AS body
  FROM page_flat),
page_lines AS MATERIALIZED (
  SELECT seq, {_line('head', 'body')} AS value, split_part(head, ' ', 1) AS first FROM page_parts),
page_docs AS MATERIALIZED (
  SELECT seq, value, {_name(_TITLE)} AS title, {_name('first')} AS name, {_BODY} AS raw_text
  FROM page_lines)"""

_PAGE_GRAPH = f"""{_PAGE_LINES},
raw_links AS MATERIALIZED (
  SELECT name AS src_title,
    unnest(regexp_extract_all(value, '\\[\\[(.+?)([\\|#]|\\]\\])', 1)) AS link
  FROM page_docs),
links AS MATERIALIZED (SELECT src_title, {_name('link')} AS dst_title FROM raw_links),
nodes AS MATERIALIZED (SELECT DISTINCT name AS title FROM page_docs),
lines AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n FROM page_lines)"""

_EDGES = """
edges AS MATERIALIZED (
  SELECT src_title AS src, dst_title AS dst, count(*) AS mult FROM links
  WHERE dst_title IN (SELECT title FROM nodes) GROUP BY 1, 2),
degrees AS MATERIALIZED (
  SELECT src, CAST(sum(mult) AS BIGINT) AS outdeg FROM edges GROUP BY 1),
dead AS MATERIALIZED (SELECT title FROM nodes WHERE title NOT IN (SELECT src FROM degrees))"""

# Turns until the change is below the tolerance; every row carries its turn's sums.
_TURNS = """
state AS (
  SELECT title, 1.0 / n AS pr, CAST(0 AS BIGINT) AS turn, CAST(1e9 AS DOUBLE) AS error,
    CAST(0 AS DOUBLE) AS total_rank, CAST(0 AS DOUBLE) AS dead_mass
  FROM nodes, lines
  UNION ALL
  SELECT title, pr, turn + 1, sum(abs(pr - prev)) OVER (), sum(pr) OVER (), mass
  FROM (
    SELECT s.title, s.pr AS prev, s.turn, m.mass,
      0.85 * coalesce(i.inflow, 0) + (0.15 + 0.85 * m.mass) / l.n AS pr
    FROM state s
    CROSS JOIN lines l
    CROSS JOIN (SELECT coalesce(sum(d.pr), 0) AS mass FROM state d
                WHERE d.title IN (SELECT title FROM dead)) m
    LEFT JOIN (
      SELECT e.dst, sum(q.pr * e.mult / g.outdeg) AS inflow
      FROM edges e JOIN degrees g ON g.src = e.src JOIN state q ON q.title = e.src
      GROUP BY 1) i ON i.dst = s.title
    WHERE s.error >= 0.001)),
ranks AS MATERIALIZED (
  SELECT title, pr FROM state WHERE turn = (SELECT max(turn) FROM state)),
rank_table AS MATERIALIZED (
  SELECT row_number() OVER (
      ORDER BY round(pr * (SELECT count(*) FROM nodes), 9) DESC, title) - 1 AS doc_id,
    title, pr FROM ranks)"""

_PAGE_RANKS = f"WITH RECURSIVE {_PAGE_GRAPH},{_EDGES},{_TURNS}"

_ENTITY_GRAPH = """
links AS MATERIALIZED (
  SELECT 'Customer ' || o_custkey AS src_title, 'Part ' || l_partkey AS dst_title
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  UNION ALL SELECT 'Part ' || l_partkey, 'Supplier ' || l_suppkey FROM lineitem
  UNION ALL SELECT 'Supplier ' || s_suppkey, 'Nation ' || s_nationkey FROM supplier
  UNION ALL SELECT 'Nation ' || n_nationkey, 'Region ' || n_regionkey FROM nation
  UNION ALL SELECT 'Customer ' || c_custkey, 'Nation ' || c_nationkey FROM customer),
nodes AS MATERIALIZED (
  SELECT 'Customer ' || c_custkey AS title FROM customer
  UNION ALL SELECT 'Part ' || p_partkey FROM part
  UNION ALL SELECT 'Supplier ' || s_suppkey FROM supplier
  UNION ALL SELECT 'Nation ' || n_nationkey FROM nation
  UNION ALL SELECT 'Region ' || r_regionkey FROM region),
lines AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes)"""

_DOC_LINES = f"""
doc_lines AS MATERIALIZED (
  SELECT doc_id AS seq, {_line("'Doc ' || doc_id",
                               _encode("translate(text, chr(13) || chr(10), '  ')"))} AS value
  FROM documents),
docs AS MATERIALIZED (
  SELECT seq, {_name(_TITLE)} AS title, {_BODY} AS raw_text FROM doc_lines)"""

_DOC_TF = """
doc_ranks AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY 'Doc ' || doc_id) - 1 AS doc_id, doc_id AS seq,
    'Doc ' || doc_id AS title, 1.0 / (SELECT count(*) FROM documents) AS pr, text
  FROM documents),
tf AS MATERIALIZED (
  SELECT word, doc_id, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '[a-zA-Z]+')) AS word FROM doc_ranks)
  GROUP BY 1, 2)"""

_TF_BY = """
tf AS MATERIALIZED (
  SELECT word, doc_id, count(*) AS tf FROM (
    SELECT r.doc_id, unnest(regexp_extract_all(d.raw_text, '[a-zA-Z]+')) AS word
    FROM page_docs d JOIN {ranks} r ON r.title = d.{title})
  GROUP BY 1, 2)"""

# Whole titles with the ranks of their names.
_PAGE_TF = f"""{_PAGE_RANKS},
titled AS MATERIALIZED (SELECT DISTINCT d.title, r.pr FROM page_docs d JOIN ranks r ON r.title = d.name),
title_table AS MATERIALIZED (
  SELECT row_number() OVER (
      ORDER BY round(pr * (SELECT count(*) FROM titled), 9) DESC, title) - 1 AS doc_id, title, pr
  FROM titled),{_TF_BY.format(ranks='title_table', title='title')}"""
_NAMED_TF = f"{_PAGE_RANKS},{_TF_BY.format(ranks='rank_table', title='name')}"

_STORED = f"""
stored AS MATERIALIZED (
  SELECT title, {_decode('raw_text')} AS text FROM page_docs
  QUALIFY row_number() OVER (PARTITION BY title ORDER BY seq DESC) = 1)"""

_WORD_LISTS = "queries AS MATERIALIZED (SELECT * FROM (VALUES " + ", ".join(
    f"(CAST({i + 1} AS BIGINT), [{', '.join(repr(w) for w in words)}])"
    for i, words in enumerate(WORD_LISTS)
) + ") v(query_id, words))"

_PASSAGES = """queries AS MATERIALIZED (
  SELECT CAST(item_id AS BIGINT) AS query_id, regexp_extract_all(text, '[a-zA-Z]+') AS words
  FROM benchmark)"""

_MATCHES = """
wanted AS MATERIALIZED (
  SELECT DISTINCT query_id, word FROM (
    SELECT query_id, unnest(words) AS word FROM queries)),
matches AS MATERIALIZED (
  SELECT w.query_id, t.doc_id, min(t.tf) AS tf
  FROM wanted w JOIN tf t ON t.word = w.word
  GROUP BY 1, 2
  HAVING count(*) = (SELECT count(*) FROM wanted v WHERE v.query_id = w.query_id))"""

_RESULTS = """
scored AS (
  SELECT *, tf * log10(n / df) AS tfidf FROM (
    SELECT m.query_id, m.tf, r.title, r.pr,
      CAST(count(*) OVER (PARTITION BY m.query_id) AS DOUBLE) AS df,
      (SELECT count(*) FROM {ranks}) AS n
    FROM matches m JOIN {ranks} r ON r.doc_id = m.doc_id)),
results AS MATERIALIZED (
  SELECT query_id, title, pr, tfidf, pr * tfidf * tfidf AS score,
    row_number() OVER (PARTITION BY query_id
      ORDER BY CASE WHEN df < n THEN round(log10(pr) + 2 * log10(tf), 9) ELSE 0 END DESC, title
    ) AS rank
  FROM scored QUALIFY rank <= 10)"""

_SCORES = """
SELECT query_id, rank, title, round(score, 12) AS score, round(pr, 12) AS pr,
  round(tfidf, 9) AS tfidf FROM results"""

# Matches of ' word ' are the gaps between the pieces of the masked text.
_SNIPPETS = f"""{_STORED},
words AS (
  SELECT r.query_id, r.rank, s.text, ' ' || s.text || ' ' AS padded,
    unnest(q.words) AS word, unnest(range(len(q.words))) AS ord
  FROM results r JOIN queries q ON q.query_id = r.query_id JOIN stored s ON s.title = r.title),
pieces AS (
  SELECT *, string_split(regexp_replace(padded, '[^A-Za-z]', ' ', 'g'), ' ' || word || ' ') AS cut
  FROM words),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, rank ORDER BY ord) AS u
  FROM pieces WHERE len(cut) > 1),
hits AS (
  SELECT query_id, rank, text, padded, word, u, k,
    list_sum(list_transform(cut[1:k], lambda p: len(p))) + (k - 1) * (len(word) + 2) AS start
  FROM (SELECT *, unnest(range(1, CAST(least(4, len(cut)) AS BIGINT))) AS k FROM numbered)
  WHERE u <= 3 AND (u < 3 OR k = 1)),
ordered AS (
  SELECT query_id, rank,
    substring(padded, CAST(start + 1 AS BIGINT),
      CAST(least(len(text), start + len(word) + 52) - start AS BIGINT)) AS snippet,
    row_number() OVER (PARTITION BY query_id, rank
      ORDER BY (k > 1), CASE WHEN k = 1 THEN -u ELSE u END, k) AS place
  FROM hits QUALIFY place <= 3)"""

_FOUND = (
    f"{_PAGE_TF}, {_WORD_LISTS},{_MATCHES},{_RESULTS.format(ranks='title_table')},{_SNIPPETS}"
)

# The text file, of those in the order of their paths, that holds a line.
_FILE = "CASE WHEN seq % 7 = 0 THEN 0 WHEN seq % 7 IN (1, 2) THEN 1 ELSE 2 END"

_POSTING_ROWS = """
SELECT word, doc_id // {block} AS block, count(*) AS n,
  string_agg(doc_id || ' ' || tf, ';' ORDER BY doc_id) AS entries
FROM tf GROUP BY 1, 2"""
_POSTINGS = _POSTING_ROWS.format(block=65536)


def _pages(select: str) -> str:
    return f"WITH {_PAGE_LINES} {select}"


def _graph(select: str) -> str:
    return f"WITH {_PAGE_GRAPH},{_EDGES} {select}"


def _doc_tf(select: str) -> str:
    return f"WITH {_DOC_TF} {select}"


ORACLE: dict[str, str] = {
    "corpus_titles": _pages("SELECT seq, title FROM page_docs"),
    "corpus_text": f"WITH {_DOC_LINES} SELECT seq, title, {_decode('raw_text')} AS text FROM docs",
    "page_text": _pages("SELECT seq, title, raw_text FROM page_docs"),
    "corpus_stats": f"""WITH {_PAGE_LINES},{_DOC_LINES},
both_corpora AS (SELECT 'pages' AS corpus, title, raw_text FROM page_docs
  UNION ALL SELECT 'documents', title, raw_text FROM docs)
SELECT corpus, count(*) AS n_lines, count(DISTINCT title) AS n_titles,
  CAST(sum(len({_decode('raw_text')})) AS BIGINT) AS n_chars,
  count(*) FILTER (raw_text = '') AS n_empty
FROM both_corpora GROUP BY 1""",
    "repeated_titles": _pages(
        "SELECT title, count(*) AS n FROM page_docs GROUP BY 1 HAVING count(*) > 1"
    ),
    "bad_documents": f"""WITH {_PAGE_LINES},
all_lines AS (
  SELECT 'lines' AS corpus, seq, value FROM page_lines
  UNION ALL SELECT 'html', page_id, html FROM pages
  UNION ALL SELECT 'text', doc_id, text FROM documents)
SELECT corpus, seq, CASE WHEN {_TITLE} = '' THEN 'line has no title'
  ELSE 'line has no text' END AS reason
FROM all_lines
WHERE {_TITLE} = '' OR ({_BODY} = '' AND NOT regexp_matches(value, '<text.*?/>'))""",
    "link_extract": _graph("SELECT src_title, dst_title FROM links"),
    "link_edges": _graph("SELECT src AS src_title, dst AS dst_title, mult FROM edges"),
    "red_links": _graph(
        "SELECT dst_title, count(*) AS n_links FROM links "
        "WHERE dst_title NOT IN (SELECT title FROM nodes) GROUP BY 1"
    ),
    "out_degree": _graph("SELECT src AS src_title, outdeg FROM degrees"),
    "adjacency": _graph(
        "SELECT title, CAST(0 AS BIGINT) AS part, "
        "coalesce(string_agg(dst || '*' || mult, ' ' ORDER BY dst), '') AS links "
        "FROM nodes LEFT JOIN edges ON src = title GROUP BY 1"
    ),
    "adjacency_small_parts": _graph(
        "SELECT title, coalesce(part, 0) AS part, "
        "coalesce(string_agg(dst || '*' || mult, ' ' ORDER BY dst), '') AS links "
        "FROM nodes LEFT JOIN (SELECT *, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // 2 "
        "AS part FROM edges) ON src = title GROUP BY 1, 2"
    ),
    "dead_ends": _graph("SELECT title FROM dead"),
    "entity_edges": f"WITH {_ENTITY_GRAPH},{_EDGES} "
                    "SELECT src AS src_title, dst AS dst_title, mult FROM edges",
    "pagerank_step": f"{_PAGE_RANKS} SELECT title, round(pr, 12) AS pr FROM state WHERE turn = 1",
    "pagerank_pages": f"{_PAGE_RANKS} SELECT title, round(pr, 12) AS pr FROM ranks",
    "pagerank_metrics": f"""{_PAGE_RANKS}
SELECT DISTINCT turn, (SELECT count(*) FROM dead) AS dead_count,
  round(dead_mass, 10) AS dead_mass, round(total_rank, 10) AS total_rank,
  round(error, 10) AS error
FROM state WHERE turn > 0""",
    "pagerank_entities": f"WITH RECURSIVE {_ENTITY_GRAPH},{_EDGES},{_TURNS} "
                         "SELECT title, round(pr, 12) AS pr FROM ranks",
    "rank_ids": f"{_PAGE_RANKS} SELECT doc_id, title FROM rank_table",
    "rank_topk": f"{_PAGE_RANKS} SELECT doc_id + 1 AS rank, title, round(pr, 12) AS pr "
                 "FROM rank_table WHERE doc_id < 10",
    "rank_lines": f"{_PAGE_RANKS} SELECT title, round(pr, 12) AS pr FROM ranks",
    "titles_without_id": _graph(
        "SELECT DISTINCT dst_title AS title FROM links "
        "WHERE dst_title NOT IN (SELECT title FROM nodes)"
    ),
    "ids_without_title": f"{_PAGE_RANKS} SELECT doc_id FROM documents "
                         "WHERE doc_id NOT IN (SELECT doc_id FROM rank_table)",
    "exported_lines": f"{_PAGE_RANKS} SELECT doc_id AS line, doc_id || chr(9) || title AS value FROM rank_table",
    "table_versions": "SELECT c_custkey, c_name FROM customer "
                      "WHERE c_custkey NOT IN (SELECT o_custkey FROM orders "
                      "WHERE o_orderpriority = '1-URGENT')",
    "term_frequency": _doc_tf("SELECT word, doc_id, tf FROM tf"),
    "doc_frequency": _doc_tf("SELECT word, count(*) AS df FROM tf GROUP BY 1"),
    "postings": _doc_tf(_POSTINGS),
    "postings_small_blocks": _doc_tf(
        f"SELECT p.*, d.df FROM ({_POSTING_ROWS.format(block=64)}) p "
        "JOIN (SELECT word, count(*) AS df FROM tf GROUP BY 1) d ON d.word = p.word"
    ),
    "posting_blocks": _doc_tf(
        "SELECT word, doc_id // 64 AS block, count(*) AS n, min(doc_id) AS low, max(doc_id) AS high, "
        "max(tf) AS max_tf, count(DISTINCT doc_id) AS n_bits, count(*) AS n_postings FROM tf GROUP BY 1, 2"
    ),
    "common_blocks": f"WITH {_DOC_TF}, {_PASSAGES},{_MATCHES} "
                     "SELECT query_id, doc_id // 64 AS block, count(*) AS hits FROM matches GROUP BY 1, 2",
    "postings_text": _doc_tf(
        f"SELECT word || chr(9) || entries AS value FROM ({_POSTINGS})"
    ),
    "postings_decode": _doc_tf("SELECT word, doc_id, tf FROM tf"),
    "tf_lines": _doc_tf("SELECT word, doc_id, tf FROM tf"),
    "word_positions": f"""WITH {_DOC_TF},
pieces AS (
  SELECT doc_id, seq, unnest(cut) AS word, unnest(range(len(cut))) AS piece FROM (
    SELECT doc_id, seq, regexp_extract_all(text, '[a-zA-Z]+|[^a-zA-Z]+') AS cut FROM doc_ranks)),
placed AS (
  SELECT *, coalesce(sum(len(word)) OVER (PARTITION BY seq ORDER BY piece
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM pieces)
SELECT word, doc_id, seq, count(*) AS tf,
  string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) AS positions
FROM placed WHERE regexp_matches(word, '^[a-zA-Z]') GROUP BY 1, 2, 3""",
    "page_term_frequency": f"{_PAGE_TF} SELECT word, doc_id, tf FROM tf",
    "build_stats": f"""{_PAGE_TF}
SELECT 'ranked_documents' AS name, count(*) AS n FROM title_table
UNION ALL SELECT 'index_words', count(DISTINCT word) FROM tf
UNION ALL SELECT 'term_rows', count(*) FROM tf
UNION ALL SELECT 'stored_documents', count(DISTINCT title) FROM page_docs WHERE raw_text IS NOT NULL""",
    "posting_intersection": f"WITH {_DOC_TF}, {_WORD_LISTS},{_MATCHES} "
                            "SELECT query_id, doc_id, tf FROM matches",
    "intersection_size": f"WITH {_DOC_TF}, {_PASSAGES},{_MATCHES} "
                         "SELECT query_id, count(*) AS df, max(tf) AS max_tf "
                         "FROM matches GROUP BY 1",
    "removed_documents": f"""WITH {_DOC_TF}, {_WORD_LISTS}
SELECT query_id, doc_id FROM queries JOIN tf ON word = words[1]
WHERE len(words) = 2
  AND NOT EXISTS (SELECT 1 FROM tf o WHERE o.word = words[2] AND o.doc_id = tf.doc_id)""",
    "search_topk": f"{_PAGE_TF}, {_WORD_LISTS},{_MATCHES},"
                   f"{_RESULTS.format(ranks='title_table')} {_SCORES}",
    "lines_search": f"{_NAMED_TF}, {_WORD_LISTS},{_MATCHES},"
                    f"{_RESULTS.format(ranks='rank_table')} {_SCORES}",
    "search_batch": f"WITH {_DOC_TF}, {_PASSAGES},{_MATCHES},"
                    f"{_RESULTS.format(ranks='doc_ranks')} {_SCORES}",
    "search_missing_words": f"{_PAGE_TF}, {_PASSAGES},{_MATCHES} "
                            "SELECT query_id, word FROM wanted "
                            "WHERE word NOT IN (SELECT word FROM tf)",
    "search_snippets": f"""{_FOUND}
SELECT r.query_id, r.rank, r.title,
  coalesce(string_agg(o.snippet, chr(10) ORDER BY o.place), '') AS snippets
FROM results r LEFT JOIN ordered o ON o.query_id = r.query_id AND o.rank = r.rank
GROUP BY 1, 2, 3""",
    "search_report": f"""{_FOUND}
SELECT r.query_id, r.rank,
  '#' || r.rank || ' [' || r.title || ']' || chr(9) || 'Score = ' || printf('%.9f', r.score)
  || chr(10) || 'PageRank = ' || printf('%.9f', r.pr) || ', TF-IDF = '
  || printf('%.9f', r.tfidf) || chr(10)
  || coalesce(string_agg(chr(9) || o.snippet || chr(10), '' ORDER BY o.place), '')
  || '======' || chr(10) || chr(10) AS report
FROM results r LEFT JOIN ordered o ON o.query_id = r.query_id AND o.rank = r.rank
GROUP BY r.query_id, r.rank, r.title, r.score, r.pr, r.tfidf""",
    "document_table": f"WITH {_PAGE_LINES},{_STORED} SELECT title, text FROM stored",
    "table_upsert": """
SELECT key, value FROM (
  SELECT c_custkey AS key, c_mktsegment AS value, 0 AS batch, 0 AS seq FROM customer
  UNION ALL SELECT o_custkey, o_orderpriority, 1, o_orderkey FROM orders)
QUALIFY row_number() OVER (PARTITION BY key ORDER BY batch DESC, seq DESC) = 1""",
    "table_delete": "SELECT c_custkey, c_name FROM customer "
                    "WHERE c_custkey NOT IN (SELECT o_custkey FROM orders "
                    "WHERE o_orderpriority = '1-URGENT')",
    "table_lookup": "SELECT doc_id, text FROM documents WHERE doc_id = 7",
    "table_multi_lookup": "SELECT doc_id, lang, n_chars FROM documents "
                          "WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)",
    "missing_keys": "SELECT c_custkey FROM customer "
                    "WHERE c_custkey NOT IN (SELECT o_custkey FROM orders "
                    "WHERE o_orderpriority = '1-URGENT')",
    "table_scan": "SELECT doc_id, source FROM documents ORDER BY doc_id",
    "input_file_ids": "SELECT row_number() OVER (ORDER BY file) AS file_id, file, n_rows FROM ("
                      + " UNION ALL ".join(
                          f"SELECT '{name}.parquet' AS file, count(*) AS n_rows FROM {name}"
                          for name in ("documents", "pages", "orders", "lineitem", "customer", "part",
                                       "supplier")) + ")",
    "table_create_drop": "SELECT count(*) AS n_rows, true AS filled, true AS created, "
                         "true AS dropped FROM customer",
    "table_delete_stored": "SELECT c_custkey AS key, c_mktsegment AS value FROM customer "
                           "WHERE c_custkey NOT IN (SELECT o_custkey FROM orders "
                           "WHERE o_orderpriority = '1-URGENT')",
    "corpus_lines": _pages(f"SELECT row_number() OVER (ORDER BY {_FILE}, seq) - 1 AS seq, value "
                           "FROM page_lines"),
    "lines_document_table": _pages(
        f"SELECT title, {_decode('raw_text')} AS text FROM page_docs QUALIFY row_number() OVER "
        f"(PARTITION BY title ORDER BY {_FILE} DESC, seq DESC) = 1"
    ),
    "id_lines": f"{_PAGE_RANKS} SELECT doc_id, title FROM rank_table",
    "bad_rank_lines": _pages(
        "SELECT title || chr(9) || 'x' || chr(9) || CAST(seq AS DOUBLE) AS value, count(*) AS n "
        "FROM page_docs WHERE seq % 3 = 0 GROUP BY 1"
    ),
}

# Other ways to the same rows.
for _name_, _same in (
    ("publish_lookup", "search_topk"), ("table_put_stored", "table_upsert"),
    ("search_blocks", "search_batch"), ("search_early_end", "search_topk"),
):
    ORACLE[_name_] = ORACLE[_same]
