import random
from collections import Counter

import pytest

from linkseek.operators import graph as G
from linkseek.operators import ids as N
from linkseek.operators import pagerank as P
from pyspark.sql import functions as F

# A hub takes a third of all links, a page links to most others, one is unlinked.
RANDOM = random.Random(7)
PAGES = [f"P{i}" for i in range(40)]
LINKS = (
    [(p, "P0") for p in PAGES[1:30]]
    + [("P1", p) for p in PAGES[2:35]]
    + [(RANDOM.choice(PAGES[:35]), RANDOM.choice(PAGES + ["Red", "Link"])) for _ in range(60)]
    + [("P5", "P6")] * 4 + [("P7", "P7")]
)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(p,) for p in PAGES], "title STRING")


@pytest.fixture(scope="module")
def links(spark):
    return spark.createDataFrame(LINKS, "src_title STRING, dst_title STRING")


VALID = Counter((s, d) for s, d in LINKS if d in set(PAGES))


def ranks_by_hand(n_total=None, damping=0.85, tolerance=0.001):
    n = n_total or len(PAGES)
    out = Counter()
    for (s, _), m in VALID.items():
        out[s] += m
    pr, turns = {p: 1 / n for p in PAGES}, 0
    while True:
        lost = sum(v for p, v in pr.items() if not out[p])
        new = {p: (1 - damping + damping * lost) / n for p in PAGES}
        for (s, d), m in VALID.items():
            new[d] += damping * pr[s] * m / out[s]
        error = sum(abs(new[p] - pr[p]) for p in PAGES)
        pr, turns = new, turns + 1
        if error < tolerance:
            return pr, turns


def test_edges(pages, links):
    edges = G.link_edges(links, pages)
    got = {(r.src_title, r.dst_title): r.mult for r in edges.collect()}
    assert got == VALID
    red = {r.dst_title: r.n_links for r in G.red_links(links, pages).collect()}
    assert red == Counter(d for _, d in LINKS if d not in set(PAGES))
    out = {r.src_title: r.outdeg for r in G.out_degrees(edges).collect()}
    dead = {r.title for r in G.dead_ends(pages, edges).collect()}
    assert dead == set(PAGES) - set(out)


@pytest.mark.parametrize("max_rows", [5, 100_000])
def test_adjacency(pages, links, work, max_rows):
    rows = G.adjacency(pages, G.link_edges(links, pages), work, max_rows).collect()
    got = Counter()
    for r in rows:
        got.update({(r.title, e.dst_title): e.mult for e in r.links})
    assert got == VALID and {r.title for r in rows} == set(PAGES)
    assert len(rows) == len({(r.title, r.part) for r in rows})
    assert (len(rows) > len(PAGES)) == (max_rows == 5)


@pytest.mark.parametrize("salt_rows", [3, 1_000_000])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_ranks(spark, pages, links, work, salt_rows, broadcast):
    """Salted or not, with edges joined by broadcast or where they lie."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        graph = G.build_graph(pages.repartition(3), links.repartition(5), work, salt_rows)
        run = P.pagerank(graph, work)
        got = {r.title: r.pr for r in run.ranks.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want, turns = ranks_by_hand()
    assert run.turns == turns and got == pytest.approx(want, abs=1e-12)
    assert sum(got.values()) == pytest.approx(1.0)
    assert run.metrics.count() == turns
    assert graph.n_edges == len(VALID) and graph.n_nodes == graph.n_total == len(PAGES)


def test_one_turn_at_least(spark, pages, work):
    none = spark.createDataFrame([], "src_title STRING, dst_title STRING")
    run = P.pagerank(G.build_graph(pages, none, work), work)
    assert run.turns == 1 and run.metrics.first().error == pytest.approx(0.0)
    assert {round(r.pr, 12) for r in run.ranks.collect()} == {round(1 / len(PAGES), 12)}


def test_numbers_are_dense_and_ordered(spark, work):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("x"))
    rows = N.number_rows(df, [F.col("x").desc()], work, "n", start=5).collect()
    assert sorted((r.n, r.x) for r in rows) == [(5 + i, 999 - i) for i in range(1000)]


def test_equal_ranks_sort_by_title(spark, work):
    noise = 1e-17
    ranks = spark.createDataFrame(
        [("b", 0.2 + noise), ("a", 0.2), ("c", 0.2 - noise), ("z", 0.4)], "title STRING, pr DOUBLE"
    )
    rows = N.rank_table(ranks, 4, work).orderBy("doc_id").collect()
    assert [r.title for r in rows] == ["z", "a", "b", "c"]


def test_links_of_unlinked_pages_are_gone_through_once(spark, work, monkeypatch):
    """What pages that no link leads to give is known: their links take no part in the turns."""
    names = [f"n{i}" for i in range(40)]
    rows = [(f"n{i}", f"n{20 + (7 * i + k) % 20}") for i in range(30) for k in range(i % 5)]
    pages, links = spark.createDataFrame([(n,) for n in names], "title STRING"), spark.createDataFrame(
        rows, "src_title STRING, dst_title STRING"
    )
    turns = []
    step = P.rank_step

    def seen(state, edges, *rest):
        turns.append(edges.count())
        return step(state, edges, *rest)

    monkeypatch.setattr(P, "rank_step", seen)
    graph = G.build_graph(pages, links, work, 2)
    run = P.pagerank(graph, work, tolerance=1e-9)
    linked = {d for _, d in rows}
    assert set(turns) == {len({(s, d) for s, d in rows if s in linked})} and turns[0] < graph.n_edges / 2
    pr, out = {n: 1 / 40 for n in names}, Counter(s for s, _ in rows)
    for _ in range(run.turns):
        lost = sum(v for n, v in pr.items() if not out[n])
        new = {n: (0.15 + 0.85 * lost) / 40 for n in names}
        for s, d in rows:
            new[d] += 0.85 * pr[s] / out[s]
        pr = new
    assert {r.title: r.pr for r in run.ranks.collect()} == pytest.approx(pr, abs=1e-14)
