import numpy as np
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F
from samples import FOLDER

from linkseek.llm import topk_scan
from linkseek.llm.queries import ORACLE, QUERIES
from linkseek.llm.topk_scan import Lists, exact_top, scan

SCHEMA = "vec_id long, embedding array<double>, label int, row string, score int"


def brute(rows, top=5, modulo=50):
    """Best products of every query by comparing it with all other rows."""
    points = {i: [int(np.floor(256.0 * x)) for x in v] for i, v in rows}
    out = []
    for i, query in points.items():
        if i % modulo == 0:
            scored = sorted((-sum(a * b for a, b in zip(query, p)), j) for j, p in points.items()
                            if j != i and len(p) == len(query))
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scored[:top], 1)]
    return sorted(out)


def run(spark, work, rows, top=5):
    df = spark.createDataFrame([(i, v, 0, "r", 1) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in exact_top(df, F.col("vec_id") % 50 == 0, work, top).collect())


def lists_of(vectors):
    order = np.argsort(vectors.T, axis=1, kind="stable")
    return Lists(list(order), list(np.take_along_axis(vectors.T, order, axis=1)))


def test_query(spark):
    con = connect(FOLDER)
    assert differences(QUERIES["op13_top_products"](spark, FOLDER), con, ORACLE["op13_top_products"]) is None


@pytest.mark.parametrize("spread", [1, 40, 10**6, 10**13])
def test_scan_keeps_the_best(spread):
    rng = np.random.default_rng(spread)
    vectors = np.floor(rng.normal(size=(3000, 16)) * spread).astype(np.int64)
    vectors[::7] = vectors[0]
    lists = lists_of(vectors)
    for query in [*vectors[:10], np.zeros(16, np.int64), np.eye(16, dtype=np.int64)[3]]:
        left, n_read = scan(lists, query, 6)
        exact = vectors @ query
        rest = np.delete(exact, left)
        assert not len(rest) or rest.max() < np.sort(exact)[-6]
        assert n_read <= vectors.size


def test_scan_stops_early():
    """On vectors with a few large components most entries stay unread."""
    rng = np.random.default_rng(5)
    vectors = np.floor(rng.standard_t(2, size=(8000, 32)) * 50).astype(np.int64)
    lists = lists_of(vectors)
    assert sum(scan(lists, q, 6)[1] for q in vectors[:20]) < 0.5 * 20 * vectors.size


def test_against_brute_force(spark, work, monkeypatch):
    """Many blocks and chunks, vectors of unequal length."""
    monkeypatch.setattr(topk_scan, "BLOCK_COMPONENTS", 600)
    monkeypatch.setattr(topk_scan, "CHUNK_QUERIES", 3)
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=3 if i % 5 == 1 else 12)]) for i in range(600)]
    rows += [(i, rows[0][1]) for i in range(600, 900)]  # a third of all rows have one vector
    assert run(spark, work, rows) == brute(rows)


def test_ties_and_few_rows(spark, work):
    same = [(i, [0.5, -0.25]) for i in range(0, 200, 10)]
    assert run(spark, work, same) == brute(same)
    few = [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (51, [0.0, 2.0])]
    assert run(spark, work, few) == brute(few)
    assert run(spark, work, few[:1]) == [] and run(spark, work, []) == []
    zero = [(0, [0.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0])]
    assert run(spark, work, zero) == brute(zero)


def test_odd_rows(spark, work):
    good = [(i, [float(i % 7), -float(i % 3), 0.001]) for i in range(120)]
    odd = [(200, None), (250, []), (300, [1.0, None, 0.0]), (350, [float("nan"), 1.0, 1.0]),
           (400, [float("inf"), 1.0, 1.0]), (None, [9.0, 9.0, 9.0])]
    assert run(spark, work, good + odd + good[:60]) == brute(good)


def test_large_components(spark, work):
    rows = [(0, [1e6, -1e6]), (1, [2e6, 0.0]), (2, [1e6, 3e6])]
    assert run(spark, work, rows) == brute(rows)
    assert len(run(spark, work, rows + [(3, [1e300, 1.0])])) == 3
