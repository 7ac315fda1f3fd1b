import numpy as np
from pyspark.sql import functions as F
from samples import FOLDER

from linkseek.llm import nn_graph
from linkseek.llm.nn_graph import nearest_neighbours
from linkseek.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, top):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i, v in zip(ids.tolist(), vectors):
        if i % 20 == 0:
            order = np.lexsort((ids, -(vectors @ v)))
            out[i] = [j for j in ids[order].tolist() if j != i][:top]
    return out


def run(spark, work, rows, top=20):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = {}
    for r in sorted(nearest_neighbours(df, F.col("vec_id") % 20 == 0, work, top).collect()):
        got.setdefault(r.query_id, []).append(r.vec_id)
    return got


def test_recall(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = QUERIES["op2_nearest"](spark, FOLDER).collect()
    vectors = {i: np.array(v, float) for i, v in rows}
    want = brute(rows, 20)
    hits = sum(r.vec_id in want[r.query_id] for r in got)
    assert hits >= 0.97 * sum(map(len, want.values())) and len(got) == 20 * len(want)
    assert all(abs(r.score - vectors[r.query_id] @ vectors[r.vec_id]) < 1e-12 for r in got)
    for query in want:
        own = sorted((r.rank, -r.score, r.vec_id) for r in got if r.query_id == query)
        assert [x[0] for x in own] == list(range(1, 21)) and [x[1:] for x in own] == sorted(x[1:] for x in own)


def test_search_through_the_graph(spark, work, monkeypatch):
    """With small cells, short lists and beams, descent and search have to find the way."""
    for name, value in (("CELL_NODES", 64), ("SPLITS", 2), ("NEIGHBOURS", 10), ("BEAM", 60), ("STEP", 8)):
        monkeypatch.setattr(nn_graph, name, value)
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(1500, 12)) * rng.lognormal(0, 0.3, size=(1500, 1))  # of unequal length
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    got, want = run(spark, work, rows, top=10), brute(rows, 10)
    recall = sum(len(set(got[q]) & set(want[q])) for q in want) / sum(map(len, want.values()))
    assert recall >= 0.9


def test_equal_vectors_and_odd_rows(spark, work):
    good = [(i, [1.0, float(i // 30), 0.5]) for i in range(150)]  # five vectors, thirty times each
    odd = [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 0.0]), (260, [float("nan"), 1.0, 1.0]),
           (280, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (300, [9.0]), (301, [9.0] * 6), (320, [])]
    assert run(spark, work, good + odd + good[:5]) == brute(good, 20)


def test_few_rows(spark, work):
    few = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (21, [0.0, 2.0])]
    assert run(spark, work, few) == brute(few, 20)
    assert run(spark, work, few[:1]) == {}
    assert run(spark, work, []) == {}


def recall(spark, work, vectors, top=20):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors.astype(np.float32))]
    got, want = run(spark, work, rows, top), brute(rows, top)
    return sum(len(set(got[q]) & set(want[q])) for q in want) / sum(map(len, want.values()))


def test_one_long_vector(spark, work):
    """A vector a thousand times as long as the others leaves them their differences."""
    vectors = np.random.default_rng(1).normal(size=(700, 64)) / 8
    vectors[333] *= 1000 / np.linalg.norm(vectors[333])
    assert recall(spark, work, vectors) >= 0.9


def test_near_equal_group(spark, work):
    """More vectors than a beam holds, closer to each other than an eighth bit."""
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(900, 64)) / 8
    vectors[::3] = vectors[0] + rng.normal(size=(300, 64)) * 1e-5
    assert recall(spark, work, vectors) >= 0.9
