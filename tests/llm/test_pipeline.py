from collections import Counter, defaultdict

import pytest
from samples import FOLDER
from test_mixing import targets
from test_near_dedup import brute, words

import corpus_pipeline as pipeline
from linkseek.llm.exact_dedup import exact_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's rows on the documents of the smallest tables."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {"documents": docs}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(folder / name))
        out[name] = docs = spark.read.parquet(str(folder / name))
    return out


def test_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "encoding"]
    for name in ("quality", "exact_dedup", "near_dedup", "mixing"):
        assert stages[name].columns == COLUMNS


def test_quality(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages["quality"].collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i, q in labels.items() if q == 0) <= 0.2 * (len(labels) - len(good))


def test_exact_copies(stages):
    best = {}
    for r in stages["quality"].collect():
        key = r.text.encode().lower()
        best[key] = max(best.get(key, -1), r.doc_id)
    assert sorted(r.doc_id for r in stages["exact_dedup"].collect()) == sorted(best.values())


def test_near_copies(stages):
    rows = [(r.doc_id, r.text) for r in stages["exact_dedup"].collect()]
    want = sorted({int(c) for _, c, _ in brute(rows)})
    assert sorted(r.doc_id for r in stages["near_dedup"].collect()) == want


def test_mix(stages):
    sizes, taken = defaultdict(int), defaultdict(int)
    texts = {}
    for r in stages["near_dedup"].collect():
        sizes[r.source] += len(words(r.text))
        texts[r.doc_id] = words(r.text)
    for r in stages["mixing"].collect():
        taken[r.source] += len(words(r.text))
        assert not Counter(words(r.text)) - Counter(texts[r.doc_id]) and r.n_chars == len(r.text)
    want = targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 128 for s in sizes)


def test_encoding(stages):
    rows = stages["encoding"].collect()
    assert len(rows) == stages["mixing"].count() and all(r.lossless for r in rows)


def test_odd_documents(spark, odd, no_rows):
    """Each stage alone, on its own input."""
    for docs in (odd, no_rows):
        for name, stage in pipeline.STAGES:
            rows = stage(spark, docs, FOLDER).collect()
            if name == "exact_dedup":
                kept = exact_groups(docs, pipeline.Workspace(spark)).where("kept").count()
                assert len(rows) == kept
            if docs is no_rows:
                assert rows == []


def test_run(spark):
    df = pipeline.run(spark, FOLDER)
    assert df.columns == ["doc_id", "n_pieces", "ids", "lossless"] and df.count() > 100
