import random

import numpy as np
import pytest
from samples import FOLDER, ODD_ROWS

from linkseek.llm.quality import ABSTAIN, BAD, GOOD, LABELLERS, fit_labellers, fit_quality, posterior, score_quality, votes

BIG = "/root/testdata/sf0.01"


def test_labellers_are_found_out():
    """Accuracies of simulated labellers, and the quality behind their votes."""
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.8
    accuracy = np.array([0.95, 0.9, 0.85, 0.8, 0.9])
    right = rng.random((20_000, 5)) < accuracy
    cast = np.where(right == good[:, None], GOOD, BAD)
    cast[rng.random(cast.shape) < 0.2] = ABSTAIN
    patterns, count = np.unique(cast, axis=0, return_counts=True)
    prior, table = fit_labellers(patterns, count.astype(float))
    assert abs(prior - 0.8) < 0.03
    assert np.abs(table[1] - accuracy).max() < 0.03 and np.abs(1 - table[0] - accuracy).max() < 0.06
    assert ((posterior(cast, prior, table) >= 0.5) == good).mean() > 0.93


def test_votes():
    texts = ["", "  ", "Two words", "The cat sat on the mat and it was good, as they all said then.",
             "SHOUTED!! WORDS!! ALL!! DAY!! LONG!! HERE!!", "a## b$$ c%% d## e## f$$", "dog dog dog dog dog dog"]
    rows = dict(zip(texts, votes([t.encode() for t in texts])))
    name = list(LABELLERS).index
    assert set(rows[""]) == set(rows["  "]) == set(rows["Two words"]) == {ABSTAIN}
    assert BAD not in rows[texts[3]]
    assert rows[texts[4]][name("upper_letters")] == rows[texts[4]][name("exclamations")] == BAD
    assert rows[texts[5]][name("symbol_words")] == BAD and rows[texts[6]][name("repeated_words")] == BAD


def test_held_out_accuracy(spark):
    """Labels are only looked at here."""
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs)).join(spark.read.parquet(f"{BIG}/labels.parquet").withColumnRenamed("quality", "label"), "doc_id")
    rows = scored.select("label", "kept").collect()
    right = np.mean([r.kept == (r.label == 1) for r in rows])
    keeps = np.mean([r.kept for r in rows if r.label == 1])
    rejects = np.mean([not r.kept for r in rows if r.label == 0])
    assert right > 0.97 and keeps > 0.98 and rejects > 0.9


@pytest.mark.parametrize("n", [1, 10, 60])
def test_other_languages_stay(spark, n):
    """Clean documents in scripts and languages that no list knows, however few there are."""
    rng = random.Random(n)

    def text(alphabet, function):
        words = ["".join(rng.choices(alphabet, k=rng.randint(3, 10))) for _ in range(300)]
        return " ".join(rng.choice(function if rng.random() < 0.4 else words) for _ in range(rng.randint(30, 200))) + "."

    kinds = [("абвгдежзиклмнопрстуфхцчшщыьэюя", ["и", "в", "не", "на", "что"]),
             ("abcdefghijklmnoprstuwyząęłńóśżź", ["nie", "jest", "się", "do", "że"]),
             ("αβγδεζηθικλμνξοπρστυφχψω", ["και", "το", "να", "με"]),
             ("".join(map(chr, range(0x4E00, 0x5100))), ["的", "是", "在", "不"])]
    extra = [(10**6 + i, text(*kinds[i % 4])) for i in range(4 * n)]
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text").union(
        spark.createDataFrame(extra, "doc_id long, text string"))
    kept = score_quality(docs, fit_quality(docs)).where("doc_id >= 1000000 AND kept")
    assert kept.count() == len(extra)


def test_copies_count_once(spark):
    """A text on a third of all rows is one row of the sample."""
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text").limit(400)
    first = docs.orderBy("doc_id").limit(1)
    copies = docs.unionAll(first.crossJoin(spark.range(200)).select("doc_id", "text"))
    assert abs(fit_quality(copies).sum() - fit_quality(docs).sum()) < 0.2 * abs(fit_quality(docs).sum()) + 5


def test_bounded_sample(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text")
    weights = fit_quality(docs, train_rows=300)
    assert np.array_equal(weights, fit_quality(docs.repartition(7), train_rows=300))
    labels = spark.read.parquet(f"{BIG}/labels.parquet").withColumnRenamed("quality", "label")
    rows = score_quality(docs, weights).join(labels, "doc_id").select("label", "kept").collect()
    assert np.mean([r.kept == (r.label == 1) for r in rows]) > 0.93


def test_odd_documents(odd, no_rows):
    rows = score_quality(odd, fit_quality(odd)).collect()
    assert len(rows) == len(ODD_ROWS)
    assert all(not r.kept and r.quality == 0 for r in rows if not (r.text or "").strip())
    assert score_quality(no_rows, fit_quality(no_rows)).collect() == []
    assert not fit_quality(no_rows).any()
