import random
import re
import zlib
from collections import Counter

import pytest
from oracle import connect, differences
from samples import FOLDER, ODD, ODD_ROWS

from linkseek.llm.queries import ORACLE, QUERIES
from linkseek.llm.variants import near_words, spelling_variants

LOWER = {c: c + 32 for c in range(65, 91)}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def brute(rows):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            words[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), form[w] and words[form[w]]))
    return sorted(out, key=str)


def texts(seed, n, alphabet="abé", sizes=(6, 8)):
    """Words from few letters, of very unequal frequency: many are one edit apart."""
    rng = random.Random(seed)
    words = ["".join(rng.choices(alphabet, k=rng.randint(*sizes))) for _ in range(n)]
    return [(i, " ".join(w for w in words for _ in range(int(rng.paretovariate(0.6)) % 400))) for i in range(3)]


def run(spark, work, rows, **settings):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n long")
    return sorted(map(tuple, spelling_variants(df, work, **settings).collect()), key=str)


def test_query(spark):
    con = connect(FOLDER)
    assert differences(QUERIES["op12_variants"](spark, FOLDER), con, ORACLE["op12_variants"]) is None


@pytest.mark.parametrize("crowd", [0, 20, 10**6])
def test_against_brute_force(spark, work, crowd):
    rows = texts(crowd, 400)
    want = brute(rows)
    assert run(spark, work, rows, crowd=crowd) == want
    assert any(r[1] for r in want) and any(r[4] > 1 for r in want)


def test_chains_and_ties(spark, work):
    counts = {"aaaaaaaa": 3, "aaaaaaab": 30, "aaaaaabb": 300, "aaaaabbb": 3000, "zaaaaaaa": 30, "ccccccc": 2}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    assert run(spark, work, rows) == brute(rows)


def test_odd_rows(spark, work):
    long = "y" * 5000
    rows = [r[:2] for r in ODD_ROWS] + [
        (20, f"{long} {long} {long[1:]} {long[1:]}"), (21, f"{long}x {long}x"), (None, "Übergrößen ÜBERGRÖßEN"),
        (22, "×÷×÷×÷× ×÷×÷×÷× not_one-two3three"), (22, "×÷×÷×÷× ×÷×÷×÷× not_one-two3three"),
    ]
    assert run(spark, work, rows) == brute(rows)


def test_clashing_columns_and_no_rows(spark, work, odd, no_rows):
    got = spelling_variants(odd, work)
    assert sorted(map(tuple, got.collect()), key=str) == brute([r[:2] for r in ODD_ROWS])
    assert "n_chars" in ODD and spelling_variants(no_rows, work).count() == 0


def test_crowded_prefix(spark, work):
    """Very many words of one beginning meet only with those of one more chunk."""
    rng = random.Random(1)
    words = [("prefix" + "".join(rng.choices("abcdefghij", k=6)), 2) for _ in range(3000)]
    words = sorted(set(words))
    df = spark.createDataFrame(words, "word string, n long")
    got = {(r["word"], r["other"]) for r in near_words(df, work).collect()}
    known = {w for w, _ in words}
    want = {(w, w[:i] + c + w[i + 1 :]) for w in known for i in range(12) for c in "abcdefghij"}
    assert got == {(a, b) for a, b in want if b in known and a != b}
