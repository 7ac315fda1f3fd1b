import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from oracle import connect, differences
from samples import FOLDER, ODD_ROWS

from linkseek.llm import shared_ranking
from linkseek.llm.queries import ORACLE, QUERIES
from linkseek.llm.shared_ranking import ITEM, LEAF, SHARED, Plan, rank_items, shared_sets

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    n_terms = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        wanted = terms(text)
        scored = []
        for d, c in counts:
            m = 100 - 25 + 25 * c.total() * n_docs // max(n_terms, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in wanted if c[t]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, n, x[3], -x[0]) for n, x in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=str)


def run(spark, work, docs, items, **settings):
    df = spark.createDataFrame([(*d, "n", 1) for d in docs], "doc_id long, text string, n string, id int").repartition(3)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, id int")
    return sorted(map(tuple, rank_items(df, asked, work, **settings).collect()), key=str)


def corpus(seed, n_docs=150, n_items=25):
    """Texts of common and rare words; items share sets of words and repeat some."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(vocabulary[min(299, int(rng.expovariate(0.03)))] for _ in range(n))
    phrases = [text(5) for _ in range(4)]
    docs = [(i, text(rng.randint(1, 60))) for i in range(n_docs)]
    items = [(i, f"{rng.choice(phrases)} {text(rng.randint(0, 12))}, {rng.choice(phrases)}!") for i in range(n_items)]
    return docs, items


def test_query(spark):
    con = connect(FOLDER)
    assert differences(QUERIES["op11_ranked_search"](spark, FOLDER), con, ORACLE["op11_ranked_search"]) is None


@pytest.mark.parametrize("settings", [{}, {"BROADCAST_TERMS": 0}, {"CHUNK_TERMS": 40}, {"CELLS": 1}, {"CELLS": 5000}])
def test_against_brute_force(spark, work, monkeypatch, settings):
    """Terms broadcast or not, items in one chunk or many, one document at a time or all."""
    for name, value in settings.items():
        monkeypatch.setattr(shared_ranking, name, value)
    docs, items = corpus(len(str(settings)))
    assert run(spark, work, docs, items, top=7) == brute(docs, items, 7)


def test_ties_and_repeated_rows(spark, work):
    docs = [(i, "same words here") for i in range(50, 0, -1)] + [(7, "same words here"), (None, "same words here")]
    docs += [(100 + i, f"other {i}") for i in range(60)]
    items = [(1, "words words"), (1, "words words"), (2, "nothing of it"), (3, None), (None, "here 5")]
    assert run(spark, work, docs, items) == brute(docs, items)


def test_odd_rows(spark, work):
    docs = [r[:2] for r in ODD_ROWS] + [(20, "ÄÖ ä_ö a·b 日本語"), (21, "\x00\x7f~"), (22, "x" * 200_000)]
    items = [(1, "Alpha ALPHA beta"), (2, "日本語 ä"), (3, ""), (4, "x" * 30_000), (5, "word " * 3000)]
    assert run(spark, work, docs, items) == brute(docs, items)
    assert run(spark, work, docs[:0], items) == [] and run(spark, work, docs, items[:0]) == []


def test_shared_sets_stand_for_their_terms():
    """Lists of shared nodes spell out the terms that they had, in fewer parts."""
    rng = random.Random(2)
    common = [[rng.randrange(60) for _ in range(6)] for _ in range(5)]
    lists = {i: rng.choice(common) + rng.choice(common) + [rng.randrange(60) for _ in range(5)] for i in range(40)}
    want = {i: Counter(x) for i, x in lists.items()}
    before = sum(map(len, lists.values()))
    shared = shared_sets(lists, 60)

    def leaves(node):
        return Counter([node]) if node < 60 else leaves(shared[node][0]) + leaves(shared[node][1])

    assert {i: sum(map(leaves, x), Counter()) for i, x in lists.items()} == want
    assert sum(map(len, lists.values())) + len(shared) < 0.7 * before
    used = Counter(x for own in lists.values() for x in set(own)) + Counter(x for pair in shared.values() for x in pair)
    assert all(used[node] >= 1 for node in shared)


def test_accumulators_are_filled_once(monkeypatch):
    rows = [{"kind": LEAF, "number": t, "weight": 10 * t, "parts": None} for t in (3, 5, 9)]
    rows += [{"kind": SHARED, "number": 3, "weight": None, "parts": [0, 2]}]
    rows += [{"kind": ITEM, "number": i, "weight": None, "parts": [3, 1][: 2 - i]} for i in (0, 1)]
    plan = Plan(rows)
    got = dict(plan.scores(np.array([0, 0, 1, 1]), np.array([3, 9, 5, 7]), np.array([1, 2, 1, 4]), np.array([100, 75])))
    part = lambda w, tf, m: w * (10**9 * tf // (1000 * tf + 12 * m))
    first = part(30, 1, 100) + part(90, 2, 100)
    assert got[0].tolist() == [first, part(50, 1, 75)] and got[1].tolist() == [first, 0]
