import random
from collections import Counter, defaultdict

import numpy as np
from samples import FOLDER, ODD_ROWS

from linkseek.llm.components import components
from linkseek.llm.near_dedup import FIRSTS, aligned, near_classes, run_edges
from linkseek.workspace import Workspace


def words(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()


def shingles(text):
    w = words(text)
    return [b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def similar(a, b):
    if not a and not b:
        return True
    n = longest(a, b)
    return n / (len(a) + len(b) - n) >= 0.8 - 1e-9


def brute(rows):
    """Classes by aligning all pairs that share enough shingles."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists = [shingles(t) for _, t in rows]
    bags = [Counter(x) for x in lists]
    for i in range(len(rows)):
        for j in range(i):
            n, m = len(lists[i]), len(lists[j])
            if (bags[i] & bags[j]).total() >= 0.44 * (n + m) and root(i) != root(j) and similar(lists[i], lists[j]):
                parent[root(i)] = root(j)
    classes = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        classes[root(i)].append(doc_id)
    big = 1 << 62
    return sorted(
        (str(d), str(min(ids, key=lambda x: big if x is None else x)), len(ids))
        for ids in classes.values() for d in ids
    )


def found(df):
    rows = df.collect()
    kept = Counter(str(r.class_id) for r in rows if r.kept)
    assert len(kept) == len({str(r.class_id) for r in rows})
    return sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in rows)


def test_aligned():
    rng = random.Random(3)
    for _ in range(1500):
        a = [rng.randrange(40) for _ in range(rng.randrange(1, 40))]
        b = list(a)
        for _ in range(rng.randrange(7)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = [rng.randrange(40)] * rng.randrange(2)
        if b:
            assert aligned(np.array(a, np.int32), np.array(b, np.int32)) == similar(a, b)


def test_documents(spark, work):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert found(near_classes(docs, work)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def edited(rng, vocabulary, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(vocabulary)
    return " ".join(w)


def test_large_group_of_near_copies(spark, work):
    """Copies of one text with up to many edits, of which only some are near to each other."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    base = " ".join(rng.choices(vocabulary, k=140))
    rows = [(i, edited(rng, vocabulary, base, rng.choice([0, 1, 2, 3, 4, 6, 9]))) for i in range(150)]
    passage = " ".join(rng.choices(vocabulary, k=30))
    rows += [(200 + i, " ".join(rng.choices(vocabulary, k=60)) + " " + passage) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(near_classes(docs, work)) == brute(rows)


def test_pairs_grow_with_the_group(spark):
    """Copies with one to four edits: twice the copies make about twice the pairs, at every step."""
    counts = {}

    class Counting(Workspace):
        def save(self, df, name):
            out = super().save(df, name)
            if name in ("pairs", "with-first", "parts", "rest"):
                counts.setdefault(name, []).append(out.count())
            return out

    made = []
    for n in (300, 1200):
        rng = random.Random(7)
        vocabulary = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
        base = " ".join(rng.choices(vocabulary, k=120))
        rows = [(i, edited(rng, vocabulary, base, rng.randint(1, 4))) for i in range(n)]
        counts = {}
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        near_classes(docs, Counting(spark)).count()
        made.append({name: sum(x) for name, x in counts.items()})
    small, large = made
    assert large["rest"] <= 50
    assert all(large[name] <= 6 * small[name] for name in ("pairs", "with-first", "parts"))


def test_run_edges():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 9, 60):
        gone = rng.random(n) < 0.5
        edge = [i for i in range(n) if gone[i] and (i in (0, n - 1) or not (gone[i - 1] and gone[i + 1]))]
        assert run_edges(gone).tolist() == edge


def test_parts_grow_with_the_edits_alone(spark):
    """Texts that lack a third of the first one's words in one place are in few parts, not in one for each shingle."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    base = rng.choices(vocabulary, k=240)
    rows = []
    for i in range(120):
        at = 8 * (i % 20)
        rows.append((i, " ".join(base[:at] + rng.choices(vocabulary, k=80) + base[at + 80 :])))
    steps = []

    class Counting(Workspace):
        def save(self, df, name):
            out = super().save(df, name)
            if name in ("with-first", "parts"):
                steps.append((out.count(), out.select("node").distinct().count()))
            return out

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(near_classes(docs, Counting(spark))) == brute(rows)
    assert steps[0][0] and steps[1][0]
    for (pairs, nodes), (parts, _) in zip(steps[::2], steps[1::2]):
        assert parts <= 6 * min(pairs, FIRSTS * nodes)


def test_short_texts(spark, work):
    """Texts of few words, with one more or one less of them."""
    rng = random.Random(4)
    rows = []
    for n in (4, 5, 7, 9, 10, 14):
        for _ in range(10):
            w = [f"w{rng.randrange(100_000)}" for _ in range(n)]
            for text in (" ".join(w), " ".join([*w, "more"]), " ".join(w[:-1]), " ".join(w).upper()):
                rows.append((len(rows), text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_classes(docs, work)) == brute(rows)


def test_odd_documents(odd, no_rows, work):
    assert found(near_classes(odd, work)) == brute([r[:2] for r in ODD_ROWS])
    assert near_classes(no_rows, work).collect() == []


def test_components(spark, work):
    """A long chain, a star and a loop."""
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 301), (301, 302), (302, 300)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long"), work).collect()}
    want = dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 160), 100) | dict.fromkeys((300, 301, 302), 300)
    assert got == want
