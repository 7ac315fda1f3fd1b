from collections import defaultdict

import pytest
from samples import FOLDER, ODD_ROWS

from linkseek.llm.exact_dedup import MAX_CHUNK, MIN_CHUNK, cuts, exact_groups
from linkseek.llm.queries import ORACLE, QUERIES


def lowered(text):
    return (text or "").encode().lower()


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lowered(text)].append(doc_id)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        best, one = max(known) if known else None, True
        for i in ids:
            out.append((str(i), str(best), len(ids), i == best and one))
            one = one and i != best
    return sorted(out)


@pytest.mark.parametrize("bits", [64, 3])
def test_groups(odd, work, bits):
    """Also when most chunks share their hash."""
    got = exact_groups(odd, work, bits).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got) == brute(
        [r[:2] for r in ODD_ROWS])


def test_few_hash_bits_on_documents(spark, work):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = exact_groups(docs, work, bits=4).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got) == brute(rows)


def test_no_rows(no_rows, work):
    assert exact_groups(no_rows, work).collect() == []


def test_cuts():
    """Cuts depend on the text alone, keep to their bounds and come again after an insertion."""
    import random

    rng = random.Random(5)
    text = bytes(rng.choices(b"abcdefghij ", k=200_000))
    alone = cuts([text])[0]
    assert cuts([b"", b"other", text, text])[2:] == [alone, alone] and cuts([b""]) == [[]]
    assert alone[-1] == len(text)
    sizes = [b - a for a, b in zip([0, *alone], alone)]
    assert all(MIN_CHUNK <= n <= MAX_CHUNK for n in sizes[:-1]) and len(sizes) > 20
    moved = {n + 3 for n in alone}
    assert len(moved & set(cuts([b"new" + text])[0])) > 0.8 * len(alone)
    assert max(cuts([b"a" * 100_000])[0]) == 100_000


def test_query(spark):
    from oracle import connect, differences

    query = QUERIES["op6_exact_dedup"](spark, FOLDER)
    assert differences(query, connect(FOLDER), ORACLE["op6_exact_dedup"]) is None
