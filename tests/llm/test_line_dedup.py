import random

import pytest
from samples import FOLDER, ODD_ROWS

from linkseek.llm.line_dedup import dedup_lines, fingerprints


def lines_of(text):
    return (text or "").split("\n")


def check(rows, got, least):
    """Deleted lines have an equal one before that stays; deleted stretches have enough words."""
    seen = set()
    for doc_id, text in sorted(rows):
        kept = got[doc_id].text.split("\n")
        assert got[doc_id].n_lines == len(lines_of(text))
        at, stretch = 0, 0
        removed = 0
        places = lines_of(text)
        if got[doc_id].removed_lines == len(places):
            kept = []
        for line in places:
            if at < len(kept) and kept[at] == line:
                at += 1
                assert stretch == 0 or stretch >= least
                stretch = 0
                seen.add(line.strip())
            else:
                removed += 1
                stretch += len(line.split())
                assert line.strip() in seen
        assert at == len(kept) and removed == got[doc_id].removed_lines
        assert stretch == 0 or stretch >= least


def run(spark, work, rows, least=10):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in dedup_lines(docs, work, least).collect()}
    assert len(got) == len(rows)
    return got


def test_fingerprints_are_shared():
    """Equal runs with a whole window select the same line of it, wherever they stand."""
    rng = random.Random(1)
    for _ in range(300):
        run_ = [(rng.randrange(6), rng.randrange(1 << 30)) for _ in range(rng.randrange(1, 12))]
        if sum(w for w, _ in run_) < 10:
            continue
        picked = []
        for _ in range(2):
            left = [(rng.randrange(6), rng.randrange(1 << 30)) for _ in range(rng.randrange(9))]
            right = [(rng.randrange(6), rng.randrange(1 << 30)) for _ in range(rng.randrange(9))]
            whole = [*left, *run_, *right]
            at = fingerprints([w for w, _ in whole], [h for _, h in whole], 10)
            picked.append({i - len(left) for i in at if 0 <= i - len(left) < len(run_)})
        assert picked[0] & picked[1]


def test_documents(spark, work):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = {r.doc_id: r for r in dedup_lines(docs, work).collect()}
    check(rows, got, 10)
    assert sum(r.removed_lines for r in got.values()) > 50


@pytest.mark.parametrize("seed", range(2))
def test_planted_runs(spark, work, seed):
    """Whole later copies of unique runs go, and nothing else."""
    rng = random.Random(seed)
    line = lambda: " ".join(f"w{rng.randrange(10**9)}" for _ in range(rng.randrange(1, 9)))
    runs = [[line() for _ in range(rng.randrange(3, 9))] for _ in range(6)]
    runs = [r for r in runs if sum(len(x.split()) for x in r) >= 10]
    rows, want = [], {}
    for i in range(30):
        run_ = runs[i % len(runs)]
        own = [line() for _ in range(6)]
        rows.append((i, "\n".join([*own[:3], *run_, *own[3:]])))
        want[i] = "\n".join(own) if i >= len(runs) else rows[-1][1]
    got = run(spark, work, rows)
    assert {i: r.text for i, r in got.items()} == want


def test_hot_line_and_own_repeats(spark, work):
    hot = "this very same line of more than ten words is everywhere here"
    rows = [(i, f"own {i}\n{hot}\ntail {i}") for i in range(60)] + [(99, "\n".join([hot] * 5 + ["end"]))]
    got = run(spark, work, rows)
    check(rows, got, 10)
    assert got[0].text == rows[0][1] and got[5].text == "own 5\ntail 5" and got[99].text == "end"


def test_odd_documents(odd, no_rows, work):
    rows = dedup_lines(odd, work).collect()
    assert len(rows) == len(ODD_ROWS)
    texts = {r.doc_id: r.text for r in rows}
    assert texts[2] == texts[3] == "" and texts[4] == " \n\t " and texts[6] == "x" * 30_000
    assert dedup_lines(no_rows, work).collect() == []


def brute(rows, least):
    """Lines left when every run that is in an earlier place as well goes, by comparing all places."""
    docs = [[x.strip() for x in lines_of(text)] for _, text in sorted(rows)]
    places = [(d, i) for d, lines in enumerate(docs) for i in range(len(lines))]
    gone = set()
    for p, (d, i) in enumerate(places):
        for e, j in places[:p]:
            n = words = 0
            while i + n < len(docs[d]) and j + n < len(docs[e]) and docs[d][i + n] == docs[e][j + n]:
                words += len(docs[d][i + n].split())
                n += 1
            if words >= least:
                gone |= {(d, i + k) for k in range(n)}
    return {
        doc_id: "\n".join(x for i, x in enumerate(lines_of(text)) if (d, i) not in gone)
        for d, (doc_id, text) in enumerate(sorted(rows))
    }


def test_first_place_in_another_context(spark, work):
    """Whichever line of a repeated run is selected, one that stands elsewhere before."""
    rows, want = [], {}
    for k in range(8):
        pair = [f"seven words p{k} are in this line", f"four words c{k} here"]
        rows += [(10 * k + i, "\n".join(x)) for i, x in enumerate([
            [f"a{k}", pair[1], f"b{k}"], [f"d{k}", *pair, f"e{k}"], [f"f{k}", *pair, f"g{k}"],
            [f"h{k}", pair[0], f"i{k}"], [f"j{k}", *pair[::-1], *pair, f"k{k}"]])]
        want |= {10 * k + 2: f"f{k}\ng{k}", 10 * k + 4: "\n".join([f"j{k}", *pair[::-1], f"k{k}"])}
    got = run(spark, work, rows)
    assert {i: got[i].text for i in want} == want
    assert {i: r.text for i, r in got.items()} == brute(rows, 10)


def test_shared_lines_against_brute_force(spark, work):
    """Few lines, so that runs share theirs with other documents; blank lines too."""
    rng = random.Random(3)
    pool = [" ".join(f"w{i}x{k}" for k in range(rng.randrange(7))) for i in range(14)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14)))) for i in range(40)]
    got = {i: r.text for i, r in run(spark, work, rows).items()}
    want = brute(rows, 10)
    assert got == want and want != dict(rows)


def test_very_many_empty_lines(spark, work):
    """A window over empty lines is as long as they are; it costs no more for that."""
    text = "one two three four five six\n" + "\n" * 100_000 + "seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    rows = sorted(dedup_lines(docs, work).collect())
    assert rows[0].text == text and rows[1].removed_words == 12 and rows[1].text == ""
