import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from linkseek.operators import snippets as X

TEXTS = [
    ("a a a a", ["a"]),
    ("red Fruit fruit red red tree", ["red", "fruit"]),
    ("one two three four five one two", ["one", "two", "three", "four"]),
    ("x" * 70 + " word " + "y" * 80, ["word"]),
    ("word", ["word"]),
    ("", ["word"]),
    ("a.b.a,b;a b", ["a", "b"]),
    ("a b a b a b a b", ["a", "a", "a"]),
    ("nothing here", ["a", "b"]),
    ("été a été b", ["a", "b", "c"]),
    ("a (?!) b", ["(?!)", "b", "[a]"]),
]


def by_rule(text, words):
    """The snippet rule in plain Python."""
    padded = f" {text} "
    masked = re.sub("[^A-Za-z]", " ", padded)
    found = []
    for word in words:
        at = [m.start() for m in re.finditer(re.escape(f" {word} "), masked)][:3]
        if at:
            found.append([(start, start + len(word) + 2 + 50) for start in at])
    found = found[:3]
    spans = [hits[0] for hits in reversed(found)]
    spans += [span for hits in found[:2] for span in hits[1:]]
    return [padded[a : min(b, len(text))] for a, b in spans[:3]]


def got(spark, cases):
    results = spark.createDataFrame(
        [(i, text) for i, (text, _) in enumerate(cases)], "query_id BIGINT, text STRING"
    )
    queries = spark.createDataFrame(
        [(i, words) for i, (_, words) in enumerate(cases)], "query_id BIGINT, words ARRAY<STRING>"
    )
    rows = X.snippets(results, queries).orderBy("query_id").collect()
    return [r.snippets for r in rows]


def test_snippets(spark):
    assert got(spark, TEXTS) == [by_rule(*case) for case in TEXTS]


def test_snippet_order(spark):
    assert got(spark, [("a a a a", ["a"])]) == [[" a a a ", " a "]]
    first = got(spark, [TEXTS[2]])[0]
    assert [s.split()[0] for s in first] == ["three", "two", "one"]


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(
    st.tuples(st.text(alphabet="ab .é", max_size=60),
              st.lists(st.sampled_from(["a", "b", "ab", "ba"]), min_size=1, max_size=5)),
    min_size=1, max_size=25,
))
def test_snippets_follow_the_rule(spark, cases):
    assert got(spark, cases) == [by_rule(*case) for case in cases]


def test_report(spark):
    results = spark.createDataFrame(
        [(1, 1, "Cherry", 0.25, 0.5, 1e-05, ["one", "two"]), (1, 2, "B", 1.0, 2.0, 3.0, [])],
        "query_id INT, rank INT, title STRING, score DOUBLE, pr DOUBLE, tfidf DOUBLE, "
        "snippets ARRAY<STRING>",
    )
    rows = X.report(results).orderBy("rank").collect()
    assert rows[0].report == (
        "#1 [Cherry]\tScore = 0.25\nPageRank = 0.5, TF-IDF = 1.0E-5\n\tone\n\ttwo\n======\n\n"
    )
    assert rows[1].report == "#2 [B]\tScore = 1.0\nPageRank = 2.0, TF-IDF = 3.0\n======\n\n"
