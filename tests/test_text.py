import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from linkseek.functions import text as T
from linkseek.operators import documents as D

# Line fragments and what they must give (see FIXTURES.md).
LINKS = "[[abc|x]] [[#sec]] [[A#b]] [[File:x|t|[[in]]]] [[a]b]] [[]] [[q]]"
LINK_NAMES = ["Abc", "#sec", "A", "File:x", "In", "A]b", "]] [[q"]


def lines(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "seq BIGINT, value STRING")


def column(spark, expression, value):
    return spark.createDataFrame([(value,)], "value STRING").select(expression.alias("x")).first().x


@pytest.mark.parametrize(
    "raw, want",
    [
        ("foo &amp;lt; bar &amp;quot;", 'Foo &lt; bar "'),
        ("élan", "élan"),
        ("Éa", "Éa"),
        ("a", "A"),
        ("zebra", "Zebra"),
        ("Already", "Already"),
        ("9 lives", "9 lives"),
        ("{brace", "{brace"),
        ("`tick", "`tick"),
        ("&lt;b&gt; &apos;q&apos;", "<b> 'q'"),
    ],
)
def test_names(spark, raw, want):
    assert column(spark, T.normalize_name(F.col("value")), raw) == want


def test_links(spark):
    corpus = lines(spark, f"<title>t</title><text>{LINKS}</text>")
    got = D.link_rows(D.linked_titles(corpus)).collect()
    assert [r.dst_title for r in got] == LINK_NAMES
    assert {r.src_title for r in got} == {"T"}


def test_links_outside_the_text_count(spark):
    corpus = lines(spark, "<title>t</title>[[x]]<text>a [[y]]</text>[[z]]")
    got = D.link_rows(D.linked_titles(corpus)).collect()
    assert [r.dst_title for r in got] == ["X", "Y", "Z"]


def test_empty_text(spark):
    corpus = lines(
        spark,
        '<title>a</title><text xml:space="preserve" />',
        "<title>b</title><text></text> later <br/>",
        "<title>c</title><text>body</text>",
    )
    got = D.documents(corpus).orderBy("seq").collect()
    assert [(r.title, r.raw_text) for r in got] == [("A", ""), ("B", ""), ("C", "body")]


BAD = [
    "no title <text>x</text>",
    "<title>t</title><text></text>",
    "<title>t</title> no text",
    "<title></title><text>x</text>",
]


@pytest.mark.parametrize("line", BAD)
def test_bad_lines_raise(spark, line):
    with pytest.raises(PySparkException):
        D.documents(lines(spark, line)).collect()


def test_bad_lines_split(spark):
    good = "<title>t</title><text>x</text>"
    corpus = lines(spark, *BAD, good)
    bad = {r.seq: r.reason for r in D.bad_lines(corpus).collect()}
    assert bad == {0: D.NO_TITLE, 1: D.NO_BODY, 2: D.NO_BODY, 3: D.NO_TITLE}
    assert [r.value for r in D.good_lines(corpus).collect()] == [good]


def test_title_needs_no_text(spark):
    """Ranking reads titles and links only; a missing text is no error there."""
    assert D.titles(lines(spark, "<title>t</title> [[u]]")).first().title == "T"


def test_last_text_wins(spark, work):
    corpus = lines(
        spark, "<title>a</title><text>one &lt;</text>", "<title>A</title><text>two &amp;</text>"
    )
    got = D.latest_documents(D.documents(corpus), work).collect()
    assert [(r.title, r.text) for r in got] == [("A", "two &")]
    assert [tuple(r) for r in D.repeated_titles(D.documents(corpus)).collect()] == [("A", 2)]


def test_encode_is_undone_by_decode(spark):
    raw = "a < b & c > \"d\" 'e' &amp; &lt;"
    assert column(spark, T.encode_entities(F.col("value")), "<&>") == "&lt;&amp;&gt;"
    coded = column(spark, T.encode_entities(F.col("value")), "a < b > \"d\" 'e'")
    assert column(spark, T.decode_entities(F.col("value")), coded) == "a < b > \"d\" 'e'"
    assert "<" not in column(spark, T.encode_entities(F.col("value")), raw)


def test_mask_keeps_length(spark):
    masked = column(spark, T.mask_non_letters(F.col("value")), "a1é_Z\t-b")
    assert masked == "a   Z  b"
