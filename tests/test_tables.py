import pytest

from linkseek.operators import tables as K
from linkseek.plans.build import SearchTables, answer, build, publish, published
from golden import LINES


@pytest.fixture
def base(spark):
    return spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "key STRING, value STRING")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_put_last_write_wins(spark, base):
    changes = spark.createDataFrame(
        [("b", "x", 1), ("b", "y", 3), ("b", "z", 2), ("d", "n", 0)],
        "key STRING, value STRING, seq BIGINT",
    )
    got = K.put_rows(base, changes, "key", "seq")
    assert rows(got) == [("a", "1"), ("b", "y"), ("c", "3"), ("d", "n")]


def test_put_checks_columns(spark, base):
    changes = spark.createDataFrame([("b", 1, 1)], "key STRING, value INT, seq BIGINT")
    with pytest.raises(ValueError):
        K.put_rows(base, changes, "key", "seq")


def test_delete_and_lookups(spark, base, monkeypatch):
    keys = spark.createDataFrame([("b",), ("z",), ("b",)], "key STRING")
    assert rows(K.delete_rows(base, keys, "key")) == [("a", "1"), ("c", "3")]
    assert K.lookup_strict(base, "key", "b", "value") == "2"
    with pytest.raises(K.MissingKeys):
        K.lookup_strict(base, "key", "z", "value")
    assert rows(K.lookup_many(base, keys, "key", "value")) == [("b", "2")]
    monkeypatch.setattr(K, "MAX_LITERAL_KEYS", 1)
    assert rows(K.lookup_many(base, keys, "key", "value")) == [("b", "2")]
    assert rows(K.missing_keys(base, keys, "key")) == [("z",)]
    with pytest.raises(K.MissingKeys):
        K.require_keys(base, keys, "key")
    K.require_keys(base, keys.where("key = 'b'"), "key")
    assert [tuple(r) for r in K.scan_column(base, "key", "value").collect()] == rows(base)


def test_create_and_drop(spark):
    K.drop_table(spark, "keyed")
    for _ in range(2):
        K.create_table(spark, "keyed", "key STRING, value STRING")
    assert spark.table("keyed").count() == 0
    for _ in range(2):
        K.drop_table(spark, "keyed")
    assert not spark.catalog.tableExists("keyed")


def test_published_tables_answer_alike(spark, work):
    corpus = spark.createDataFrame(list(enumerate(LINES)), "seq BIGINT, value STRING")
    _, tables = build(corpus, work)
    spark.sql("CREATE DATABASE IF NOT EXISTS search_db")
    publish(tables, "search_db")
    publish(tables, "search_db")
    stored = published(spark, "search_db")
    assert isinstance(stored, SearchTables) and stored.n_docs == 6
    queries = spark.createDataFrame([(0, ["red"])], "query_id INT, words ARRAY<STRING>")
    assert rows_of(answer(queries, stored, work)) == rows_of(answer(queries, tables, work))
    spark.sql("DROP DATABASE search_db CASCADE")


def rows_of(df):
    return [
        (r["rank"], r.title, r.snippets) for r in df.orderBy("query_id", "rank").collect()
    ]


def files(spark, name):
    return {"/".join(f.rsplit("/", 2)[1:]) for f in spark.table(name).inputFiles()}


def test_stored_put_and_delete(spark, work):
    """Only the changed keys' buckets are written anew; an emptied one goes."""
    K.drop_table(spark, "kept")
    for _ in range(2):
        K.create_keyed_table(spark, "kept", "key BIGINT, value STRING", "key", buckets=8)
    first = spark.range(200).selectExpr("id AS key", "'old' AS value", "0 AS seq")
    assert K.put_stored(spark, "kept", first, "seq", work).count() == 200
    before = files(spark, "kept")
    changes = spark.createDataFrame([(1, "a", 1), (1, "c", 3), (1, "b", 2)], "key long, value string, seq long")
    got = {r.key: r.value for r in K.put_stored(spark, "kept", changes, "seq", work).collect()}
    assert got == {i: "c" if i == 1 else "old" for i in range(200)}
    after = files(spark, "kept")
    assert len(before - after) == 1 and len(after & before) == 7
    assert K.lookup_stored(spark, "kept", 1, "value").first()["value"] == "c"
    plan = K.lookup_stored(spark, "kept", 1, "value")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_bucket" in plan
    own = spark.table("kept").where("key = 1").first()["key_bucket"]
    gone = {r.key for r in spark.table("kept").where(f"key_bucket = {own}").collect()}
    keys = spark.createDataFrame([(k,) for k in [*gone, *gone, 900]], "key long")
    assert {r.key for r in K.delete_stored(spark, "kept", keys, work).collect()} == set(range(200)) - gone
    assert len(files(spark, "kept")) == 7
    with pytest.raises(ValueError):
        K.put_stored(spark, "kept", changes.withColumnRenamed("value", "other"), "seq", work)
    K.drop_table(spark, "kept")


def test_views_of_versions(spark):
    """A table is always there while it is replaced, and a reader of the old version ends well."""
    K.drop_table(spark, "shown")
    spark.sql("CREATE TABLE shown (key BIGINT) USING parquet")  # of before there were versions
    frames = [spark.range(n).selectExpr("id AS key") for n in (10, 20, 30, 40)]
    assert K.replace_table(frames[0], "shown", "key", buckets=2).count() == 10
    reader = spark.table("shown")
    assert K.replace_table(frames[1], "shown", "key").count() == 20
    assert reader.count() == 10 and spark.table("shown").count() == 20
    # A version may be made of the one before.
    more = spark.table("shown").union(spark.range(100, 101).selectExpr("id AS key"))
    assert K.replace_table(more, "shown", "key").count() == 21
    assert len(K.versions(spark, "shown")) == 2
    K.drop_table(spark, "shown")
    assert not spark.catalog.tableExists("shown") and K.versions(spark, "shown") == []


def test_missing_key_reads_no_rows(spark):
    """Between the smallest and the largest key of every file, a bloom filter rules a missing one out."""
    rows = spark.range(0, 40_000, 2).selectExpr("format_string('key %08d', id) AS title", "id")
    table = K.replace_table(rows, "bloomed", "title", buckets=2)
    assert scanned(K.lookup(table, "title", "key 00010000", "id")) > 0
    assert sum(scanned(K.lookup(table, "title", f"key {i:08d}", "id")) > 0 for i in range(10_001, 10_041, 2)) <= 2
    K.drop_table(spark, "bloomed")


def scanned(df):
    """Rows that the scan hands on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        if "Scan" in node.nodeName():
            return node.metrics().get("numOutputRows").get().value()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
