import pytest
from golden import LINES, POSTINGS
from pyspark.errors import PySparkException

from linkseek.operators import documents as D
from linkseek.operators import index as I
from linkseek.sources import files as L


@pytest.fixture
def tf(spark):
    rows = [
        (word, int(entry.split()[0]), int(entry.split()[1]))
        for word, entries in POSTINGS.items() for entry in entries.split(";")
    ]
    return spark.createDataFrame(rows, "word STRING, doc_id BIGINT, tf BIGINT")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_corpus_file(spark, work, tmp_path):
    (tmp_path / "corpus.txt").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    lines = L.read_lines(spark, str(tmp_path))
    assert [r.value for r in lines.orderBy("seq").collect()] == LINES
    assert D.documents(lines).count() == 6


def test_rank_lines(spark, tmp_path):
    ranks = spark.createDataFrame([("B c", 0.5), ("A", 1e-7)], "title STRING, pr DOUBLE")
    path = str(tmp_path / "ranks")
    L.write_lines(L.rank_lines(ranks), path)
    L.write_lines(L.rank_lines(ranks), path)
    assert rows(L.parse_rank_lines(spark.read.text(path))) == rows(ranks)


def test_rank_line_with_two_tabs_raises(spark):
    lines = spark.createDataFrame([("a\tb\t1.0",)], "value STRING")
    with pytest.raises(PySparkException, match="tab"):
        L.parse_rank_lines(lines).collect()


def test_id_lines(spark):
    ids = spark.createDataFrame([(0, "A"), (1, "B\tc")], "doc_id BIGINT, title STRING")
    assert rows(L.parse_id_lines(L.id_lines(ids))) == rows(ids)
    broken = spark.createDataFrame([("no tab",), ("7\tok",)], "value STRING")
    assert rows(L.parse_id_lines(broken)) == [(7, "ok")]


def test_tf_lines(spark, tf):
    assert rows(L.parse_tf_lines(L.tf_lines(tf))) == rows(tf)


@pytest.mark.parametrize("block", [1, 2, 65_536])
def test_posting_lines(spark, tf, block, tmp_path):
    """A word's rows in block order are its list, whatever the block size."""
    lists = I.postings(tf, block)
    lines = [r.value for r in L.posting_lines(lists).collect()]
    whole = {}
    for line in lines:
        word, entries = line.split("\t")
        whole.setdefault(word, []).append(entries)
    assert {word: ";".join(parts) for word, parts in whole.items()} == POSTINGS
    assert list(whole) == sorted(POSTINGS)
    path = str(tmp_path / "postings")
    L.write_single_file(L.posting_lines(lists), path)
    assert rows(L.parse_posting_lines(spark.read.text(path))) == rows(tf)


def test_input_files(spark, work, tmp_path):
    """Files of the same name in two folders are two files."""
    for name in ("b", "a"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.txt").write_text("x\n" * (1 + (name == "b")))
    got = L.input_files([spark.read.text(str(tmp_path / name)) for name in ("b", "a")], work)
    assert [(i, p.split("/")[-2], n) for i, p, n in rows(got)] == [(1, "a", 1), (2, "b", 2)]


def test_lines_follow_the_files(spark, work, tmp_path):
    """A small file before a large one, which Spark reads first and in several splits."""
    (tmp_path / "a.txt").write_text("first\n")
    (tmp_path / "b.txt").write_text("".join(f"line {i:05d}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = {r.seq: r.value for r in L.numbered_lines(spark, str(tmp_path), work).collect()}
        keyed = [r.value for r in L.read_lines(spark, str(tmp_path)).orderBy("seq").collect()]
        last = D.latest_documents(_titled(L.read_lines(spark, str(tmp_path))), work).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = ["first", *(f"line {i:05d}" for i in range(5000))]
    assert got == dict(enumerate(want)) and keyed == want
    assert sorted(r.text for r in last) == ["first", *(f"line {i:05d}" for i in range(4990, 5000))]


def _titled(lines):
    """Lines under a title for each last digit."""
    return lines.selectExpr("seq", "concat('T', right(value, 1)) AS title", "value AS raw_text")


def test_single_file_beyond_its_limit(spark, tmp_path, monkeypatch):
    """Small results are one file, larger ones ordered parts that make up the same file."""
    lines = spark.range(5000).selectExpr("format_string('%06d', 4999 - id) as value").orderBy("value")
    want = [f"{i:06d}" for i in range(5000)]
    L.write_single_file(lines, str(tmp_path / "one"))
    one = list((tmp_path / "one").glob("part-*.txt"))
    assert len(one) == 1 and one[0].read_text().split() == want
    monkeypatch.setattr(L, "SINGLE_FILE_ROWS", 100)
    path = tmp_path / "parts"
    L.write_single_file(lines.repartitionByRange(3, "value").sortWithinPartitions("value"), str(path))
    manifest = sorted(L.read_manifest(spark, str(path)).collect())
    assert len(manifest) > 1
    whole, n_lines = b"", 0
    for row in manifest:
        assert (row.first_byte, row.first_line) == (len(whole), n_lines)
        part = (path / row.part).read_bytes()
        assert len(part) == row.n_bytes and part.count(b"\n") == row.n_lines
        whole, n_lines = whole + part, n_lines + row.n_lines
    assert whole == one[0].read_bytes()
    assert rows(L.read_export(spark, str(path))) == list(enumerate(want))
    assert spark.read.text(str(path)).count() == 5000


def test_export_of_nothing(spark, tmp_path):
    L.export_lines(spark.createDataFrame([], "value string"), str(tmp_path / "none"))
    assert L.read_export(spark, str(tmp_path / "none")).collect() == []


@pytest.mark.parametrize("broken", [[], ["no title", "<title>T</title> no text"]])
def test_lines_are_cut_once(spark, work, broken):
    lines = spark.createDataFrame(list(enumerate(LINES + broken)), "seq long, value string")
    good, bad = D.cut_lines(lines, work, strict=False)
    assert rows(good.select("seq", "title", "raw_text")) == rows(
        D.documents(lines.where(f"seq < {len(LINES)}")).select("seq", "title", "raw_text"))
    assert rows(bad.select("value", "reason")) == sorted(zip(broken, [D.NO_TITLE, D.NO_BODY]))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(broken" in plan and "regexp" not in plan
    if broken:
        with pytest.raises(PySparkException, match=D.NO_TITLE):
            D.cut_lines(lines, work)
    else:
        assert rows(D.cut_lines(lines, work)[0]) == rows(good)


def test_bad_rank_lines(spark):
    lines = spark.createDataFrame([("a\t1",), ("b\tx\t2",), ("c",)], "value string")
    assert rows(L.bad_rank_lines(lines)) == [("b\tx\t2",)]
