import pytest
from oracle import connect, differences

from __spark_entry__ import entry
from linkseek.plans.oracle import ORACLE
from linkseek.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["query_id", "rank", "title", "snippets"] and df.count() > 0
