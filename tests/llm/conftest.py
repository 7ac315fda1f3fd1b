import duckdb
import pytest
from samples import FOLDER, ODD, ODD_ROWS

from linkseek.llm.workers import reach


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    return reach(spark)


@pytest.fixture(scope="session")
def texts():
    con = duckdb.connect()
    return [r[0] for r in con.execute(f"SELECT text FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns of clashing names."""
    return spark.createDataFrame([(*r, 1, 2, "k") for r in ODD_ROWS], ODD).repartition(3)


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], ODD)
