"""Compare registered queries with their SQL on the given tables.

Run as a script: `python tests/oracle.py FOLDER [query ...]`.
"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


# Spark type to DuckDB type.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.12g}"
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql):
    """None if both give the same columns and rows, else a short description."""
    got_rows = [tuple(r) for r in df.collect()]
    relation = con.execute(sql)
    columns = [c[0] for c in relation.description]
    want_rows = relation.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    types = {c[0]: str(c[1]) for c in relation.description}
    wrong = [c for c, t in df.dtypes if TYPES.get(t) != types[c]]
    if wrong:
        return f"types of {wrong}: {dict(df.dtypes)} against {types}"
    got, want = _rows(df.columns, got_rows), _rows(columns, want_rows)
    if got == want:
        return None
    extra, lost = set(got) - set(want), set(want) - set(got)
    return f"{len(got)} rows against {len(want)}; extra {list(extra)[:2]}, lost {list(lost)[:2]}"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from linkseek.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = connect(folder), oracle_sql()
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            n = df.count()
            spent = time.time() - start
            result = differences(df, con, oracle[name]) if name in oracle else "no sql"
        except Exception as error:  # report and go on
            result, spent, n = f"{type(error).__name__}: {str(error)[:600]}", 0, -1
        print(f"{name:24s} {n:8d} rows {spent:6.1f}s  {result or 'same'}", flush=True)
