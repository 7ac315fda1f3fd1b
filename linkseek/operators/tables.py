"""Keyed tables: create, put, delete, look up, scan, replace."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkseek.workspace import Workspace

# Folders of a keyed table, and the column that tells them.
KEY_BUCKETS = 16
BUCKET = "key_bucket"

# Between a table's name and the number of a version.
_VERSION = "__v"

# Most key values passed as literals, which parquet can prune by; beyond it keys are joined.
MAX_LITERAL_KEYS = 1000


class MissingKeys(KeyError):
    """A requested key has no row."""


def create_table(spark: SparkSession, name: str, schema: str) -> None:
    """Create an empty table unless one is there already."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table, or a view of versions with all of them."""
    if _is_view(spark, name):
        spark.sql(f"DROP VIEW {name}")
        _drop_versions(spark, name, kept=0)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_table(
    df: DataFrame, name: str, *key: str, buckets: int | None = None, ordered: bool = False
) -> DataFrame:
    """Write `df` as the next version of `name`, sorted by `key` so that lookups read few files, and
    then turn the view `name` to it; readers always find one version or the other.

    With `buckets`, for unique keys, rows are hashed and a lookup opens only its keys'
    buckets. Without, rows are split by range: a frequent first key spans several files when
    a finer key follows it. `ordered` rows lie that way already and are only written. Bloom filters
    of the first key let lookups of missing keys read no rows.
    """
    if ordered:
        writer = df.write
    elif buckets:
        writer = df.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key)
    else:
        writer = df.repartitionByRange(*key).sortWithinPartitions(*key).write
    if key:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key[0]}", "true").option(
            "parquet.bloom.filter.adaptive.enabled", "true"
        )
    version = f"{name}{_VERSION}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    writer.format("parquet").saveAsTable(version)
    return switch_view(df.sparkSession, name, version)


def switch_view(spark: SparkSession, name: str, version: str) -> DataFrame:
    """Let `name` be a view of table `version`, in one step; of earlier versions only the last
    is kept, for those who still read it."""
    if spark.catalog.tableExists(name) and not _is_view(spark, name):
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    _drop_versions(spark, name, kept=2)
    return spark.table(name)


def versions(spark: SparkSession, name: str) -> list[str]:
    """The stored versions behind a view, oldest first."""
    database, _, table = name.rpartition(".")
    within = f" IN {database}" if database else ""
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES{within} LIKE '{table}{_VERSION}*'").collect()]
    return [f"{database}.{x}" if database else x for x in sorted(found)]


def _drop_versions(spark: SparkSession, name: str, kept: int) -> None:
    old = versions(spark, name)
    for version in old[: len(old) - kept]:
        spark.sql(f"DROP TABLE IF EXISTS {version}")


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def check_columns(base: DataFrame, changes: DataFrame) -> None:
    """Names and types to be written must be those of the table."""
    want = {(f.name, f.dataType) for f in base.schema}
    have = {(f.name, f.dataType) for f in changes.schema}
    if want != have:
        raise ValueError(f"columns do not match: {sorted(n for n, _ in want ^ have)}")


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest `order` of every key.

    Spark keeps one row per key in each task before the exchange, so a key with very many
    rows arrives as one row per task.
    """
    newest = W.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def put_rows(base: DataFrame, changes: DataFrame, key: str, order: str) -> DataFrame:
    """`base` with `changes` written over it; the last write of a key wins.

    Only the changes are sorted out by key; rows of `base` without a change stay as they are.
    """
    columns = [c for c in changes.columns if c != order]
    check_columns(base, changes.select(columns))
    put = last_per_key(changes, key, order).select(base.columns)
    return delete_rows(base, put, key).unionByName(put)


def delete_rows(base: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return base.join(keys.select(key).distinct(), key, "left_anti")


def create_keyed_table(spark: SparkSession, name: str, schema: str, key: str, buckets: int = KEY_BUCKETS) -> None:
    """Create an empty table of unique keys, kept in `buckets` folders by a hash of the key, unless it
    is there already. The table itself knows its key and number of buckets."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET})"
        f" TBLPROPERTIES ('key' = '{key}', 'buckets' = '{buckets}')"
    )


def _layout(spark: SparkSession, name: str) -> tuple[str, Column]:
    """Key of a keyed table, and the bucket of a row."""
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    key, buckets = kept["key"], int(kept["buckets"])
    typed = F.col(key).cast(spark.table(name).schema[key].dataType)
    return key, F.pmod(F.xxhash64(typed), F.lit(buckets)).cast("int")


def _rewrite(spark: SparkSession, name: str, changes: DataFrame, change, work: Workspace) -> DataFrame:
    """Write the buckets that `changes` have keys of anew, as `change` makes them of the old; files of
    all others stay as they are.

    The new rows are saved before old ones go. At most one number per bucket comes to the driver.
    """
    key, bucket = _layout(spark, name)
    changes = work.save(changes.withColumn(BUCKET, bucket), "changes")
    touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]
    old = spark.table(name).where(F.col(BUCKET).isin(touched))
    new = work.save(change(old, changes, key), "changed-buckets")
    left = {r[0] for r in new.select(BUCKET).distinct().collect()}
    rows = new.repartition(BUCKET).sortWithinPartitions(key).select(spark.table(name).columns)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # insertInto knows it from the session alone
    try:
        rows.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    for emptied in sorted(set(touched) - left):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({BUCKET} = {emptied})")
    return keyed_rows(spark, name)


def keyed_rows(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a keyed table."""
    return spark.table(name).drop(BUCKET)


def put_stored(spark: SparkSession, name: str, changes: DataFrame, order: str, work: Workspace) -> DataFrame:
    """Write rows over those of a keyed table; the last write of a key, by `order`, wins."""
    return _rewrite(
        spark, name, changes, lambda old, new, key: put_rows(old, new, key, order), work
    )


def delete_stored(spark: SparkSession, name: str, keys: DataFrame, work: Workspace) -> DataFrame:
    """Delete rows of a keyed table by key."""
    return _rewrite(spark, name, keys, delete_rows, work)


def lookup_stored(spark: SparkSession, name: str, value, column: str) -> DataFrame:
    """One cell of a keyed table: reads its key's bucket alone."""
    key, bucket = _layout(spark, name)
    own = spark.range(1).select(F.lit(value).alias(key)).select(bucket).first()[0]
    return lookup(spark.table(name).where(F.col(BUCKET) == own), key, value, column)


def lookup(table: DataFrame, key: str, value, column: str) -> DataFrame:
    """One cell by key; the equality reaches the file scan."""
    return table.where(F.col(key) == F.lit(value)).select(key, column)


def lookup_strict(table: DataFrame, key: str, value, column: str):
    """The cell's value; a missing key raises."""
    row = lookup(table, key, value, column).first()
    if row is None:
        raise MissingKeys(value)
    return row[column]


def literal_keys(keys: DataFrame, key: str) -> list | None:
    """The distinct keys if there are few enough to pass as literals."""
    few = keys.select(key).distinct().limit(MAX_LITERAL_KEYS + 1).collect()
    return [r[0] for r in few] if len(few) <= MAX_LITERAL_KEYS else None


def lookup_many(table: DataFrame, keys: DataFrame, key: str, *columns: str) -> DataFrame:
    """Rows of all `keys`: by pruned scan for few keys, by join for many."""
    chosen = table.select(key, *columns)
    few = literal_keys(keys, key)
    if few is not None:
        return chosen.where(F.col(key).isin(few))
    return chosen.join(keys.select(key), key, "left_semi")


def missing_keys(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return keys.select(key).distinct().join(table.select(key).distinct(), key, "left_anti")


def require_keys(table: DataFrame, keys: DataFrame, key: str) -> None:
    """Raise if any requested key has no row."""
    absent = missing_keys(table, keys, key).first()
    if absent is not None:
        raise MissingKeys(absent[0])


def scan_column(table: DataFrame, key: str, column: str) -> DataFrame:
    """One column with its key, in key order; the scan reads nothing else."""
    return table.select(key, column).orderBy(key)
