"""Shared-folder tables that cut lineage between stages."""

from __future__ import annotations

import itertools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: where checkpoints go, or as the session names it.

    A folder of our own is made only for a local master with none configured.
    """
    configured = spark.sparkContext.getCheckpointDir()
    configured = configured or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="linkseek-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


# What makes Spark delete an execution's shuffle files at its end.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_MADE: list[Workspace] = []


def delete_all() -> None:
    """Delete the tables of all runs so far, once their results are stored elsewhere."""
    while _MADE:
        _MADE.pop().delete()


class Workspace:
    """One run's tables under the shared folder.

    A saved table is written once and read back: later plans start from files, so a lost
    executor costs a re-read, and Catalyst sees the table's true size when it picks joins.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/linkseek-{uuid.uuid4().hex}"
        self._numbers = itertools.count()
        _MADE.append(self)

    def fresh(self, name: str) -> str:
        """A path not used before, so no earlier result loses the files it reads."""
        return f"{self.path}/{next(self._numbers)}-{name}"

    def save(self, df: DataFrame, name: str, by: str | None = None, tidy: bool = False) -> DataFrame:
        """The saved table; with `by`, in a folder for each value of that column, which readers of one
        value don't look beyond.

        With `tidy`, the shuffle files that it took go as soon as it is written, not when the driver
        happens to collect its garbage.
        """
        if not tidy:
            return self.write(df, self.fresh(name), by)
        before = self.spark.conf.get(TIDY, None)
        self.spark.conf.set(TIDY, "true")
        try:
            return self.write(df, self.fresh(name), by)
        finally:
            if before is None:
                self.spark.conf.unset(TIDY)
            else:
                self.spark.conf.set(TIDY, before)

    def delete(self) -> None:
        """Delete this run's tables; nothing may read them any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def write(self, df: DataFrame, path: str, by: str | None = None) -> DataFrame:
        df.write.mode("overwrite").parquet(path, partitionBy=by)
        return self.spark.read.schema(df.schema).parquet(path)
