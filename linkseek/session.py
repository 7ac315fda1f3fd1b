"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, **settings: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the session it gives."""
    settings = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **settings,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("linkseek")
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
