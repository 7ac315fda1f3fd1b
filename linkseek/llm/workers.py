"""Python workers find this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = str(Path(__file__).resolve().parents[2])


def reach(spark: SparkSession) -> SparkSession:
    """Let Python workers search the folder that holds the package, as the driver does.

    That is enough where they see the same folder; elsewhere the package is sent with --py-files.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), _ROOT])
    return spark
