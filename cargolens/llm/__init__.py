"""Operators for preparing language-model training data."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def reachable(spark: SparkSession) -> None:
    """Let Python workers import the package from where the driver did, whatever their working folder.

    On a cluster without the package at that place, ship it as usual (``--py-files``).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    workers = spark.sparkContext.environment
    paths = [p for p in workers.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        workers["PYTHONPATH"] = os.pathsep.join([*paths, root])
