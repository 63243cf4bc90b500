from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from cargolens.session import tune
from cargolens.standins import StandIns, oracle_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The text of each oracle before the stand-ins are put in.
TEXTS: dict[str, str] = {}


def query(name: str, sql: str | None = None, tables: Mapping[str, str] | None = None):
    """Register ``fn(t)``; ``tables`` replaces stand-ins for this query."""

    def add(fn: Callable[[StandIns], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(StandIns(tune(spark, sf_dir), sf_dir, tables))
        if sql is not None:
            TEXTS[name] = sql
            ORACLES[name] = oracle_text(sql, tables)
        return fn

    return add
