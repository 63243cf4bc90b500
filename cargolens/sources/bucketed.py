"""Tables kept in buckets of a key, so that joins and reductions on that key need no shuffle.

Each table is written once, dealt by the hash of its own key column. Tables of
one bucket count whose keys have one type meet bucket by bucket from then on,
whatever their key columns are called. Where another side of a join has to be
shuffled, Spark keeps the buckets if they are no fewer than the session's shuffle
partitions; with as many, nothing is shuffled twice. Other queries read them as any table.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """``df`` as the catalog table ``name`` under ``path``, a file per bucket of ``key``, rows in order of it.

    A table or a filled folder of that name is refused. Rows without a key are
    kept; they lie in one bucket, and a join passes over them by statistics.
    """
    if buckets < 1:
        raise ValueError("a table has one bucket or more")
    # the shuffle deals by the same hash as the buckets, so each is one file
    dealt = df.repartition(buckets, F.col(key))
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("error").saveAsTable(name)
    return df.sparkSession.table(name)


def store(
    t: Mapping[str, DataFrame], keys: Mapping[str, str], prefix: str, buckets: int, folder: str
) -> Mapping[str, DataFrame]:
    """``t`` with the tables of ``keys`` (table: key column) written in buckets as ``prefix`` and their name."""
    written = {n: write_bucketed(t[n], f"{prefix}{n}", key, buckets, f"{folder}/{n}") for n, key in keys.items()}
    return ChainMap(written, t)


def stored(spark: SparkSession, t: Mapping[str, DataFrame], keys: Mapping[str, str], prefix: str) -> Mapping[str, DataFrame]:
    """``t`` with those tables as ``store`` left them."""
    return ChainMap({n: spark.table(f"{prefix}{n}") for n in keys}, t)
