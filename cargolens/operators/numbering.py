"""Sequence numbers and instalment counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.operators.ordered import serial


def assign_sequence(df: DataFrame, order_by: Sequence, name: str = "sequence_no", base: int = 0) -> DataFrame:
    """Consecutive numbers after ``base`` over the whole table."""
    numbered = serial(df, [], order_by, "_n")
    return numbered.withColumn(name, F.col("_n") + F.lit(base)).drop("_n")


def instalments(
    sends: DataFrame, prior: DataFrame, keys: Sequence[str], order_by: str
) -> tuple[DataFrame, DataFrame]:
    """Number of each send, and the counters afterwards.

    A send prints the stored counter, or 1 without one; then the counter goes
    up by one, or a new one starts at 1. So a fresh key prints 1, 1, 2, 3, …
    A NULL in the key matches nothing: such a send prints 1 and adds a row.
    """
    keys = list(keys)
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    numbered = serial(sends.filter(complete), keys, [order_by], "_n")
    stored = prior.filter(complete).select(*keys, F.col("instalment_no").alias("_stored"), F.lit(True).alias("_known"))
    joined = numbered.join(stored, keys, "left")
    printed = F.when(F.col("_known"), F.coalesce(F.col("_stored") + F.col("_n") - 1, F.lit(1))).otherwise(
        F.greatest(F.col("_n") - 1, F.lit(1))
    )
    loose = sends.filter(~complete)
    out = joined.withColumn("instalment_no", printed.cast("long")).drop("_n", "_stored", "_known")
    out = out.unionByName(loose.withColumn("instalment_no", F.lit(1).cast("long")))

    counted = sends.filter(complete).groupBy(*keys).agg(F.count(F.lit(1)).alias("_sent"))
    old = prior.filter(complete).select(*keys, F.col("instalment_no").cast("long").alias("_stored"), F.lit(True).alias("_known"))
    merged = old.join(counted, keys, "full")
    after = F.when(F.col("_known"), F.col("_stored") + F.coalesce("_sent", F.lit(0))).otherwise(F.col("_sent"))
    state = merged.select(*keys, after.alias("instalment_no"))
    one = F.lit(1).cast("long").alias("instalment_no")
    kept = prior.filter(~complete).select(*keys, F.col("instalment_no").cast("long").alias("instalment_no"))
    return out, state.unionByName(kept).unionByName(loose.select(*keys, one))
