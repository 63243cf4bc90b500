"""Grouped measures; all combine on the map side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.text import blank_to_null


def group_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(e).alias(n) for n, e in sums.items()])


def status_counts(df: DataFrame, status: str, counts: Mapping[str, str], total: str) -> DataFrame:
    """Total and per-status counts in one pass."""
    wanted = [F.count_if(F.col(status) == v).alias(n) for n, v in counts.items()]
    return df.agg(F.count(F.lit(1)).alias(total), *wanted)


def signed_ledger(amount: Column, dr_cr: Column, plus_side: str, applies: Column) -> Column:
    """Sum with + on one side and − on the other; other rows count as 0."""
    minus_side = "DR" if plus_side == "CR" else "CR"
    signed = (
        F.when(applies & (dr_cr == plus_side), amount)
        .when(applies & (dr_cr == minus_side), -amount)
        .otherwise(F.lit(0))
    )
    return F.sum(signed)


def margin_pct(revenue: Column, cost: Column) -> Column:
    """Gross profit in percent of revenue; 0 without revenue."""
    rev, cst = revenue.cast("double"), cost.cast("double")
    return F.when(rev == 0, F.lit(0.0)).otherwise((rev - cst) / F.nullif(rev, F.lit(0.0)) * 100)


def container_rollup(df: DataFrame, keys: Sequence[str], teu: str, tare_kg: str) -> DataFrame:
    """TEU sum, and tare in tonnes with blank weights as 0."""
    kg = F.coalesce(blank_to_null(F.col(tare_kg)).try_cast("decimal(18,3)"), F.lit(0))
    return df.groupBy(*keys).agg(
        F.sum(F.col(teu).try_cast("decimal(18,3)")).cast("decimal(18,0)").alias("teu"),
        (F.sum(kg) / 1000).cast("decimal(18,1)").alias("tare_mt"),
    )


def presence_split(parent: DataFrame, child: DataFrame, key: str, fk: str, group: Sequence[str]) -> DataFrame:
    """Parents with and without children, counted per group."""
    has = child.select(F.col(fk).alias("_fk")).distinct().withColumn("_has", F.lit(1))
    joined = parent.join(has, F.col(key) == F.col("_fk"), "left")
    return joined.groupBy(*group).agg(
        F.count_if(F.col("_has").isNotNull()).alias("with_children"),
        F.count_if(F.col("_has").isNull()).alias("without_children"),
    )


def next_id(df: DataFrame, column: str) -> Column:
    """Largest id plus one, 1 for an empty table."""
    return df.agg((F.coalesce(F.max(column), F.lit(0)) + 1).cast("long").alias("v")).scalar()
