"""Files laid out so that ranges of several columns prune row groups.

Each column is cut into ranges of about equal numbers of rows, by bounds from a
sample of rows of fixed size, and rows follow a curve that interleaves the bits
of these range numbers. Neighbours on the curve are near in every column, so a
row group spans a small part of each, and its statistics rule it out for most
ranges of any of them. Sorting by one column serves that one alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a column's range number, and rows that the bounds are taken from.
BITS, SAMPLE_ROWS = 6, 8192

#: Timestamps of the default kind have no statistics.
TIMESTAMPS = "spark.sql.parquet.outputTimestampType"


def bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Per column up to ``2 ** bits - 1`` distinct bounds, in order, with about as many rows between any two.

    The sample is the rows whose hashes are smallest; a task keeps no more than are wanted in all.
    """
    names = [f"c{i}" for i in range(len(columns))]
    seen = df.select(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)])
    chance = F.xxhash64(F.monotonically_increasing_id(), *names)
    sample = seen.withColumn("chance", chance).orderBy("chance").limit(SAMPLE_ROWS)
    row = sample.agg(*[F.array_sort(F.collect_list(n)).alias(n) for n in names]).first()
    out, ranges = {}, 1 << bits
    for column, name in zip(columns, names, strict=True):
        values = row[name]
        picked = [values[len(values) * i // ranges] for i in range(1, ranges)] if values else []
        out[column] = [v for i, v in enumerate(picked) if i == 0 or v != picked[i - 1]]
    return out


def range_number(df: DataFrame, column: str, cuts: list) -> Column:
    """How many bounds are not above the value; 0 for null."""
    kind = df.schema[column].dataType.simpleString()
    if not cuts:
        return F.lit(0).cast("long")
    listed = F.array(*[F.lit(c) for c in cuts]).cast(f"array<{kind}>")
    below = F.size(F.filter(listed, lambda c: c <= F.col(column)))
    return F.when(F.col(column).isNull(), 0).otherwise(below).cast("long")


def interleaved(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """One long from the bits of all numbers, the highest of each first."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for at, number in enumerate(numbers):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(one, bit * len(numbers) + at))
    return out


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, mode: str = "errorifexists", group_bytes: int | None = None
) -> None:
    """Write ``df`` as Parquet along a curve over ``columns`` (up to 10 of them, of any type with an order).

    ``files`` is by default left to Spark, ``group_bytes`` is the size of a row
    group. Columns and rows are kept as they are, repeated rows and nulls
    too; many rows of one value spread over files by their number. The input is
    read for the sample, for Spark's ranges and for the rows.
    """
    if not 1 <= len(columns) <= 10:
        raise ValueError("cluster by 1 to 10 columns")
    spark = df.sparkSession
    cuts = bounds(df, columns)
    free = "_"
    while any(c.lower().startswith(free) for c in df.columns):
        free += "_"
    numbers = [f"{free}n{i}" for i in range(len(columns))]
    place, row = f"{free}place", f"{free}row"
    dealt = df.select("*", *[range_number(df, c, cuts[c]).alias(n) for c, n in zip(columns, numbers, strict=True)])
    dealt = dealt.select(*[F.col(f"`{c}`") for c in df.columns], interleaved([F.col(n) for n in numbers]).alias(place))
    dealt = dealt.withColumn(row, F.monotonically_increasing_id())
    order = [place, *columns, row]
    laid = dealt.repartitionByRange(files, *order) if files else dealt.repartitionByRange(*order)
    laid = laid.sortWithinPartitions(*order).drop(place, row)
    before = spark.conf.get(TIMESTAMPS)
    spark.conf.set(TIMESTAMPS, "TIMESTAMP_MICROS")
    try:
        writer = laid.write.mode(mode)
        (writer.option("parquet.block.size", group_bytes) if group_bytes else writer).parquet(path)
    finally:
        spark.conf.set(TIMESTAMPS, before)
