"""Ordered operators: serial numbers, carry-forward, first row per key.

A large group spreads over many tasks: rows are dealt to ranges of (key, order)
whose bounds come from a sketch of these columns, each range is worked on by
itself, and a table with one row per range whose key began before it links the
ranges. A row's range depends on its values alone, so nothing is staged, no job
runs while the query is built, and a lost executor repeats only its own work.
The input has to give the same rows whenever it is read.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PID = "_range_pid"

#: Ranges at least, and rows of the sketch for each range.
LEAST_RANGES, SKETCH_ROWS = 16, 16


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _direction(c) -> tuple[Column, str]:
    """The column that is sorted by, and the direction: ``asc``, ``desc`` or ``other``."""
    sorted_by = None if isinstance(c, str) else re.fullmatch(r"Column<'(.*) (ASC|DESC) NULLS (FIRST|LAST)'>", repr(c))
    if not sorted_by:
        return _as_col(c), "asc"
    name, way, nulls = sorted_by.groups()
    return F.expr(name), {("ASC", "FIRST"): "asc", ("DESC", "LAST"): "desc"}.get((way, nulls), "other")


def _place(keys: Sequence[str], order_by: Sequence) -> tuple[Column, int]:
    """A struct that sorts like the rows of one key do, or backwards (-1).

    Order columns count as far as their direction is that of the first, nulls
    standing where it puts them by default.
    """
    columns, way = [], None
    for c in order_by:
        column, this = _direction(c)
        way = way or this
        if this != way or this == "other":
            break
        columns.append(column)
    named = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)] + [c.alias(f"o{i}") for i, c in enumerate(columns)]
    return F.struct(*(named or [F.lit(0).alias("all")])), -1 if way == "desc" else 1


def _bounds(df: DataFrame, place: Column, ranges: int) -> DataFrame:
    """One row: the sorted lower bounds of all ranges but the first.

    The sketch is the rows whose hashes are smallest. Those of two tables
    merge to those of both, and a task keeps no more than are wanted in all.
    """
    wanted = ranges * SKETCH_ROWS
    seen = df.select(place.alias("p"))
    sketch = seen.orderBy(F.xxhash64("p")).limit(wanted).agg(F.array_sort(F.collect_list("p")).alias("s"))
    step = F.greatest(F.floor(F.size("s") / ranges).cast("int"), F.lit(1))
    numbers = F.sequence(F.lit(1), F.lit(ranges - 1))
    bounds = F.filter(F.transform(numbers, lambda i: F.get("s", i * step)), lambda b: b.isNotNull())
    return sketch.select(bounds.alias("_range_bounds"))


def _ranged(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """``df`` with the number of each row's range; within a key the numbers grow with the order."""
    ranges = max(LEAST_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    place, way = _place(keys, order_by)
    # one value, of as many bounds as there are ranges
    with_bounds = df.withColumn("_range_bounds", _bounds(df, place, ranges).scalar())
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(ranges.bit_length()))])

    def halve(at: Column, step: Column) -> Column:
        return F.when(F.get("_range_bounds", at + step - 1) <= place, at + step).otherwise(at)

    return with_bounds.withColumn(_PID, F.aggregate(steps, F.lit(0), halve) * way).drop("_range_bounds")


def _link(df: DataFrame, links: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the rows that link ranges; at most one row per range."""
    cond = df[_PID] == links["_link_pid"]
    for i, k in enumerate(keys):
        cond = cond & df[k].eqNullSafe(links[f"_link_key{i}"])
    joined = df.join(F.broadcast(links), cond, "left")
    return joined.drop("_link_pid", *[f"_link_key{i}" for i in range(len(keys))])


def _link_keys(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.select(
        F.col(_PID).alias("_link_pid"),
        *[F.col(k).alias(f"_link_key{i}") for i, k in enumerate(keys)],
        value,
    )


def serial(df: DataFrame, partition_by: Sequence[str], order_by: Sequence, name: str) -> DataFrame:
    """Number rows 1, 2, 3 … within ``partition_by`` in ``order_by`` order.

    End ``order_by`` with a unique column: it makes the numbers repeatable and
    lets the ranges split any group.
    """
    keys = list(partition_by)
    rows = _ranged(df, keys, order_by)
    counts = rows.groupBy(_PID, *keys).agg(F.count(F.lit(1)).alias("_n"))
    # a key has as many rows here as ranges, and only those that are not its first are kept
    before = Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("_range_base", F.sum("_n").over(before)).filter("_range_base is not null")
    own = Window.partitionBy(_PID, *keys).orderBy(*[_as_col(o) for o in order_by])
    out = _link(rows.withColumn("_range_own", F.row_number().over(own)), _link_keys(base, keys, "_range_base"), keys)
    number = F.col("_range_own").cast("long") + F.coalesce("_range_base", F.lit(0))
    return out.withColumn(name, number).drop(_PID, "_range_own", "_range_base")


def carry_forward(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    value: Column,
    name: str,
    include_current: bool = True,
) -> DataFrame:
    """Last non-null ``value`` up to (or strictly before) each row, in ascending order of the columns ``order_by``.

    A struct whose fields are all NULL counts as a value.
    """
    return carry_all_forward(df, partition_by, order_by, {name: value}, include_current)


def carry_all_forward(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], values: Mapping[str, Column], include_current: bool = True
) -> DataFrame:
    """The same for several values, each under its name, in one go; the names may be those of columns."""
    keys = list(partition_by)
    last_row = 0 if include_current else -1
    held = {n: f"_range_value{i}" for i, n in enumerate(values)}
    rows = _ranged(df.withColumns({h: values[n] for n, h in held.items()}), keys, order_by)
    place = F.struct(*order_by)
    ends = rows.groupBy(_PID, *keys).agg(*[F.max_by(h, F.when(F.col(h).isNotNull(), place)).alias(h) for h in held.values()])
    before = Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(_PID, *keys, F.struct(*[F.last(h, ignorenulls=True).over(before).alias(h) for h in held.values()]).alias("_range_carried"))
    carried = carried.filter(reduce(or_, [F.col(f"_range_carried.{h}").isNotNull() for h in held.values()]))
    own = Window.partitionBy(_PID, *keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, last_row)
    out = rows.withColumns({f"{h}_own": F.last(h, ignorenulls=True).over(own) for h in held.values()})
    out = _link(out, _link_keys(carried, keys, "_range_carried"), keys)
    kept = [c for c in df.columns if c not in held]
    return out.select(*kept, *[F.coalesce(f"{h}_own", f"_range_carried.{h}").alias(n) for n, h in held.items()])


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row of each key; an aggregate, so rows combine before the shuffle."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order_by)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*")
