"""Exact top-k search by inner product as a Voronoi kNN join.

Data are grouped by the nearest of some pivots. A group's summary is its size,
its radius and its longest vector. A query solves the groups whose pivots have
the highest products with it first, enough to hold k others. No member of a
group around p has an inner product above ``q.p + |q| radius``, or above
``|q| longest``; of the other groups only those are needed whose bound reaches
the k-th score found so far, or what the lower bounds ``q.p - |q| radius`` of
the groups promise. A query is sent to the groups it needs and to no others;
there a block of data and a block of queries are solved by one matrix product.

A crowded group is many blocks of bounded size, dealt by the number of the row,
so repeated vectors spread, too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.blocks import Best, arrays, evened, met, packed
from cargolens.session import drop_staged, staged

#: Fewest and most pivots, and vectors and queries of a block.
PIVOTS, MOST_PIVOTS, DATA_BLOCK, QUERY_BLOCK = 64, 256, 2048, 512

#: Shares that the queries of one id are dealt to when they meet its row counts.
SHARES = 16

#: Sums below this are exact in double precision.
EXACT = float(1 << 53)

#: What scores are cut to.
ENDS = -(2.0**63), 2.0**63

SUMMARY = pa.schema([("key", pa.int32()), ("n", pa.int64()), ("radius", pa.float64()), ("longest", pa.float64())])


def nearest(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot and the distance to it, rounded up a little."""
    x = vectors.astype(float)
    squares = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)
    group = squares.argmin(1)
    apart = np.sqrt(((x - pivots[group]) ** 2).sum(1))
    return group, apart * (1 + 1e-9) + 1e-6


def with_own(queries: DataFrame, data: DataFrame) -> DataFrame:
    """``queries`` with ``own``: how many rows of data have the query's id.

    The queries of one id meet its count in several shares, however many they are.
    """
    counts = data.filter("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("own")).filter("own > 1")
    counts = counts.select("id", "own", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share"))
    share = F.pmod(F.xxhash64("vec"), F.lit(SHARES)).cast("int").alias("share")
    met = queries.select("*", share).join(counts, ["id", "share"], "left")
    return met.select(*queries.columns, F.coalesce("own", F.lit(1)).alias("own"))


def needed_cells(
    queries: np.ndarray, pivots: np.ndarray, members: np.ndarray, radius: np.ndarray, k: int,
    own: np.ndarray | None = None, longest: np.ndarray | None = None, least: np.ndarray | None = None,
) -> np.ndarray:
    """True where a cell can hold one of a query's k best others.

    ``own`` is how many members have the query's id (1 unless given, as a query
    may be a member), ``longest`` the length of each cell's longest vector and
    ``least`` a score that k others are known to reach.
    """
    q = queries.astype(float)
    size = np.sqrt((q * q).sum(1))[:, None]
    centre = q @ pivots.T
    # what rounding may have taken from the products
    slack = 1e-12 * size * (np.sqrt((pivots * pivots).sum(1)) + radius) + 1e-3
    reach = size * radius * (1 + 1e-9) + slack
    low, high = centre - reach, centre + reach
    if longest is not None:
        high = np.minimum(high, size * longest * (1 + 1e-9) + slack)
    order = np.argsort(-low, axis=1)
    others = np.ones(len(q), np.int64) if own is None else np.maximum(own, 1)
    enough = np.cumsum(members[order], axis=1) >= (k + others)[:, None]
    first = np.where(enough.any(1), enough.argmax(1), len(members) - 1)
    rows = np.arange(len(q))
    threshold = np.where(enough.any(1), low[rows, order[rows, first]], -np.inf)
    if least is not None:
        floor = least.astype(float)
        # scores are cut at the ends of a long, so the lowest one says nothing
        threshold = np.maximum(threshold, np.where(floor <= ENDS[0], -np.inf, floor - np.abs(floor) * 1e-15))
    return (high >= np.minimum(threshold, ENDS[1])[:, None]) & (members > 0)


@dataclass
class Cells:
    """The pivots and the summaries of their cells."""

    pivots: np.ndarray
    members: np.ndarray
    radius: np.ndarray
    longest: np.ndarray
    k: int

    def first(self, q: np.ndarray) -> np.ndarray:
        """True for the cells of the highest products that hold k others, were the query a member itself."""
        centre = np.where(self.members > 0, q.astype(float) @ self.pivots.T, -np.inf)
        order = np.argsort(-centre, axis=1, kind="stable")
        held = np.cumsum(self.members[order], axis=1)
        before = np.concatenate([np.zeros((len(q), 1), np.int64), held[:, :-1]], axis=1)
        out = np.zeros(centre.shape, bool)
        np.put_along_axis(out, order, before <= self.k, axis=1)
        return out & (self.members > 0)

    def later(self, q: np.ndarray, own: np.ndarray, least: np.ndarray) -> np.ndarray:
        """True for the other cells that can hold a score of ``least`` or more."""
        needed = needed_cells(q, self.pivots, self.members, self.radius, self.k, own, self.longest, least)
        return needed & ~self.first(q)


def summaries(parts: DataFrame, pivots: np.ndarray, width: int, k: int) -> Cells:
    """Size, radius and longest vector of every cell, from the blocks of data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                x = arrays(batch, row, width, np.int64)[2].astype(float)
                key = batch.column("key")[row].as_py()
                far = [float(np.sqrt((y * y).sum(1)).max()) * (1 + 1e-9) + 1e-6 for y in (x - pivots[key], x)]
                yield pa.RecordBatch.from_pylist([{"key": key, "n": len(x), "radius": far[0], "longest": far[1]}], SUMMARY)

    found = parts.mapInArrow(run, "key int, n long, radius double, longest double").groupBy("key")
    cells = Cells(pivots, *(np.zeros(len(pivots), t) for t in (np.int64, float, float)), k)
    for r in found.agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), F.max("longest").alias("longest")).collect():
        cells.members[r.key], cells.radius[r.key], cells.longest[r.key] = r.n, r.radius, r.longest
    return cells


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact inner products; what does not fit a long is cut to its ends."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * queries.shape[1]
    if most < EXACT:
        return np.rint(queries.astype(float) @ data.T.astype(float)).astype(np.int64)
    if most < 2.0**62:
        return queries @ data.T
    exact = queries.astype(object) @ data.T.astype(object)
    ends = np.iinfo(np.int64)
    return np.clip(exact, ends.min, ends.max).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(query, member)`` of each query's k highest scores, ties to smaller ids, its own id left out."""
    out_q, out_m = [], []
    for i in range(len(scores)):
        others = np.flatnonzero(ids != own[i])
        s = scores[i, others]
        if len(s) > k:
            others = others[s >= np.partition(s, len(s) - k)[len(s) - k]]
            s = scores[i, others]
        pick = others[np.lexsort((ids[others], -s.astype(object) if len(s) and s.min() == np.iinfo(np.int64).min else -s))[:k]]
        out_q.append(np.full(len(pick), i))
        out_m.append(pick)
    return np.concatenate(out_q), np.concatenate(out_m)


def solved(queries: DataFrame, data: DataFrame, width: int, k: int) -> DataFrame:
    """``grp, score, id, rid``: the k best that each task finds for a query ``grp``, its own id left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Best(k, pa.int64())
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, asked, q = arrays(batch, row, width, np.int64, "q_")
                ids, numbers, x = arrays(batch, row, width, np.int64)
                scores = products(q, x)
                i, j = best(scores, ids, q_ids, k)
                yield from found.add(asked[i, 0], scores[i, j], ids[j], numbers[j, 0])
        yield from found.rest()

    return met(queries, data).drop("key", "salt", "n").mapInArrow(run, "grp long, score long, id long, rid long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("grp").orderBy(F.desc("score"), F.asc_nulls_last("id"), "rid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(queries: DataFrame, data: DataFrame, k: int = 10, pivots: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k highest inner products.

    Both tables have ``id`` (long) and ``vec`` (array of longs); others are not
    read. Vectors that are null or hold a null take no part; an empty vector is
    all zeros, and so are the components that a shorter one lacks. Rows with
    the query's id are not its candidates. Queries without an id are left out;
    rows that repeat a query's id and vector ask once, and one id with two
    vectors asks for each. Candidates without an id come last among ties.
    Ties go to smaller ids; equal rows each count. Scores are exact.

    ``pivots`` is by default the root of the number of rows, PIVOTS at least and MOST_PIVOTS at most.
    """
    spark = data.sparkSession
    whole = F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull())
    names = ["id", "vec"]
    rows = staged(data.select(*names).filter(whole).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    asked = queries.select(*names).filter(whole & F.col("id").isNotNull()).distinct()
    asked = staged(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    width = max(1, *(t.agg(F.max(F.size("vec"))).first()[0] or 1 for t in (rows, asked)))
    many = pivots or int(min(max(PIVOTS, rows.count() ** 0.5), MOST_PIVOTS))
    near = rows.orderBy(F.xxhash64("id", "vec"), "rid").limit(many).select("vec").collect()
    pivot = np.zeros((max(1, len(near)), width))
    for i, r in enumerate(near):
        pivot[i, : len(r.vec)] = r.vec
    pivot = np.unique(pivot, axis=0)

    parts = staged(packed(rows, ["rid"], width, np.int64, lambda x, _: (np.arange(len(x)), nearest(x, pivot)[0])), "parts")
    cells = summaries(parts, pivot, width, k)
    stored = staged(evened(parts, DATA_BLOCK), "cells")
    asked_blocks = -(-asked.count() // QUERY_BLOCK) or 1
    counted = staged(with_own(asked, rows).repartition(asked_blocks), "counted")
    drop_staged(spark, rows, parts)

    def home(q: np.ndarray, _: np.ndarray):
        return np.nonzero(cells.first(q))

    def others(q: np.ndarray, more: np.ndarray):
        return np.nonzero(cells.later(q, more[:, 1], more[:, 2]))

    first = packed(counted, ["query"], width, np.int64, home, QUERY_BLOCK)
    found = staged(ranked(solved(first, stored, width, k), k), "near")
    least = found.filter(F.col("rank") == k).select(F.col("grp").alias("query"), F.col("score").alias("least"))
    known = counted.join(least, "query", "left").fillna(-(2**63), ["least"]).repartition(asked_blocks)
    second = packed(known, ["query", "own", "least"], width, np.int64, others, QUERY_BLOCK)
    more = staged(solved(second, stored, width, k), "far")
    drop_staged(spark, counted, stored)
    both = ranked(found.drop("rank").unionByName(more), k).withColumnRenamed("grp", "query")
    both = both.join(asked.select("query", F.col("id").alias("query_id")), "query")
    return both.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def scaled(vector, factor: int = 1024):
    """``floor(factor * x)`` of every component as longs; null where one is null or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    odd = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~odd, F.transform(wide, lambda x: F.floor(F.lit(float(factor)) * x).cast("long")))
