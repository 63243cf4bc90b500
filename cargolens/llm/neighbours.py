"""Approximate nearest neighbours by cross-polytope hashing.

A table's hash of a vector is the signed axis that lies nearest to it after a
pseudo-rotation: three times random signs and a fast Hadamard transform. Every
row is in one bucket of each table. A query probes several buckets of every
table, those whose axes lie nearest to it over all tables first; what it meets
there is scored exactly.

How many buckets a query probes is fitted: for a bounded sample of queries the
true nearest rows are found among all rows, and the probes are the fewest that
reach the wanted recall on them. All rows are indexed and all queries probe alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.blocks import Best, arrays, evened, matrix, met, packed
from cargolens.session import drop_staged, staged

#: Hash tables, and queries and recall that the probes are fitted to.
TABLES, FIT_QUERIES, FIT_RECALL = 4, 256, 0.97

#: Scores that rounding may set apart, and pairs that are scored exactly at a time.
CLOSE, PAIRS_AT_ONCE = 1e-9, 1 << 16


class Rotations:
    """``tables`` pseudo-rotations of vectors of ``width`` components, drawn from ``seed``."""

    def __init__(self, width: int, tables: int = TABLES, seed: int = 1):
        self.size = 1 << max(0, width - 1).bit_length()
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, 3, self.size))
        self.buckets = 2 * self.size

    def __call__(self, vectors: np.ndarray, table: int) -> np.ndarray:
        x = np.zeros((len(vectors), self.size))
        x[:, : vectors.shape[1]] = vectors
        for signs in self.signs[table]:
            x = hadamard(x * signs)
        return x

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """``(row, table)``: the bucket, numbered over all tables, that each vector is in."""
        out = np.zeros((len(vectors), len(self.signs)), np.int64)
        rows = np.arange(len(vectors))
        for t in range(len(self.signs)):
            x = self(vectors, t)
            axis = np.abs(x).argmax(1)
            out[:, t] = t * self.buckets + 2 * axis + (x[rows, axis] < 0)
        return out

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """``(row, place)``: all buckets of all tables, those with the nearest axes first."""
        along = []
        for t in range(len(self.signs)):
            x = self(vectors, t)
            along.append(np.stack([x, -x], 2).reshape(len(x), -1))
        return np.argsort(-np.concatenate(along, 1), axis=1, kind="stable")


def hadamard(x: np.ndarray) -> np.ndarray:
    """Each row's Hadamard transform at unit scale."""
    n = x.shape[1]
    step = 1
    while step < n:
        pairs = x.reshape(len(x), -1, 2, step)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], 2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def shortened(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, so that squares neither overflow nor vanish; cosines stay the same."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, initial=0))[1][:, None])


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def nearest(q: np.ndarray, x: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, row, cosine)`` of at least each query's ``k`` nearest; rows with its own id are left out.

    A product over all pairs sorts out what is too far; the cosines of the
    rest are summed row by row, so that equal vectors have equal ones.
    """
    long, far = norms(q), norms(x)
    rough = (q / long[:, None]) @ (x / far[:, None]).T
    rough[own[:, None] == ids] = -np.inf
    if len(x) > k:
        worst = np.partition(rough, len(x) - k, axis=1)[:, len(x) - k, None]
        i, j = np.nonzero((rough >= worst - CLOSE) & (rough > -np.inf))
    else:
        i, j = np.nonzero(rough > -np.inf)
    cosine = np.zeros(len(i))
    for lo in range(0, len(i), PAIRS_AT_ONCE):
        a, b = i[lo : lo + PAIRS_AT_ONCE], j[lo : lo + PAIRS_AT_ONCE]
        cosine[lo : lo + PAIRS_AT_ONCE] = (q[a] * x[b]).sum(1) / (long[a] * far[b])
    return i, j, cosine


FOUND = "grp long, score double, id long, rid long"


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("grp").orderBy(F.desc("score"), F.asc_nulls_last("id"), "rid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def against_all(sample: list, rows: DataFrame, width: int, k: int) -> DataFrame:
    """``grp, rid`` of the true ``k`` nearest rows of a few queries."""
    ids = np.array([r.id for r in sample], np.int64)
    q = np.zeros((len(sample), width))
    for i, r in enumerate(sample):
        q[i, : len(r.vec)] = r.vec
    q = shortened(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, pa.float64())
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                mine = part.column("id").fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
                rid = part.column("rid").to_numpy()
                i, j, cosine = nearest(q, shortened(matrix(part.column("vec"), width)), mine, ids, k)
                yield from best.add(i, cosine, mine[j], rid[j])
        yield from best.rest()

    return ranked(rows.select("id", "vec", "rid").mapInArrow(run, FOUND), k).select("grp", "rid")


def fitted_probes(turn: Rotations, queries: DataFrame, rows: DataFrame, width: int, k: int, recall: float) -> int:
    """Buckets a query has to probe to find the share ``recall`` of the true neighbours of the sampled queries."""
    sample = queries.orderBy(F.xxhash64("id", "query"), "query").limit(FIT_QUERIES).select("id", "vec").collect()
    if not sample:
        return 1
    true = rows.join(against_all(sample, rows, width, k), "rid").select("grp", "vec").collect()
    if not true:
        return 1

    def filled(vectors: list) -> np.ndarray:
        out = np.zeros((len(vectors), width))
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v
        return shortened(out)

    order = turn.order(filled([r.vec for r in sample]))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None], 1)
    met_at = np.take_along_axis(place[[r.grp for r in true]], turn.codes(filled([r.vec for r in true])), 1).min(1)
    return int(np.sort(met_at)[int(np.ceil(recall * len(met_at))) - 1]) + 1


def nearest_neighbours(
    queries: DataFrame, data: DataFrame, k: int = 5, tables: int = TABLES, recall: float = FIT_RECALL, probes: int | None = None
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` rows nearest to each query, by cosine, among those its probes meet.

    Both tables have ``id`` (long) and ``vec`` (array of doubles or floats);
    other columns are not read. Vectors that are null, all zero or empty, or
    hold a null or a number that is not finite take no part; a component that a
    shorter vector lacks is zero. Rows with the query's id are not its
    candidates; repeated rows each count. Candidates without an id come last
    among ties, queries without one are left out; queries alike in id and
    vector ask once, and one id with two vectors asks for each. Empty tables
    give an empty one. Scores are exact cosines in double precision, ties go to
    smaller ids. ``probes`` is fitted to ``recall`` unless given.
    """
    spark = data.sparkSession
    vec = F.transform("vec", lambda x: x.cast("double"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    whole = F.col("vec").isNotNull() & ~odd & F.exists("vec", lambda x: x != 0)
    rows = data.select("id", vec.alias("vec")).filter(whole).withColumn("rid", F.monotonically_increasing_id())
    rows = staged(rows, "vectors")
    asked = queries.select("id", vec.alias("vec")).filter(whole & F.col("id").isNotNull()).distinct()
    asked = staged(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    width = max(1, *(t.agg(F.max(F.size("vec"))).first()[0] or 1 for t in (rows, asked)))
    turn = Rotations(width, tables)
    most = turn.buckets * tables
    probed = min(most, probes or fitted_probes(turn, asked, rows, width, k, recall))

    def kept(body: np.ndarray, more: np.ndarray):
        codes = turn.codes(shortened(body))
        return np.repeat(np.arange(len(body)), tables), codes.ravel()

    def sought(body: np.ndarray, more: np.ndarray):
        row, bucket = [], []
        for lo in range(0, len(body), 1024):
            order = turn.order(shortened(body[lo : lo + 1024]))[:, :probed]
            row.append(np.repeat(np.arange(lo, lo + len(order)), probed))
            bucket.append(order.ravel())
        return np.concatenate(row), np.concatenate(bucket)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, pa.float64())
        for batch in batches:
            for row in range(batch.num_rows):
                own, query, q = arrays(batch, row, width, np.float64, "q_")
                ids, rid, x = arrays(batch, row, width, np.float64)
                x = shortened(x)
                for lo in range(0, len(q), 512):
                    part = slice(lo, lo + 512)
                    i, j, cosine = nearest(shortened(q[part]), x, ids, own[part], k)
                    yield from best.add(query[part, 0][i], cosine, ids[j], rid[j, 0])
        yield from best.rest()

    parts = staged(packed(rows, ["rid"], width, np.float64, kept), "parts")
    buckets = evened(parts)
    found = met(packed(asked, ["query"], width, np.float64, sought), buckets).drop("key", "salt", "n").mapInArrow(score, FOUND)
    # a row that a query meets in several tables is one candidate
    best = staged(ranked(found.dropDuplicates(["grp", "rid"]), k), "nearest")
    drop_staged(spark, rows, parts)
    out = best.join(asked.select(F.col("query").alias("grp"), F.col("id").alias("query_id")), "grp")
    return out.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
