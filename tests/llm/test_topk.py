import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolens.llm import topk

SCHEMA = "id long, vec array<long>, extra string, cell int"


def brute(queries, data, k):
    last = 2**63
    out, seen = [], set()
    for qi, q in queries:
        if qi is None or q is None or None in q or (qi, tuple(q)) in seen:
            continue
        seen.add((qi, tuple(q)))
        found = []
        for i, v in data:
            if i == qi or v is None or None in v:
                continue
            s = sum(a * b for a, b in zip(q, v, strict=False))
            found.append((-max(-(2**63), min(2**63 - 1, s)), last if i is None else i))
        for rank, (s, i) in enumerate(sorted(found)[:k], 1):
            out.append((qi, rank, None if i == last else i, -s))
    return sorted(out, key=str)


def got(spark, queries, data, k, **settings):
    q = spark.createDataFrame([(*r, "x", 1) for r in queries], SCHEMA)
    d = spark.createDataFrame([(*r, "x", 1) for r in data], SCHEMA)
    return sorted((tuple(r) for r in topk.top_k(q, d, k, **settings).collect()), key=str)


@pytest.mark.parametrize("sizes", [(2048, 512), (7, 3)])
@pytest.mark.parametrize("spread", [3, 400])
def test_random_vectors(spark, monkeypatch, sizes, spread):
    monkeypatch.setattr(topk, "DATA_BLOCK", sizes[0])
    monkeypatch.setattr(topk, "QUERY_BLOCK", sizes[1])
    rng = random.Random(spread)
    centres = [[rng.randrange(-1000, 1000) for _ in range(6)] for _ in range(5)]
    data = [(i, [c + rng.randrange(-spread, spread) for c in rng.choice(centres)]) for i in range(120)]
    queries = [r for r in data if r[0] % 9 == 0]
    assert got(spark, queries, data, 4, pivots=6) == brute(queries, data, 4)


def test_odd_rows(spark):
    data = [(1, [1, 2]), (2, [1, 2]), (3, None), (4, [None, 1]), (5, []), (6, [3]), (7, [1, 2, 9]), (7, [1, 2, 9]), (None, [1, 2]),
            (8, [2**40, -(2**40)]), (9, [2**62, 1]), (-1, [0, 0])]
    queries = [*data, (1, [1, 2]), (1, [5, 5])]
    assert got(spark, queries, data, 3) == brute(queries, data, 3)
    assert got(spark, queries, data, 50) == brute(queries, data, 50)


def test_many_equal_vectors(spark):
    data = [(i, [4, 4, 4]) for i in range(300)]
    assert got(spark, data[:200:100], data, 10) == brute(data[:200:100], data, 10)


@pytest.mark.parametrize("copies", [2, 12, 40])
def test_repeated_query_ids(spark, monkeypatch, copies):
    """Rows with the query's id are no candidates, however many they are and wherever they lie."""
    far = [(i, [i % 10, 0]) for i in range(1, 21)]
    near = [(100, [10, 0])] * copies
    assert got(spark, near[:1], near + far, 10) == brute(near[:1], near + far, 10)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    spread = [(100, [10 + i % 7, i % 3]) for i in range(copies)] + [(101, [30, 0]), (102, [0, 30])] * 2
    asked = [*spread, (7, [7, 0])]
    assert got(spark, asked, spread + far, 2) == brute(asked, spread + far, 2)


def test_empty_tables(spark):
    assert got(spark, [], [], 3) == []
    assert got(spark, [(1, [1])], [], 3) == []
    assert got(spark, [], [(1, [1])], 3) == []


def test_bounds_keep_every_needed_cell():
    rng = np.random.default_rng(4)
    pivots = rng.integers(-500, 500, (8, 5)).astype(float)
    data = (pivots[rng.integers(0, 8, 300)] + rng.integers(-20, 20, (300, 5))).astype(np.int64)
    cell, apart = topk.nearest(data, pivots)
    members = np.bincount(cell, minlength=8)
    radius = np.array([apart[cell == c].max(initial=0) for c in range(8)])
    queries = data[::10]
    need = topk.needed_cells(queries, pivots, members, radius, 5)
    top = np.argsort(-(queries @ data.T), axis=1)[:, :5]
    assert need[np.arange(len(queries))[:, None], cell[top]].all()
    assert not need.all()


def test_scaled(spark):
    df = spark.sql("select array(0.5d, -0.0001d) a, array(1d, null) b, array(double('nan')) c, array(double('inf')) d, cast(null as array<double>) e")
    row = df.select(*[topk.scaled(F.col(c)).alias(c) for c in df.columns]).first()
    assert tuple(row) == ([512, -1], None, None, None, None)


def test_most_pairs_of_clustered_vectors_are_left_out(spark, monkeypatch):
    """The share of pairs that meet, both phases together; the result is that of all pairs."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-1000, 1000, (40, 16))
    vectors = centres[rng.integers(0, 40, 4000)] + rng.integers(-30, 30, (4000, 16))
    data = [(i, v.tolist()) for i, v in enumerate(vectors)]
    pairs = spark.sparkContext.accumulator(0)
    real = topk.products

    def counting(q, x):
        pairs.add(len(q) * len(x))
        return real(q, x)

    monkeypatch.setattr(topk, "products", counting)
    queries = data[::50]
    assert got(spark, queries, data, 5) == brute(queries, data, 5)
    assert 0 < pairs.value < 0.3 * len(queries) * len(data)


def test_scores_at_the_ends_of_a_long(spark):
    big = 2**62
    data = [(i, [big if i % 2 else -big, big, i]) for i in range(40)]
    queries = [(0, [big, big, 1]), (7, [-big, -big, 0]), (9, [0, -big, 2])]
    assert got(spark, queries, data, 6, pivots=5) == brute(queries, data, 6)
