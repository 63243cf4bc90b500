import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolens.llm import neighbours
from cargolens.llm.neighbours import Rotations, hadamard
from cargolens.llm.queries import QUERIES

SCHEMA = "id long, vec array<double>"


def brute(rows, queries, k=5):
    good = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    asked = {(i, tuple(v)) for i, v in queries if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for i, q in asked:
        scored = []
        for j, v in good:
            if j != i:
                dot = math.fsum(a * b for a, b in zip(q, v, strict=False))
                scored.append((dot / math.hypot(*q) / math.hypot(*v), j))
        scored.sort(key=lambda r: (-round(r[0], 9), r[1] is None, r[1] or 0))
        out += [(i, n, j, pytest.approx(s, abs=1e-12)) for n, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=lambda r: (r[0], r[1], str(r[2])))


def found(spark, rows, queries, **more):
    made = neighbours.nearest_neighbours(spark.createDataFrame(queries, SCHEMA), spark.createDataFrame(rows, SCHEMA), **more)
    return sorted(map(tuple, made.collect()), key=lambda r: (r[0], r[1], str(r[2])))


def test_hash_is_the_nearest_signed_axis():
    rng = np.random.default_rng(1)
    turn = Rotations(5, 3)
    x = rng.normal(size=(20, 5))
    assert np.allclose(np.linalg.norm(turn(x, 1), axis=1), np.linalg.norm(x, axis=1))
    for row, codes in zip(x, turn.codes(x), strict=True):
        for t, code in enumerate(codes):
            y = turn(row[None], t)[0]
            axis, negative = divmod(int(code) - t * turn.buckets, 2)
            assert abs(y[axis]) == pytest.approx(abs(y).max()) and negative == (y[axis] < 0)
    assert (turn.order(x)[:, :1] == turn.codes(x)).any(1).all()  # the first probe is the bucket of some table
    assert np.allclose(hadamard(hadamard(x[:, :4])), x[:, :4])


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in table])
    ids = np.array([r.vec_id for r in table])
    x /= np.linalg.norm(x, axis=1)[:, None]
    got: dict = {}
    for r in QUERIES["op13_nearest_neighbours"](spark, f"/root/testdata/{sf}").collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hits, asked = 0, [i for i in range(len(ids)) if ids[i] % 50 == 0]
    assert set(got) == {ids[i] for i in asked}
    for i in asked:
        cosine = x @ x[i]
        cosine[i] = -2
        true = ids[np.lexsort((ids, -cosine))[:5]]
        mine = [got[ids[i]][n] for n in range(1, 6)]
        assert [s for _, s in mine] == sorted((s for _, s in mine), reverse=True)
        for j, s in mine:
            assert s == pytest.approx(cosine[list(ids).index(j)], abs=1e-12)
        hits += len(set(true) & {j for j, _ in mine})
    assert hits / (5 * len(asked)) >= 0.9


def test_all_probes_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    queries = rows[::25]
    assert found(spark, rows, queries, probes=1 << 20) == brute(rows, queries)


def test_odd_rows(spark):
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [2.0, 4.0]), (3, [2.0, 4.0]), (None, [1.0, 2.0]), (4, None), (5, []), (6, [0.0, 0.0]),
        (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1e200, 2e200]), (11, [1e-200, 1e-200]), (12, [5.0]), (13, [-1.0, -2.0]),
    ]
    queries = [*rows, (1, [2.0, 1.0])]
    want = [(i, n, j) for i, n, j, _ in brute([r for r in rows if r[0] not in (10, 11)], queries) if i not in (10, 11)]
    got = found(spark, rows, queries, k=20, probes=1 << 20)
    big = [(j, s) for i, n, j, s in got if i == 10]
    assert [j for j, _ in big][:6] == [1, 1, 2, 3, 3, None] and big[0][1] == pytest.approx(1.0)
    small = found(spark, [r for r in rows if r[0] not in (10, 11)], [q for q in queries if q[0] not in (10, 11)], probes=1 << 20)
    assert [r[:3] for r in small] == want


def test_hot_vector(spark):
    rows = [(i, [1.0, 1.0, 1.0]) for i in range(6000)] + [(9000 + i, [1.0, float(i), 0.0]) for i in range(50)]
    got = found(spark, rows, [(0, [1.0, 1.0, 1.0]), (9003, [1.0, 3.0, 0.0])])
    assert [r[2] for r in got if r[0] == 0] == [1, 2, 3, 4, 5]
    assert len(got) == 10


def test_little(spark):
    assert found(spark, [], [(1, [1.0])]) == []
    assert found(spark, [(1, [1.0])], []) == []
    assert found(spark, [(1, [1.0])], [(1, [1.0])]) == []
    assert [r[:3] for r in found(spark, [(1, [1.0]), (2, [3.0])], [(1, [1.0])])] == [(1, 1, 2)]


def test_extra_columns(spark):
    names = ["rid", "query", "key", "salt", "n", "ids", "more", "body", "grp", "score", "rank"]
    rows = [(i, [float(i % 7 + 1), float(i % 5)]) for i in range(40)]
    wide = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(c).alias(c) for c in names])
    made = neighbours.nearest_neighbours(wide.filter("id % 10 = 0"), wide, probes=1 << 20)
    assert sorted(map(tuple, made.collect()), key=lambda r: r[:2]) == brute(rows, rows[::10])
