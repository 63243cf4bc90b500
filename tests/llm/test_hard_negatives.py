import numpy as np
import pytest

from cargolens.llm import hard_negatives
from cargolens.llm.hard_negatives import ENDS, Tree

SCHEMA = "id long, vec array<long>, label int"


def brute(rows, anchors, positives=5, negatives=10, low=30, high=90):
    """The contract, pair by pair in whole numbers."""
    good = [r for r in rows if r[1] is not None and None not in r[1] and r[2] is not None]
    out = []
    for a in {(i, tuple(v), g) for i, v, g in anchors if i is not None and v is not None and None not in v and g is not None}:
        scored = [(sum(x * y for x, y in zip(a[1], v, strict=False)), i, g) for i, v, g in good if i != a[0]]
        scored.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        for p, pid, _ in [r for r in scored if r[2] == a[2]][:positives]:
            near = [r for r in scored if r[2] != a[2] and low * p <= 100 * r[0] <= high * p][:negatives]
            out += [(a[0], pid, n, i, p, s) for n, (s, i, _) in enumerate(near, 1)]
    return sorted(out, key=str)


def mined(spark, rows, anchors, **more):
    made = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(anchors, SCHEMA), **more)
    return sorted(map(tuple, made.collect()), key=str)


def clustered(n, width, clusters, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 300, (clusters, width))
    return [
        (i, (centres[i % clusters] + rng.normal(0, 10, width)).astype(int).tolist(), int(rng.integers(0, 3))) for i in range(n)
    ]


def test_against_brute_force(spark):
    rows = clustered(600, 8, 12, 1)
    anchors = [r for r in rows if r[0] % 20 == 0]
    assert mined(spark, rows, anchors) == brute(rows, anchors)
    assert mined(spark, rows, anchors, fan_out=3, levels=4, positives=2, negatives=3, low=10, high=99) == brute(rows, anchors, 2, 3, 10, 99)


def test_leaves_out_leaves_that_the_window_cannot_reach(spark):
    vectors = np.array([v for _, v, _ in clustered(3000, 8, 60, 2)])
    tree = Tree(vectors[:1000], float(np.sqrt((vectors**2).sum(1).max())) * 1.000001)
    leaf, passed = tree.paths(vectors)
    for number, _, child, far in passed:
        node = tree.nodes[number]
        for j in np.unique(child):
            node.low[:, j] = np.minimum(node.low[:, j], far[child == j].min(0))
            node.high[:, j] = np.maximum(node.high[:, j], far[child == j].max(0))
    queries = vectors[:200]
    scores = queries @ vectors.T
    high = np.sort(scores, 1)[:, -5]
    low = np.sort(scores, 1)[:, -30]
    needed = tree.needed(queries, low[:, None], high[:, None])
    inside = (scores >= low[:, None]) & (scores <= high[:, None])
    assert needed[np.nonzero(inside)[0], leaf[np.nonzero(inside)[1]]].all()
    solved = np.bincount(leaf, minlength=tree.leaves)[None] * needed
    assert solved.sum() / (len(queries) * len(vectors)) < 0.3
    assert not tree.needed(queries, np.full((200, 1), 1), np.full((200, 1), 0)).any()
    assert tree.needed(queries, np.full((200, 1), ENDS.min), np.full((200, 1), ENDS.max))[:, np.unique(leaf)].all()


def test_odd_rows(spark):
    rows = [
        (1, [3, 4], 1), (1, [3, 4], 1), (2, [3, 4], 1), (2, [3, 4], 1), (3, [6, 8], 2), (4, [2, 3], 2), (4, [2, 3], 2),
        (None, [2, 3], 2), (None, [3, 4], 1), (5, None, 1), (6, [1, None], 2), (7, [1, 1], None), (8, [], 2), (9, [3], 2),
        (10, [0, 0], 3), (11, [0, 0], 3), (12, [-5, -5], 4), (13, [5, 5], 4), (14, [1 << 30, 1], 5), (15, [1 << 30, 2], 5), (16, [1 << 29, 7], 6),
    ]
    anchors = [*rows, (1, [1, 2], 1), (1, [3, 4], 2), (99, [3, 1], 2)]
    assert mined(spark, rows, anchors) == brute(rows, anchors)


def test_many_rows_alike(spark):
    rows = [(i, [10, 10, 1], 0) for i in range(5000)] + [(6000 + i, [6, 6, i], 1) for i in range(40)]
    anchors = [r for r in rows if r[0] % 1000 == 0]
    assert mined(spark, rows, anchors) == brute(rows, anchors)


@pytest.mark.parametrize("rows", [[], [(1, [1, 2], 0)], [(1, [0, 0], 0), (2, [0, 0], 1)]])
def test_little(spark, rows):
    assert mined(spark, rows, rows) == []
    assert mined(spark, rows, []) == []


def test_extra_columns(spark):
    names = ["rid", "query", "key", "salt", "n", "ids", "more", "body", "grp", "score", "rank", "window", "low", "high", "label0", "least0"]
    rows = clustered(50, 3, 4, 3)
    shape = SCHEMA + "".join(f", `{c}` string" for c in names)
    wide = spark.createDataFrame([(*r, *names) for r in rows], shape)
    made = hard_negatives.mine(wide, wide.filter("id % 10 = 0"))
    assert sorted(map(tuple, made.collect()), key=str) == brute(rows, [r for r in rows if r[0] % 10 == 0])
