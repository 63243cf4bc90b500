"""Hard-negative mining with a GNAT-style multiway hyperplane tree.

Every node of the tree has some split points, and a vector goes to the child of
the nearest one, so that hyperplanes divide the children. For each pair of
split points the node keeps the range of distances from the one to all vectors
below the other. Inner products become distances by one more component that
brings all data to one length; a window of scores is then an annulus around the
query, and a child whose ranges, or whose side of a hyperplane, cannot meet the
annulus is left out with all that lies below it.

A search solves each query in its own leaf first. What it finds there narrows
its windows, the tree names the other leaves that can still matter, and those
are solved exactly. Positives are such a search among rows of the anchor's
label, negatives one among the others in a window per positive. Split points
come from a bounded sample; the ranges, the leaves and the answers from all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolens.llm.blocks import Best, arrays, evened, matrix, met, packed
from cargolens.llm.topk import products
from cargolens.session import drop_staged, staged

#: Split points of a node, levels of nodes, and rows and numbers of the sample they are chosen from.
FAN_OUT, LEVELS, SAMPLE_ROWS, SAMPLE_NUMBERS = 10, 2, 4096, 1 << 22

ENDS = np.iinfo(np.int64)


@dataclass
class Node:
    """Split points (with the added component) and, per child, a node, or the number of a leaf."""

    points: np.ndarray
    children: list = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class Tree:
    """The nodes in order; ``length`` is the length that all data is brought to."""

    def __init__(self, sample: np.ndarray, length: float, fan_out: int = FAN_OUT, levels: int = LEVELS):
        self.length, self.nodes, self.leaves = length, [], 0
        self.root = self._grow(np.unique(self.lifted(sample), axis=0), fan_out, levels)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        x = vectors.astype(float)
        return np.column_stack([x, np.sqrt(np.maximum(self.length**2 - (x * x).sum(1), 0))])

    def _grow(self, rows: np.ndarray, fan_out: int, levels: int):
        if levels == 0 or len(rows) < 2:
            self.leaves += 1
            return self.leaves - 1
        # of some candidates the ones that lie far from each other
        candidates = rows[np.linspace(0, len(rows) - 1, min(len(rows), 3 * fan_out)).astype(int)]
        chosen = [0]
        apart = distances(candidates, candidates[:1])[:, 0]
        while len(chosen) < min(fan_out, len(candidates)) and apart.max() > 0:
            chosen.append(int(apart.argmax()))
            apart = np.minimum(apart, distances(candidates, candidates[chosen[-1:]])[:, 0])
        node = Node(candidates[chosen])
        self.nodes.append(node)
        child = distances(rows, node.points).argmin(1)
        for j in range(len(chosen)):
            node.children.append(self._grow(rows[child == j], fan_out, levels - 1))
        node.low = np.full((len(chosen), len(chosen)), np.inf)
        node.high = np.full((len(chosen), len(chosen)), -np.inf)
        return node

    def paths(self, vectors: np.ndarray) -> tuple[np.ndarray, list]:
        """The leaf of each vector, and ``(number of node, rows, child, distances)`` of each node passed."""
        x = self.lifted(vectors)
        leaf, passed = np.zeros(len(x), np.int64), []
        numbers = {id(n): i for i, n in enumerate(self.nodes)}
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            if not isinstance(at, Node):
                leaf[rows] = at
            elif len(rows):
                far = distances(x[rows], at.points)
                child = far.argmin(1)
                passed.append((numbers[id(at)], rows, child, far))
                todo += [(c, rows[child == j]) for j, c in enumerate(at.children)]
        return leaf, passed

    def needed(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """``(query, leaf)`` flags: leaves that can hold a score within one of the query's windows.

        ``low`` and ``high`` have a column per window; one with ``low > high`` is empty.
        """
        q = np.column_stack([queries.astype(float), np.zeros(len(queries))])
        square = (q * q).sum(1)[:, None] + self.length**2
        slack = 1e-9 * square + 1e-6
        inner = np.sqrt(np.maximum(square - 2.0 * high - slack, 0))
        outer = np.where(low == ENDS.min, np.inf, np.sqrt(np.maximum(square - 2.0 * low + slack, 0)))
        outer = np.where(low > high, -1.0, outer)
        out = np.zeros((len(q), self.leaves), bool)
        todo = [(self.root, np.arange(len(q)))]
        while todo:
            at, rows = todo.pop()
            if not isinstance(at, Node):
                out[rows, at] = True
                continue
            far = distances(q[rows], at.points)[:, :, None]
            nearest = np.maximum(far - at.high, at.low - far).max(1)
            farthest = (far + at.high).min(1)
            between = distances(at.points, at.points)
            np.fill_diagonal(between, np.inf)
            # distance to the hyperplanes behind which child j lies
            behind = ((far.transpose(0, 2, 1) ** 2 - far**2) / (2 * between)).max(1)
            nearest = np.maximum(nearest, behind) - 1e-6 * (1 + self.length)
            farthest = farthest + 1e-6 * (1 + self.length)
            for j, child in enumerate(at.children):
                if at.low[0, j] > at.high[0, j]:
                    continue  # no data below
                hits = (nearest[:, j, None] <= outer[rows]) & (farthest[:, j, None] >= inner[rows])
                keep = rows[hits.any(1)]
                if len(keep):
                    todo.append((child, keep))
        return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)
    return np.sqrt(np.maximum(squares, 0))


def measure(tree: Tree, rows: DataFrame, width: int) -> None:
    """Set the tree's ranges from all rows; a task sends one entry per pair of split points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = [n.low.copy() for n in tree.nodes], [n.high.copy() for n in tree.nodes]
        for batch in batches:
            if not batch.num_rows:
                continue
            for number, _, child, far in tree.paths(matrix(batch.column("vec"), width, np.int64))[1]:
                for j in np.unique(child):
                    mine = far[child == j]
                    low[number][:, j] = np.minimum(low[number][:, j], mine.min(0))
                    high[number][:, j] = np.maximum(high[number][:, j], mine.max(0))
        found = [
            (n, i, j, low[n][i, j], high[n][i, j]) for n in range(len(low)) for i, j in zip(*np.nonzero(low[n] <= high[n]), strict=True)
        ]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
        columns = zip(*found, strict=True) if found else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["node", "i", "j", "low", "high"]
        )

    sent = rows.select("vec").mapInArrow(run, "node int, i int, j int, low double, high double")
    for r in sent.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        tree.nodes[r.node].low[r.i, r.j] = r.low
        tree.nodes[r.node].high[r.i, r.j] = r.high


def best_columns(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, column)`` of each row's ``k`` highest allowed scores; columns stand by id."""
    n = scores.shape[1]
    if n <= k:
        return np.nonzero(allowed)
    if max(abs(int(scores.min())), abs(int(scores.max()))) < ENDS.max // (2 * n):
        ranked = np.where(allowed, scores * n + np.arange(n - 1, -1, -1), ENDS.min)
        column = np.argpartition(ranked, n - k, axis=1)[:, n - k :]
        row = np.repeat(np.arange(len(scores)), k)
        column = column.ravel()
        fits = allowed[row, column]
        return row[fits], column[fits]
    out = []
    for i in range(len(scores)):
        here = np.flatnonzero(allowed[i])
        here = here[np.lexsort((here, ~scores[i, here]))[:k]]
        out.append((np.full(len(here), i), here))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def solved(queries: DataFrame, data: DataFrame, width: int, windows: int, k: int, same_label: bool) -> DataFrame:
    """``grp, score, id, rid``: the best matches of query ``grp // windows`` in its window ``grp % windows``.

    The blocks of queries have ``query, label`` and the windows' ends as further numbers, those of data ``rid, label``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, pa.int64())
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, asked, q = arrays(batch, row, width, np.int64, "q_")
                ids, has, x = arrays(batch, row, width, np.int64)
                order = np.argsort(ids, kind="stable")
                ids, has, x = ids[order], has[order], x[order]
                for lo in range(0, len(q), 512):
                    part = slice(lo, lo + 512)
                    scores = products(q[part], x)
                    others = (asked[part, 1:2] == has[:, 1]) == same_label
                    others &= q_ids[part, None] != ids
                    for w in range(windows):
                        a, b = asked[part, 2 + 2 * w, None], asked[part, 3 + 2 * w, None]
                        i, j = best_columns(scores, ids, others & (scores >= a) & (scores <= b), k)
                        yield from best.add(asked[part, 0][i] * windows + w, scores[i, j], ids[j], has[j, 0])
        yield from best.rest()

    return met(queries, data).drop("key", "salt", "n").mapInArrow(run, "grp long, score long, id long, rid long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """``found`` with ``rank`` from 1 to ``k`` in each group."""
    order = Window.partitionBy("grp").orderBy(F.desc("score"), F.asc_nulls_last("id"), "rid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(tree: Tree, queries: DataFrame, data: DataFrame, width: int, windows: int, k: int, same_label: bool) -> DataFrame:
    """``grp, score, id, rid, rank``: each query's ``k`` best in each window.

    ``queries`` has ``id, vec, query, label`` and ``low, high`` as arrays of
    the windows' ends (both included).
    """
    ends = [F.element_at(c, w + 1).alias(f"{c}{w}") for w in range(windows) for c in ("low", "high")]
    names = ["query", "label", *[f"{c}{w}" for w in range(windows) for c in ("low", "high")]]
    rows = staged(queries.select("id", "vec", "query", "label", *ends), "asked")

    def home(body: np.ndarray, more: np.ndarray):
        return np.arange(len(body)), tree.paths(body)[0]

    def others(body: np.ndarray, more: np.ndarray):
        low, high, least = more[:, 2 : 2 + 2 * windows : 2], more[:, 3 : 3 + 2 * windows : 2], more[:, 2 + 2 * windows :]
        wanted = tree.needed(body, np.maximum(low, least), high)
        wanted[np.arange(len(body)), tree.paths(body)[0]] = False  # solved already
        return np.nonzero(wanted)

    near = staged(ranked(solved(packed(rows, names, width, np.int64, home), data, width, windows, k, same_label), k), "near")
    # the worst of k found so far is the least that matters
    window = F.pmod("grp", F.lit(windows))
    full = near.groupBy(((F.col("grp") - window) / windows).cast("long").alias("query")).agg(
        *[F.max(F.when((window == w) & (F.col("rank") == k), F.col("score"))).alias(f"least{w}") for w in range(windows)]
    )
    least = [f"least{w}" for w in range(windows)]
    narrowed = rows.join(full, "query", "left").fillna(int(ENDS.min), least)
    blocks = packed(narrowed, [*names, *least], width, np.int64, others)
    more = staged(solved(blocks, data, width, windows, k, same_label), "far")
    drop_staged(rows.sparkSession, rows)
    return ranked(near.drop("rank").unionByName(more), k)


def mine(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    fan_out: int = FAN_OUT,
    levels: int = LEVELS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Both tables have ``id`` (long), ``vec`` (array of longs) and ``label``
    (integer); other columns are not read. The score of two rows is their inner
    product; higher ones come first, ties go to smaller ids, and rows without an
    id come last. Per anchor the first ``positives`` rows of its label are found,
    and per such pair the first ``negatives`` rows of other labels whose score is
    ``low`` to ``high`` percent of the pair's. All, if there are fewer; a pair
    without negatives has no row, nor has an anchor without positives. A
    negative positive_score leaves no window, a zero one that of zero alone.

    Rows that lack a label, a vector or a component take no part; an empty
    vector is all zeros, and so are components that a shorter one lacks. Rows
    with the anchor's id are not its candidates; repeated rows each count as
    candidates. Anchors without an id are left out, anchors alike in id, vector
    and label ask once, and one id with two vectors asks for each. Empty tables
    give an empty one. Scores are exact; one that does not fit a long is cut to its ends.
    """
    spark = vectors.sparkSession
    whole = F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull()) & F.col("label").isNotNull()
    names = ["id", "vec", F.col("label").cast("long").alias("label")]
    rows = staged(vectors.filter(whole).select(*names).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    asked = anchors.filter(whole & F.col("id").isNotNull()).select(*names).distinct()
    asked = staged(asked.withColumn("query", F.monotonically_increasing_id()), "anchors")
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    size = rows.agg(F.max(F.size("vec")).alias("width"), F.max(square).alias("square")).first()
    width = max(1, size.width or 1, asked.agg(F.max(F.size("vec"))).first()[0] or 1)
    sample = rows.orderBy(F.xxhash64("rid"), "rid").limit(max(2, min(SAMPLE_ROWS, SAMPLE_NUMBERS // width))).select("vec")
    found = sample.toArrow()
    points = matrix(found.column("vec"), width) if found.num_rows else np.zeros((0, width))
    tree = Tree(points, float(np.sqrt(size.square or 0.0)) * (1 + 1e-9), fan_out, levels)
    measure(tree, rows, width)

    def leaf(body: np.ndarray, more: np.ndarray):
        return np.arange(len(body)), tree.paths(body)[0]

    parts = staged(packed(rows, ["rid", "label"], width, np.int64, leaf), "parts")
    data = staged(evened(parts), "leaves")
    drop_staged(spark, rows, parts)

    any_score = [F.array(F.lit(int(e))).alias(c) for c, e in (("low", ENDS.min), ("high", ENDS.max))]
    pairs = search(tree, asked.select("*", *any_score), data, width, 1, positives, True)
    pairs = pairs.withColumnsRenamed({"grp": "query", "id": "positive_id", "score": "positive_score"})
    pairs = staged(pairs.select("query", (F.col("rank") - 1).alias("window"), "positive_id", "positive_score"), "pairs")

    def percent(share: int, up: bool):
        """Share of the score in whole numbers, without a product that overflows."""
        tens = F.expr("positive_score div 100") - F.when(F.expr("positive_score % 100 < 0"), 1).otherwise(0)
        ones = F.col("positive_score") - tens * 100
        part = ones * share
        return tens * share + (F.ceil(part / 100) if up else F.floor(part / 100))

    ends = F.struct("window", percent(low, True).alias("low"), percent(high, False).alias("high"))
    listed = pairs.groupBy("query").agg(F.sort_array(F.collect_list(ends)).alias("w"))

    def padded(name: str, value: int):
        given = F.transform("w", lambda w: w[name])
        return F.concat(given, F.array_repeat(F.lit(value), positives - F.size("w"))).alias(name)

    # windows that an anchor lacks are empty: their low end is above the high one
    windows = asked.join(listed, "query").select("id", "vec", "label", "query", padded("low", 1), padded("high", 0))
    found = search(tree, windows, data, width, positives, negatives, False)
    found = found.select("*", F.pmod("grp", F.lit(positives)).alias("window"))
    found = found.withColumn("query", ((F.col("grp") - F.col("window")) / positives).cast("long"))
    out = found.join(pairs, ["query", "window"]).join(asked.select("query", F.col("id").alias("anchor_id")), "query")
    out = out.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
