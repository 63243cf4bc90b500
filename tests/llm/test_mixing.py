import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cargolens.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """The excess is handed on by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = {}, share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(full.values())
        above = [s for s in free if left * weight[s] / sum(weight[f] for f in free) > most * sizes[s]]
        if not above:
            return full | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        full |= {s: most * sizes[s] for s in above}


def check(df, rows, **settings):
    got = df.collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == sorted((i or -1, t or "") for i, t, _ in rows)
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        assert r.mix.size == len(WORD.findall(r.text or ""))
        sizes[r.source] += r.mix.size
        largest[r.source] = max(largest[r.source], r.mix.size)
        taken[r.source] += r.mix.size * r.mix.copies
        assert 0 <= r.mix.copies <= settings.get("most", 2.0)
    want = brute_targets(sizes, **settings)
    for r in got:
        assert r.mix.source_size == sizes[r.source]
        assert r.mix.target == pytest.approx(want[r.source])
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1e-6
    for s in sizes:  # of documents of one size, those with the smallest ratios are sampled
        least = min(r.mix.copies for r in got if r.source == s)
        for n in {r.mix.size for r in got if r.source == s}:
            same = [r for r in got if r.source == s and r.mix.size == n and r.mix.ratio is not None]
            more = [r.mix.ratio for r in same if r.mix.copies > least]
            rest = [r.mix.ratio for r in same if r.mix.copies == least]
            if n and more and rest:
                assert max(more) <= min(rest)
    return got


@pytest.mark.parametrize("settings", [{}, {"weights": (1, 5), "share": 0.4, "most": 1.0}, {"share": 3.0}, {"share": 0.0}])
def test_documents(spark, documents, settings):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    check(mixing.mix(documents, **settings), rows, **settings)


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x " * 50_000, "a"), (None, "one two", None), (5, "a b c", None), (6, " ", "é"),
            (7, "z", "Z"), (7, "z", "Z"), (8, "only", "\U0001f600"), (9, "q r", "￿")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, draw string, size int")
    got = check(mixing.mix(df), rows)
    assert got[0].asDict().keys() == {"doc_id", "text", "source", "draw", "size", "mix"}


def test_all_are_taken_that_do_not_reach_the_rest(spark):
    """The long text does not fit, and the short ones together are less than the 10.4 words wanted."""
    rows = [(1, "x " * 100, "a"), (2, "a b c", "a"), (3, "d", "a")]
    got = check(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), share=0.1), rows, share=0.1)
    assert {r.doc_id: r.mix.copies for r in got} == {1: 0, 2: 1, 3: 1}


def test_reruns_agree_however_the_rows_are_dealt(spark, documents):
    def copies(df):
        return sorted((r.doc_id, r.mix.copies) for r in mixing.mix(df).collect())

    assert copies(documents) == copies(documents.repartition(5, "text"))


def test_hot_source_is_cut_in_bands(spark):
    docs = spark.range(40_000).select(
        F.col("id").alias("doc_id"), F.lit("").alias("text"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("source")
    )
    got = mixing.mix(docs, size=F.col("doc_id") % 7, weights=(1, 4)).groupBy("source").agg(
        F.sum(F.col("mix.size") * F.col("mix.copies")).alias("taken"), F.first("mix.target").alias("target")
    )
    for r in got.collect():
        assert abs(r.taken - r.target) <= 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(df).collect() == []


def test_name_clash(spark, documents):
    with pytest.raises(ValueError):
        mixing.mix(documents.withColumn("mix", F.lit(1)))


@pytest.mark.parametrize("key", [7, None])
def test_repeated_rows_are_drawn_one_by_one(spark, key):
    """1000 rows alike: as many are taken as meet the target."""
    df = spark.createDataFrame([(key, "one two three four", "a")] * 1000 + [(8, "x y", "b")], "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    for source in "ab":
        mine = [r.mix for r in got if r.source == source]
        assert abs(sum(m.size * m.copies for m in mine) - mine[0].target) <= mine[0].size / 2
    assert len(got) == 1001


def test_long_documents_do_not_end_the_sample(spark):
    """One document is longer than the rest by far; the short ones meet the target."""
    rows = [(0, "w " * 50_000, "a")] + [(i, "w " * 100, "a") for i in range(1, 501)] + [(900 + i, "w " * 50, "b") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for seed in range(3):
        got = [r.mix for r in mixing.mix(df, weights=(1, 1), share=0.3, seed=seed).collect()]
        target = got[0].target
        mine = [m for m in got if m.target == target]
        assert abs(sum(m.size * m.copies for m in mine) - target) <= 25_000 + 50
        if not any(m.size == 50_000 and m.copies for m in mine):
            assert abs(sum(m.size * m.copies for m in mine) - target) <= 50


def test_extra_columns(spark):
    names = ["row", "draw", "below1", "last", "rest", "place", "taken", "copy", "rows", "size", "target", "_source"]
    df = spark.createDataFrame([(i, "a b c", "s", *names) for i in range(4)], "doc_id long, text string, source string" + "".join(f", `{c}` string" for c in names))
    got = mixing.mix(df).collect()
    assert [r[3:-1] for r in got] == [tuple(names)] * 4 and {r.mix.size for r in got} == {3}
