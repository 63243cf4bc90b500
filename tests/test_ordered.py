"""Ordered operators on the range path, checked by brute force."""

import json
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cargolens.operators import lists, ordered
from cargolens.operators.numbering import assign_sequence, instalments
from cargolens.session import names_under, scratch_root


def skewed(spark, n=600, seed=1):
    """A third of all rows under one key, the rest spread; one NULL key."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rnd.randrange(40)}")
        rows.append((key, i, f"v{i}" if rnd.random() < 0.05 else None))
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, seq long, v string").repartition(5)


def by_key(rows):
    groups = {}
    for k, seq, v in rows:
        groups.setdefault(k, []).append((seq, v))
    return {k: sorted(g) for k, g in groups.items()}


def test_serial_per_key(spark):
    rows, df = skewed(spark)
    want = {(k, seq): i + 1 for k, g in by_key(rows).items() for i, (seq, _) in enumerate(g)}
    out = ordered.serial(df, ["k"], ["seq"], "n")
    assert out.columns == ["k", "seq", "v", "n"]
    assert {(r.k, r.seq): r.n for r in out.collect()} == want


def test_serial_spreads_the_hot_key(spark):
    _, df = skewed(spark)
    ranged = ordered._ranged(df, ["k"], [F.col("seq")])
    parts = ranged.filter("k = 'hot'").groupBy(ordered._PID).count().collect()
    assert len(parts) > 3
    assert max(r["count"] for r in parts) < 100


ORDERS = {
    "up": lambda: ["seq"],
    "down, then up": lambda: [F.col("v").desc(), "seq"],
    "nulls elsewhere": lambda: [F.col("v").asc_nulls_last(), F.col("seq").desc()],
    "all alike first": lambda: [F.lit("x"), F.col("seq")],
}


@pytest.mark.parametrize("order", ORDERS)
def test_serial_in_any_order(spark, order):
    """Against one window per key, also where the direction changes from column to column."""
    order = ORDERS[order]()
    _, df = skewed(spark, seed=5)
    df = df.withColumn("v", F.when(F.col("seq") % 4 > 0, F.concat(F.lit("v"), F.col("seq") % 3)))
    out = ordered.serial(df, ["k"], order, "n").withColumn("m", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    assert out.filter("n <> m").count() == 0
    assert ordered.serial(df, [], order, "n").select("n").distinct().count() == 600


def test_nothing_runs_or_is_written_while_the_query_is_built(spark):
    _, df = skewed(spark)
    before = set(names_under(spark, scratch_root(spark)))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("built", "numbering")
    value = F.when(F.col("v").isNotNull(), F.struct("v"))
    ordered.serial(df, ["k"], ["seq"], "n")
    ordered.carry_forward(df, ["k"], ["seq"], value, "c")
    assert not tracker.getJobIdsForGroup("built")
    spark.sparkContext.setJobGroup(None, None)
    assert set(names_under(spark, scratch_root(spark))) == before


def test_serial_of_odd_tables(spark):
    none = spark.createDataFrame([], "k string, seq long")
    assert ordered.serial(none, ["k"], ["seq"], "n").collect() == []
    assert ordered.serial(none, [], ["seq"], "n").collect() == []
    alike = spark.createDataFrame([("a", None)] * 7 + [(None, 1)], "k string, seq long")
    got = ordered.serial(alike, ["k"], ["seq"], "n").collect()
    assert sorted(r.n for r in got if r.k) == list(range(1, 8)) and [r.n for r in got if r.k is None] == [1]


def test_serial_whole_table(spark):
    rows, df = skewed(spark)
    out = assign_sequence(df, [F.col("seq").desc()], base=100)
    want = {seq: 101 + i for i, seq in enumerate(sorted((r[1] for r in rows), reverse=True))}
    assert {r.seq: r.sequence_no for r in out.collect()} == want


@pytest.mark.parametrize("include_current", [True, False])
def test_carry_forward(spark, include_current):
    rows, df = skewed(spark, seed=7)
    want = {}
    for k, g in by_key(rows).items():
        last = None
        for seq, v in g:
            before = last
            last = v if v is not None else last
            want[(k, seq)] = last if include_current else before
    value = F.when(F.col("v").isNotNull(), F.struct("v"))
    out = ordered.carry_forward(df, ["k"], ["seq"], value, "c", include_current)
    assert {(r.k, r.seq): r.c.v if r.c else None for r in out.collect()} == want


def test_carry_forward_takes_a_struct_of_nulls(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, None, 1), (3, None, 0)], "seq int, v string, is_set int")
    value = F.when(F.col("is_set") == 1, F.struct("v"))
    out = ordered.carry_forward(df.withColumn("k", F.lit(1)), ["k"], ["seq"], value, "c").orderBy("seq").collect()
    assert [r.c.v for r in out] == ["a", None, None]
    assert all(r.c is not None for r in out)


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 2, None), (2, 1, "z")], "k int, o int, v string")
    out = ordered.first_per_key(df, ["k"], ["o"])
    assert sorted((r.k, r.o, r.v) for r in out.collect()) == [(1, 2, None), (2, 1, "z")]


def test_lists_are_whole(spark):
    rows, df = skewed(spark)
    named = df.withColumn("text", F.format_string("%05d", "seq")).filter("k is not null")
    got = {r.k: r.l for r in lists.string_list(named, ["k"], "text", "l").collect()}
    assert got == {k: ",".join(f"{s:05d}" for s, _ in g) for k, g in by_key(rows).items() if k}


def test_array_rows_are_one_array(spark):
    rows, df = skewed(spark)
    out = lists.array_rows(df, ["k"], ["seq"], {"s": "seq", "v": "v"}, F.col("seq") % 2 == 0)
    texts = {}
    for r in sorted(out.collect(), key=lambda r: r.pos):
        texts.setdefault(r.k, []).append(r.text)
    assert {k: len(t) for k, t in texts.items()} == {k: 2 + sum(s % 2 == 0 for s, _ in g) for k, g in by_key(rows).items()}
    for k, g in by_key(rows).items():
        assert json.loads("".join(texts[k])) == [{"s": s, "v": v} for s, v in g if s % 2 == 0]


def test_nest_keeps_keys_without_items(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 1, None)], "k int, o int, v string")
    out = lists.nest(df, ["k"], ["o"], {"v": "v"}, "items", where=F.col("v").isNotNull())
    assert {r.k: [i.v for i in r["items"]] for r in out.collect()} == {1: ["a"], 2: []}


def test_count_by_code(spark):
    df = spark.createDataFrame([(1, "40HC"), (1, "20GP"), (1, "20GP"), (2, None)], "k int, code string")
    out = lists.count_by_code(df, ["k"], "code", "l")
    assert {r.k: r.l for r in out.collect()} == {1: "2*20GP,1*40HC", 2: None}


def test_gather_lines_null_blanks_the_document(spark):
    rows = [("a", 1, "x"), ("a", 2, None), ("a", 3, "z"), ("b", 2, "two"), ("b", 1, "one"), ("b", 3, "three")]
    df = spark.createDataFrame(rows, "k string, o int, line string")
    out = lists.gather_lines(df, "k", ["o"]).collect()
    assert [r.content for r in out if r.k == "a"] == [None]
    assert "\n".join(r.content for r in out if r.k == "b") == "one\ntwo\nthree"
    kept = lists.gather_lines(df, "k", ["o"], null_blanks_all=False).filter("k = 'a'").first()
    assert kept.content == "x\n\nz"


def test_instalments(spark):
    sends = [("m", "r", i) for i in range(1, 9)] + [("p", "r", 1), ("p", "r", 2), ("m", None, 20), ("m", None, 21)]
    prior = spark.createDataFrame([("p", "r", 4), ("q", "r", 9), ("m", None, 3)], "m string, r string, instalment_no long")
    df = spark.createDataFrame(sends, "m string, r string, seq long")
    out, state = instalments(df, prior, ["m", "r"], "seq")
    got = {}
    for row in out.orderBy("seq").collect():
        got.setdefault((row.m, row.r), []).append(row.instalment_no)
    assert got == {("m", "r"): [1, 1, 2, 3, 4, 5, 6, 7], ("p", "r"): [4, 5], ("m", None): [1, 1]}
    after = sorted((r.m, r.r or "", r.instalment_no) for r in state.collect())
    assert after == [("m", "", 1), ("m", "", 1), ("m", "", 3), ("m", "r", 8), ("p", "r", 6), ("q", "r", 9)]
