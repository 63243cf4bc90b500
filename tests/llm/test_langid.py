import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolens.llm import langid


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").cache()


@pytest.fixture(scope="module")
def network(table):
    return langid.learn(table)


def test_held_out_documents(spark, table, network):
    rows = langid.identify(table, network).withColumn("held", langid.held_out()).collect()
    assert len(rows) == 1000
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held and r.lang]
    right = [r.language.pred == r.lang for r in held]
    assert len(held) > 200 and sum(right) / len(right) > 0.97
    assert all(0 <= r.language.score <= 1 for r in rows)


def test_one_window_as_by_hand(network):
    x = np.frombuffer(bytes(range(65, 90)) * 20, np.uint8)[: network.window][None]
    features = []
    for w, table in network.filters.items():
        n = x.shape[1] - w + 1
        at = [[sum(table[j, x[0, i + j], f] for j in range(w)) for i in range(n)] for f in range(table.shape[2])]
        features += [max(a) for a in at]
    z = np.maximum(np.array(features) + network.shift, 0) @ network.weights + network.bias
    want = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    assert np.allclose(network.predict(x)[0], want, atol=1e-4)
    assert np.allclose(network.pooled(x)[0], network.maxima(x))


def test_every_window_counts(spark, network):
    n = network.window
    en, de = b"the thing that was with the other " * 300, "der schein und die freiheit nicht für ".encode() * 300
    parts = [en[:n], en[n : 2 * n], en[:100]]
    p = network.predict(langid.windows_of(parts, n))
    want = (p * np.array([n, n, 100])[:, None]).sum(0) / (2 * n + 100)
    text = (en[: 2 * n] + en[:100]).decode()
    df = spark.createDataFrame([(text,), ((en + de * 4).decode(),)], "text string")
    got = [r.language for r in langid.identify(df, network).collect()]
    assert got[0].score == pytest.approx(want.max(), abs=1e-5)
    assert (got[0].pred, got[1].pred) == ("en", "de")


def test_odd_rows(spark, network):
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "\n"), (None, "the"), (5, "the other thing " * 60_000), (5, "漢字"), (5, "漢字")]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, pred string, score double")
    got = langid.identify(df, network).collect()
    assert [(r.doc_id, r.text, r.pred) for r in got] == [(*r, "x") for r in rows]
    assert [r.language.pred == "und" and r.language.score == 0 for r in got] == [True] * 4 + [False] * 4
    assert got[5].language.pred == "en" and got[6].language == got[7].language


def test_learning_is_bounded_repeats_and_leaves_out(table):
    sample = langid.labelled_windows(table, 10, 2, 64)
    assert sample.groupBy("lang").agg(F.count_distinct("doc_id").alias("n")).filter("n > 10").count() == 0
    assert sample.filter(langid.held_out()).count() == 0
    a, b = (langid.learn(t, per_language=20) for t in (table, table.repartition(3)))
    assert all(np.array_equal(a.filters[w], b.filters[w]) for w in a.filters)


def test_nothing_to_learn(spark):
    schema = "doc_id long, text string, lang string"
    df = spark.createDataFrame([(1, "abc", None), (None, "abc", "en"), (2, None, "en")], schema)
    assert langid.learn(df) is None
    assert {r.language.pred for r in langid.identify(df, None).collect()} == {"und"}
    empty = spark.createDataFrame([], schema)
    assert langid.learn(empty) is None
    assert langid.identify(empty, None).collect() == []


def test_the_most_frequent_labels_are_learnt(spark):
    rows = [(i, "words of a text", f"l{i % 7}" if i % 2 else "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.labelled_windows(docs, 10, 1, 8, languages=3)
    counts = docs.filter(~langid.held_out()).groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(3)
    assert {r.lang for r in got.collect()} == {r.lang for r in counts.collect()}
