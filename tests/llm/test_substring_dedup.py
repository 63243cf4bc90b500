import hashlib
import re
from collections import defaultdict

import pytest

from cargolens.llm import substring_dedup
from cargolens.llm.substring_dedup import chunks_for, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"


def brute(rows, window):
    """Every window of every document against the smallest document that has it."""
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    first = defaultdict(lambda: float("inf"))
    for i, w in words:
        for a in range(len(w) - window + 1):
            key = tuple(w[a : a + window])
            first[key] = min(first[key], float("inf") if i is None else i)
    out = []
    for i, w in words:
        gone = set()
        for a in range(len(w) - window + 1):
            if first[tuple(w[a : a + window])] < (float("inf") if i is None else i):
                gone.update(range(a, a + window))
        kept = " ".join(x for a, x in enumerate(w) if a not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in df.collect()), key=str)


@pytest.mark.parametrize("window,chunks", [(50, None), (7, 3), (2, 5)])
def test_same_as_brute_force(spark, documents, window, chunks):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert got(remove_repeats(documents, window, chunks)) == brute(rows, window)


def test_odd_rows(spark):
    passage = " ".join(f"w{i}" for i in range(9))
    rows = [
        (3, f"a b\t{passage}\nc d"),
        (1, f"{passage}"),
        (7, f"x y z {passage} tail"),
        (7, f"{passage}"),
        (7, f"{passage}"),
        (None, passage),
        (None, passage),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (8, "same " * 3000),
        (9, "same " * 3000),
        (10, "é è " * 40),
        (2, "é è\n" * 40),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in rows], DOCS + ", chunk string")
    for window in (2, 5, 9):
        assert got(remove_repeats(df, window, 3)) == brute(rows, window)
    spans = {r.n_removed: r.spans for r in remove_repeats(df, 9, 3).filter("doc_id = 3").collect()}
    assert [(s.start, s.end) for s in spans[9]] == [(2, 11)]


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], DOCS)).collect() == []


def test_window_too_small(spark, documents):
    with pytest.raises(ValueError):
        remove_repeats(documents, 1)


def test_words_that_a_polynomial_cannot_tell_apart(spark):
    """Two words of 1024 letters whose sums of powers agree modulo 2**64, whatever the odd base."""
    turns = [bin(i).count("1") % 2 for i in range(1024)]
    first, second = ("".join("ab"[t ^ flip] for t in turns) for flip in (0, 1))
    common = " ".join(f"w{i}" for i in range(49))
    df = spark.createDataFrame([(1, f"{common} {first}"), (2, f"{common} {second}"), (3, f"{common} {first}")], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in remove_repeats(df, window=50).collect()}
    assert got == {1: 0, 2: 0, 3: 50}


def test_repeated_rows_and_shuffled_input(spark):
    """One row makes up most of the table; the rest comes out of a shuffle."""
    passage = " ".join(f"w{i}" for i in range(9))
    rows = [(5, f"{passage} tail")] * 40 + [(2, f"head {passage}"), (9, passage), (None, None)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    assert got(remove_repeats(df, 5, 6)) == brute(rows, 5)


def test_chunks_follow_the_bytes(spark, documents, monkeypatch):
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert chunks_for(documents.limit(0)) == few
    size = sum(len((r.text or "").encode()) for r in documents.select("text").collect())
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", size // (3 * few))
    assert 3 * few <= chunks_for(documents) <= 3 * few + 2
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert got(remove_repeats(documents, 50)) == brute(rows, 50)


def test_rows_of_one_text_are_spread(spark):
    """Repeats of one row do not meet in one chunk, and each chunk is a task that keeps its texts."""
    df = spark.createDataFrame([(1, "a b c")] * 64, DOCS)
    plan = remove_repeats(df, 2, 8)._jdf.queryExecution().executedPlan().toString()
    assert "monotonically_increasing_id" in plan and "xxhash64(doc_id" not in plan
    assert "hashpartitioning" not in plan and plan.count("Exchange shufflepartitionidpassthrough") == 7
