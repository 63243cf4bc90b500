import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from cargolens.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_print(text, shingle=3):
    words = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(prints, max_bits):
    """Component per position, over all pairs."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, p in enumerate(prints):
        for j in range(i):
            if (p ^ prints[j]).bit_count() <= max_bits:
                label[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def brute(rows, max_bits=2, shingle=3):
    prints = [brute_print(t, shingle) for _, t in rows]
    classes = brute_classes(prints, max_bits)
    out = []
    for (i, _), p, c in zip(rows, prints, classes, strict=True):
        ids = [r[0] for r, k in zip(rows, classes, strict=True) if k == c and r[0] is not None]
        out.append((i, f"{p:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:3] for r in df.collect()), key=str)


def test_same_as_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert got(simhash.near_duplicates(documents)) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"word{i % 700}" for i in range(90_000))
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "É É"), (7, "é é"), (7, "É É"), (None, "one"),
            (None, "quite another text"), (8, long), (9, long + " end"), (-1, "a b c d"), (10, "x y z x y z x y z")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, simhash string")
    assert got(simhash.near_duplicates(df)) == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []


@pytest.mark.parametrize("crowded", [1, 64])
@pytest.mark.parametrize("max_bits", [0, 1, 2])
def test_links_of_paired_and_crowded_keys(spark, monkeypatch, crowded, max_bits):
    """Chains and clouds of fingerprints have the components of all pairs."""
    rng = random.Random(7)
    prints = {rng.getrandbits(64) for _ in range(40)}
    base = rng.getrandbits(64)
    for _ in range(150):
        base ^= 1 << rng.randrange(64)
        prints.add(base)
    for _ in range(60):
        base ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
        prints.add(base)
    prints = sorted(prints)
    monkeypatch.setattr(simhash, "PAIRED_MEMBERS", crowded)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(s,) for s in signed], "node long")
    found = {r.node: r.component for r in simhash.components(simhash.links(nodes, max_bits)).collect()}
    groups = {}
    for s, c in zip(signed, brute_classes(prints, max_bits), strict=True):
        groups.setdefault(c, []).append(s)
    assert {s: min(g) for g in groups.values() for s in g} == {s: found.get(s, s) for s in signed}


def test_pairs_share_a_key(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(50):
        a = rng.getrandbits(63)
        rows.append((a, a ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63))))
    df = spark.createDataFrame(rows, "a long, b long")
    keys = [df.select("a", simhash.block_keys(F.col(c), 2, 4).alias("k")) for c in ("a", "b")]
    assert keys[0].join(keys[1], ["a", "k"]).select("a").distinct().count() == len({a for a, _ in rows})


def test_one_of_each(spark):
    rows = [(5, "a b c d", "x"), (2, "a b c d", "y"), (None, "a b c d", "z"), (None, "alone here now", "n"), (None, "alone here now", "n"),
            (7, "one two three four", "r"), (7, "one two three four", "r"), (7, "quite other words than those", "s"), (8, None, "e"), (9, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _extra string")
    kept = simhash.one_of_each(df, simhash.near_duplicates(df))
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[3], rows[5], rows[7], rows[8]], key=str)
