import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cargolens.llm import collocations
from cargolens.llm.collocations import Phrases, lang_hash
from cargolens.llm.textbytes import utf8

SCHEMA = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(rows, least=10, longest=3, cover=50, top=2000):
    out = []
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i : i + n])] += 1
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in often.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    around[p[i : i + n]] = max(around[p[i : i + n]], a)
        kept = []
        for p, a in often.items():
            if 100 * around[p] >= cover * a and around[p]:
                continue
            score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for n, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, n, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def mined(spark, rows, **more):
    return sorted(map(tuple, collocations.collocations(spark.createDataFrame(rows, SCHEMA), **more).collect()))


def texts(n, seed):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "delta", "é", "Éa", "x" * 300, "of", "the"]
    for i in range(n):
        parts = [rng.choice([*words, "new york", "new york city", "a priori"]) + rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n"]) for _ in range(rng.randrange(60))]
        yield i, "".join(parts), rng.choice(["en", "de", None, "und"])


@pytest.mark.parametrize("sample_of", [1, 4, 100000])
def test_against_brute_force(spark, sample_of):
    """Whatever the sample proposes, also nothing: the border's failures bring all phrases."""
    rows = list(texts(300, 1))
    want = brute(rows)
    assert len(want) > 50
    assert mined(spark, rows, sample_of=sample_of) == want
    assert mined(spark, rows, sample_of=sample_of, least=3, longest=2, top=7) == brute(rows, 3, 2, 50, 7)


def test_passes_until_nothing_is_missed(spark):
    rows = [(i, "one two three", "en") for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found, passes = collocations.frequent_phrases(docs, 10, 3, sample_of=1)
    assert passes == 2 and found.filter("size = 3").count() == 1
    found, passes = collocations.frequent_phrases(docs, 10, 3, sample_of=1 << 40)
    assert passes == 3 and found.filter("size = 3").count() == 1


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", None), (None, "a b c " * 30, None), (None, "a b c " * 30, "und"), (3, ".,;:!?\n\r\x0b\x0c \t", "en")]
    rows += [(7, "copy of a row, copy", "en")] * 12 + [(8, "z" * 100_000 + " y", "en")] * 11 + [(9, "a b a b", "fr")] * 10
    assert mined(spark, rows) == brute(rows)


def test_long_text(spark):
    rows = [(1, "p q r s. " * 700_000, "en"), (2, "p q " * 50, "de")]
    assert mined(spark, rows) == brute(rows)


def test_little(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, None, None)]) == []
    assert mined(spark, [(1, "one two three", "en")]) == []


def test_extra_columns(spark):
    names = ["size", "phrase", "hash", "n", "words", "k", "first", "last", "a", "l", "r", "score", "x", "share", "rank", "around"]
    rows = list(texts(60, 2))
    wide = spark.createDataFrame([(*r, *names) for r in rows], SCHEMA + "".join(f", `{c}` string" for c in names))
    assert sorted(map(tuple, collocations.collocations(wide, least=3).collect())) == brute(rows, least=3)


def test_words_of_one_hash_stay_apart(monkeypatch):
    """Where hashes clash the bytes decide."""
    monkeypatch.setattr(collocations, "word_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    offsets, data = utf8(pa.array(["ab cd ab", "cd"]))
    p = Phrases(offsets, data, np.array([0, 1]), np.array([0, 0], np.uint64))
    assert p.numbers(np.ones(4, bool)).tolist() == [0, 1, 0, 2]


def test_languages_are_no_words():
    offsets, data = utf8(pa.array(["en es", "en es"]))
    p = Phrases(offsets, data, np.array([0, 1]), np.array([lang_hash("en"), lang_hash("es")], np.uint64))
    assert len(set(p.hashes(1).tolist())) == 4
