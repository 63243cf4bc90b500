import math
import random
from collections import Counter

import numpy as np
import pytest

from cargolens.llm import fingerprint as fp


def arrays(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return offsets, np.frombuffer(b"".join(raw), np.uint8)


def brute_starts(raw):
    """Feature windows of one text, window by window."""
    w = fp.WINDOW
    ranks = []
    for i in range(len(raw) - w + 1):
        total = sum(round(c * math.log2(c) * fp.STEP) for c in Counter(raw[i : i + w]).values())
        ranks.append(int(np.rint((math.log2(w) * w * fp.STEP - total) / (w * fp.STEP) * (fp.RANKS / math.log2(w)))))
    wins = Counter()
    for i in range(len(ranks)):
        span = range(i, min(i + w, len(ranks)))
        wins[max(span, key=lambda j: (ranks[j], -j))] += 1
    return sorted(i for i, n in wins.items() if n >= fp.WINS)


def random_texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "thing", "of", "a", "wherever", "été", "  ", "\n", "zzzzzzzzzzzzzzzz", "0123456789", "x"]
    return [" ".join(rng.choices(words, k=rng.randrange(0, 60))) for _ in range(n)] + ["", "a", "b" * 31, "c" * 32, "d" * 300]


def test_features_as_by_hand():
    texts = random_texts(3, 60)
    offsets, data = arrays(texts)
    row, hashes = fp.features(offsets, data)
    for i, text in enumerate(texts):
        raw = np.frombuffer(text.encode(), np.uint8)
        at = np.array(brute_starts(text.encode()), np.int64)
        want = fp.rolling(raw, at, at + fp.WINDOW).tolist()
        want = list(dict.fromkeys(want)) or ([int(fp.rolling(raw, np.array([0]), np.array([len(raw)]))[0])] if len(raw) else [])
        assert hashes[row == i].tolist() == want


def test_equal_texts_have_equal_fingerprints_wherever_they_stand():
    texts = random_texts(4, 40)
    alone = [fp.to_text(fp.filters(*arrays([t]))[0]) for t in texts]
    assert [fp.to_text(f) for f in fp.filters(*arrays(texts))] == alone
    assert [fp.to_text(f) for f in fp.filters(*arrays(texts[::-1]))][::-1] == alone


def test_filters_are_chained_and_read_back(spark):
    rng = random.Random(1)
    text = "".join(rng.choices("abcdefghij klmnop", k=20_000))
    chain = fp.filters(*arrays([text]))[0]
    assert len(chain) == -(-len(fp.features(*arrays([text]))[0]) // fp.FEATURES) > 1
    assert np.array_equal(fp.from_text(fp.to_text(chain)), chain)
    assert chain.sum(1).max() <= fp.FEATURES * fp.BITS_PER_FEATURE


def test_likeness(documents):
    texts = [r.text for r in documents.collect() if len(r.text) > 400]
    chains = fp.filters(*arrays(texts))
    half = fp.filters(*arrays([fp.edited(t, u) for t, u in zip(texts, texts[1:], strict=False)]))
    near = [fp.likeness(a, b) for a, b in zip(chains, half, strict=False)]
    far = [fp.likeness(a, b) for a, b in zip(chains, chains[1:], strict=False)]
    assert np.median(near) > 0.6 and np.quantile(near, 0.02) > 0.4
    assert np.median(far) < 0.1
    assert all(0 <= x <= 1 for x in near + far)
    empty = fp.from_text("")
    assert fp.likeness(empty, empty) == 1 and fp.likeness(empty, chains[0]) == 0 == fp.likeness(chains[0], empty)
    assert fp.likeness(chains[0], chains[0]) == 1


def brute_edits(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        e = fp.edited(t, u)
        a, b, c = (fp.filters(*arrays([x]))[0] for x in (t, e, u))
        out.append((i, len(t), t, e, fp.to_text(a), fp.to_text(b), fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_edits_of_documents(spark, documents):
    want = brute_edits([(r.doc_id, r.text) for r in documents.collect()])
    assert got(fp.against_edits(documents.repartition(7, "text"))) == want


@pytest.mark.parametrize("ranges", [1, 2, 50])
def test_order_has_every_successor(spark, ranges, monkeypatch):
    rows = [(None, "n"), (None, None), (5, "b"), (5, "a"), (5, "a"), (9, ""), (-4, "é" * 50), (7, "x" * 90_000), (8, "word " * 600_000)]
    df = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, range string")
    real = fp.dealt_in_order
    monkeypatch.setattr(fp, "dealt_in_order", lambda d: real(d, ranges))
    assert got(fp.against_edits(df)) == brute_edits(rows)


def test_small_tables(spark):
    schema = "doc_id long, text string"
    assert fp.against_edits(spark.createDataFrame([], schema)).collect() == []
    assert got(fp.against_edits(spark.createDataFrame([(1, "alone here")], schema))) == brute_edits([(1, "alone here")])


def test_columns(spark, documents):
    df = fp.fingerprints(documents)
    pairs = fp.likenesses(df.withColumnRenamed("fingerprint", "f"), "f", "f").collect()
    assert {r.likeness for r in pairs} == {1.0}
    with pytest.raises(ValueError):
        fp.fingerprints(df)
