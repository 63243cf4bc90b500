import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cargolens.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(PATH)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts, vocabulary):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    first, ids = bpe.encode_texts(offsets, np.frombuffer(b"".join(raw), np.uint8), vocabulary)
    return [ids[a:b].tolist() for a, b in zip(first, first[1:], strict=False)]


def test_random_texts_as_the_library(vocabulary, library):
    rng = random.Random(5)
    pool = "aest AEST''''rvlmd  \n\t\r\x0b\x1c\x1f\x85\xa0 　éßñ.,!?-—0123٣½²ⅷ漢字かな👍🏽́‍\u0000"
    words = ["'s", "'t", "'re", "'ve", "'ll", "'LL", " 's", "\n's", "!'s", "''s", "don't", "we'll've", "x'd1", "'relate", "<|endoftext|>"]
    texts = ["", " ", "  ", "a", "'", "' s", "a ", "a  ", "a\n", " \n a", "\n\nb", "'s", "it's 's", "a" * 3000, " " * 700 + "x", "ab" * 500]
    for _ in range(3000):
        parts = [rng.choice(words) if rng.random() < 0.3 else "".join(rng.choices(pool, k=rng.randrange(1, 9))) for _ in range(rng.randrange(1, 12))]
        texts.append("".join(parts))
    texts += [chr(c) + "a" + chr(c) + " " + chr(c) for c in range(0x3100) if c < 0xD800]
    got = encoded(texts, vocabulary)
    for text, ids in zip(texts, got, strict=True):
        assert ids == library.encode_ordinary(text), repr(text)


def test_documents_as_the_library(spark, documents, vocabulary, library):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = bpe.decode(bpe.encode(documents, vocabulary), vocabulary).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(r.ids)
        assert bytes(r.decoded).decode() == texts[r.doc_id]


@pytest.mark.parametrize("packed", [True, False])
def test_odd_rows(spark, vocabulary, library, packed):
    rows = [(1, None), (2, ""), (None, "a null id"), (3, "same"), (3, "same"), (4, "long word " * 90_000), (5, "x" * 200_000)]
    df = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(df, vocabulary, packed), vocabulary).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded).decode()) for r in got) == sorted((i or 0, t or "") for i, t in rows)
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist() if packed else r.ids
        assert ids == library.encode_ordinary(bytes(r.decoded).decode())


def test_null_and_unknown_ids(spark, vocabulary):
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(df, vocabulary).orderBy("doc_id").collect()] == [None, b""]
    with pytest.raises(ValueError):
        vocabulary.decode(np.array([10**6]))


def test_empty_table(spark, vocabulary):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(df, vocabulary), vocabulary).collect() == []


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 20_000, np.int64).astype(np.uint64))
    assert sorted(bpe.PerfectHash(keys)(keys).tolist()) == list(range(len(keys)))


def test_hash_clash_is_looked_at(monkeypatch, vocabulary, library):
    """Pre-tokens that share a hash are encoded each by itself."""
    real = bpe.rolling
    monkeypatch.setattr(bpe, "rolling", lambda d, s, e: np.where(e - s > 7, np.uint64(1), real(d, s, e)))
    texts = ["wholly different xylophonically andersonville qqqqqqqqqqqq"]
    assert encoded(texts, vocabulary)[0] == library.encode_ordinary(texts[0])


def test_what_is_remembered_is_bounded_by_bytes(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 2000)
    monkeypatch.setattr(bpe, "REMEMBERED_PIECE", 64)
    vocabulary.merged.clear()
    vocabulary.remembered = 0
    texts = [f"qzx{i}vvkq" * 3 + " " for i in range(50)] + ["zq" * 500, "zqé" * 12]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    first, ids = bpe.encode_texts(offsets, np.frombuffer(b"".join(raw), np.uint8), vocabulary)
    again = bpe.encode_texts(offsets, np.frombuffer(b"".join(raw), np.uint8), vocabulary)
    assert (ids == again[1]).all() and (first == again[0]).all()
    assert sum(len(k) + len(v) + bpe.EACH for k, v in vocabulary.merged.items()) == vocabulary.remembered <= 2000
    assert max(map(len, vocabulary.merged)) <= 64
