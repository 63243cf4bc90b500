"""Registered queries against DuckDB, or against a brute-force version of their contract."""

import base64
import hashlib
import os
import re
import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
import tiktoken
from test_fingerprint import brute_edits
from test_secrets import brute as brute_secrets
from test_simhash import brute as brute_simhash

from cargolens.llm.queries import ORACLES, QUERIES
from oracle import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("select doc_id, text, lang, source, n_chars from documents order by doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    difference, rows = compare(con, QUERIES[name](spark, SF_DIR), ORACLES[name])
    assert difference is None
    assert rows > 0


def library():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_op3(spark, docs):
    want = [(i, n, hashlib.sha256(e.encode()).hexdigest(), a, b, x, y) for i, n, _, e, a, b, x, y in brute_edits([d[:2] for d in docs])]
    assert sorted(map(tuple, QUERIES["op3_document_fingerprints"](spark, SF_DIR).collect())) == sorted(want)


def test_op4(spark, docs):
    encoding = library()
    got = {r.doc_id: r for r in QUERIES["op4_byte_bpe"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    for i, text, *_ in docs:
        ids = encoding.encode_ordinary(text)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(b"".join(t.to_bytes(4, "little") for t in ids)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_op5(spark, con):
    larger = "/root/testdata/sf0.01"  # the smallest table holds no secrets
    docs = con.execute(f"select doc_id, text from '{larger}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in QUERIES["op5_secret_scans"](spark, larger).collect()}
    assert len(got) == len(docs)
    assert sum(r.n_assign + r.n_access + r.n_hex for r in got.values()) > 0
    for i, text in docs:
        found = brute_secrets(text)
        base = ",".join(f"{k}:{a}:{b}" for a, n, b, k in found if n < 3)
        kinds = Counter(s[3] for s in found)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert got[i].spans == ",".join(f"{k}:{a}:{b}" for a, n, b, k in found)


def test_op7(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op7_language_id"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r.held_out} == {d[0] for d in held}
    assert sum(got[i].lang_pred == lang for i, _, lang, *_ in held) / len(held) > 0.9
    assert {r.lang_pred for r in got.values()} <= {d[2] for d in docs} | {"und"}


def test_op9(spark, docs):
    got = sorted((tuple(r) for r in QUERIES["op9_simhash_dedup"](spark, SF_DIR).collect()), key=str)
    assert got == brute_simhash([d[:2] for d in docs])


def test_pipeline(spark, docs):
    """Each stage from what the one before it kept."""
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, frame, SF_DIR)
        got = [tuple(r) for r in made.collect()]
        if name == "language id":
            assert sorted(got) == [r for r in rows if re.search(r"[^\W\d_]", r[1])]
        elif name == "simhash near-dedup":
            kept = {c for _, _, c in brute_simhash([r[:2] for r in rows])}
            assert sorted(got) == [r for r in rows if r[0] in kept]
        elif name == "secret scan":
            want = []
            for i, text, lang, source, _ in rows:
                clean, at = "", 0
                for a, _, b, _ in brute_secrets(text):
                    if a >= at:
                        clean += text[at:a] + "[SECRET]"
                    at = max(at, b)
                clean += text[at:]
                want.append((i, clean, lang, source, len(clean)))
            assert sorted(got) == want
        elif name == "source mix":
            assert set(got) <= set(rows) and max(Counter(got).values()) <= 2
            words = {r[0]: len(r[1].split()) for r in rows}
            assert sum(words[r[0]] for r in got) == pytest.approx(1.5 * sum(words.values()), rel=0.1)
        else:
            encoding, texts = library(), {r[0]: r[1] for r in rows}
            assert Counter(r[0] for r in got) == Counter(r[0] for r in rows)
            assert all(r.ids == encoding.encode_ordinary(texts[r.doc_id]) for r in made.collect())
        if name != "byte-level bpe":
            assert made.columns == corpus_pipeline.COLUMNS
            frame = spark.createDataFrame(got, frame.schema)
            rows = sorted(got)
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert whole.count() == len(got) and whole.columns == ["doc_id", "n_tokens", "ids"]


@pytest.mark.parametrize("lang", [None, "held out", "und"])
def test_pipeline_keeps_texts_that_nothing_was_learnt_of(spark, lang):
    ids = [i for i in range(60) if lang != "held out" or zlib.crc32(str(i).encode()) % 3 == 1]
    rows = [(i, f"a text of words {i}", lang, "s", 5) for i in ids] + [(99, "漢字", None, "s", 2), (None, "é", None, None, None)]
    gone = [(98, "12 !", None, "s", 4), (97, None, None, "s", None), (96, "", None, "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    kept = corpus_pipeline.known_language(spark, spark.createDataFrame(rows + gone, schema), SF_DIR)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(rows, key=str)


def test_pipeline_on_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, "password=abcdef and more words", None, "é", 9), (2, "password=abcdef and more words", None, "é", 9),
            (3, "the long text " * 90_000, "en", "a", 5), (4, "the long text " * 90_000, "en", "b", 5), (None, "no id here at all", "en", "a", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {None, 2, 3}
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
