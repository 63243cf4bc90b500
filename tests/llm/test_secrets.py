import re
import time

import pytest
from pyspark.sql import functions as F

from cargolens.llm import secrets

ALL = (*secrets.BASE_RULES, *secrets.MORE_RULES)


def brute(text, rules=ALL):
    out = []
    for n, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), n, m.end(), rule.kind))
    return sorted(out)


def check(df):
    for r in secrets.scan(df).collect():
        assert [tuple(s) for s in r.secrets] == brute(r.text), r.text and r.text[:200]


def test_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(table)
    assert secrets.scan(table).filter(F.size("secrets") > 0).count() > 5


ODD = [
    "password=abcdef", "PassWord : 'x1y2z3w4'", "secret=token:abcdefgh", "token=token=abcdef", "api_key=abcdef apikey:\"zzzzzzzz", "passwd = short",
    "passwd=short password=longenough", "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 30, "xAKIA123", "a" * 24, "a" * 23, "é" * 5 + "0123456789abcdef" * 2,
    "token=" + "0123456789abcdef" * 2 + " AKIA" + "0" * 40, "password\n=abcdef", "password  ==abcdef", "tokenb=abcdefg", "password=abcdefpassword=abcdef",
    "-----BEGIN PRIVATE KEY-----", "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 20, "xoxb-1234567890-abcdefghij", "eyJhbGciOi.eyJzdWIiOi.sig_nature-0123456789012345",
    "👍password=👍abcdef token='👍", "secret:=abcdef", "api__key=abcdef", "APIKEY=ABCDEF", "paſſword=abcdef", "toKen=abcdef", "", " ",
]


def test_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "password=abcdef"), (None, None), (3, None), (3, ODD[0]), (3, ODD[0]), (9, "word " * 200_000 + "password=abcdef")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kind string")
    check(df)
    got = secrets.scan(df)
    assert got.columns == ["doc_id", "text", "kind", "secrets"] and got.count() == len(rows)


def test_many_secrets_in_one_text(spark):
    check(spark.createDataFrame([(1, "é token=abcdef " * 5000)], "doc_id long, text string"))


def test_empty_table_and_clash(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert secrets.scan(df).collect() == []
    with pytest.raises(ValueError):
        secrets.scan(df.withColumn("secrets", F.lit(1)))


def test_queries_from_regexes():
    q = {r.kind: secrets.trigram_query(r.pattern) for r in ALL}
    assert q["access"] == ("and", "aki", "kia")
    assert q["hex"] is True
    assert ("and", "tok", "oke", "ken") in q["assign"] and q["assign"][0] == "or"
    assert ("and", "api", "pi_", "i_k", "_ke", "key") in q["assign"] and ("and", "api", "pik", "ike", "key") in q["assign"]
    assert secrets.trigram_query("abc.*def|xyz") == ("or", ("and", "abc", "def"), "xyz")
    assert secrets.trigram_query("(?:abcd)+x") == ("and", "abc", "bcd")
    assert secrets.trigram_query("ab|cde") is True
    assert secrets.trigram_query("(?:abc)*") is True
    assert secrets.trigram_query("a[bc]d") is True


def holds(query, text):
    if isinstance(query, bool):
        return query
    if isinstance(query, str):
        return query in text.lower()
    return (all if query[0] == "and" else any)(holds(q, text) for q in query[1:])


def test_queries_hold_on_every_match(documents):
    texts = [r.text for r in documents.collect()] + ODD
    for rule in ALL:
        query = secrets.trigram_query(rule.pattern)
        assert all(holds(query, t) for t in texts if re.search(rule.pattern, t, re.ASCII))


def test_only_native_operators(spark, documents):
    plan = secrets.scan(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_redacted_texts(spark):
    rows = [(1, "a token=" + "0123456789abcdef" * 2 + " b AKIA" + "0" * 40 + "!"), (2, None), (3, "clean"), (4, "password=abcdef"), (5, "é secret=abcdefg é")]
    df = secrets.redact(secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [r.text for r in df.orderBy("doc_id").collect()] == ["a [SECRET] b [SECRET]!", None, "clean", "[SECRET]", "é [SECRET] é"]
    assert df.columns == ["doc_id", "text"]


def test_very_many_secrets_in_one_text(spark):
    """200,000 matches: positions and marks in about linear time."""
    text = "é password=abcdef " * 200_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    started = time.monotonic()
    [row] = secrets.redact(secrets.scan(df)).collect()
    assert row.text == "é [SECRET] " * 200_000
    assert time.monotonic() - started < 60


def test_redacted_like_brute_force(spark):
    texts = [t + " " + u for t in ODD for u in ODD[::5]] + ["x" * 4090 + " password=abcdef y" * 700, "token=" + "a" * 9000 + " z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.redact(secrets.scan(df)).collect():
        clean, at = "", 0
        for a, _, b, _ in brute(texts[r.doc_id]):
            if a >= at:
                clean += texts[r.doc_id][at:a] + "[SECRET]"
            at = max(at, b)
        assert r.text == clean + texts[r.doc_id][at:]


def test_extra_columns(spark):
    names = ["_id", "_hash", "low", "trigram", "bits0", "start", "may", "d"]
    df = spark.createDataFrame([(1, "token=abcdef", *names)], "doc_id long, text string" + "".join(f", `{c}` string" for c in names))
    [row] = secrets.scan(df).collect()
    assert row[2:-1] == tuple(names) and [tuple(s) for s in row.secrets] == brute("token=abcdef")
