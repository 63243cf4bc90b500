import gzip
import hashlib
import base64
import random
import tracemalloc
import uuid

import pytest
from pyspark.sql import functions as F

from cargolens.llm import warc

SCHEMA = "page_id long, url string, html string, digest string"


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def brute(rows, least=0):
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == payload and j is not None]
        keeper = max(same, default=None)
        lone = len([1 for _, _, h in rows if (h or "").encode() == payload]) < 2
        revisit = not lone and len(payload) >= least and keeper is not None and (i is None or i < keeper)
        out.append((i, len(payload), sha(payload), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


def read(df):
    rows = df.select(warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("r"))
    return sorted((tuple(r) for r in rows.collect()), key=str)


ROWS = [(1, "u1", "same"), (2, "u2", "same"), (3, None, "other é"), (4, "a\r\nb: c", None), (5, "", ""), (None, "n", "same"),
        (6, "u", "x" * 500_000), (7, "u", "WARC/1.1\r\n\r\n"), (8, "u", "x" * 500_000), (None, "m", "nobody else"), (2, "u2", "same"),
        (-3, "http://é.example/", "\x00\r\n\r\n")]


@pytest.mark.parametrize("least", [0, 5, 10**9])
def test_pages_read_back(spark, least):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], SCHEMA)
    assert read(warc.archive(df, least)) == brute(ROWS, least)


def test_given_pages(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in table.collect()]
    assert read(warc.archive(table)) == brute(rows)


def test_empty_table(spark):
    assert warc.archive(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("w") / "a")
    df = spark.createDataFrame([(*r, "x") for r in ROWS], SCHEMA)
    warc.write_pages(df.coalesce(1), path)
    return path


def test_payloads_and_headers(spark, archive):
    rows = {r.record_id: r for r in warc.read_records(spark, archive).collect() if r.record_type == "response"}
    assert bytes(rows["urn:page:3"].payload) == "other é".encode()
    assert bytes(rows["urn:page:8"].payload) == b"x" * 500_000
    assert bytes(rows["urn:page:-3"].payload) == b"\x00\r\n\r\n"
    assert rows["urn:page:3"].target_uri is None
    assert warc.read_records(spark, archive).filter("record_id = 'urn:page:4'").first().target_uri == "a%0D%0Ab: c"
    assert {r.payload for r in warc.read_records(spark, archive, "skip").collect()} == {None}


def test_any_gzip_reader_can_read_it(spark, archive):
    import glob

    raw = b"".join(gzip.open(f).read() for f in glob.glob(f"{archive}/*.warc.gz"))
    assert raw.count(b"WARC/1.1\r\nWARC-Type: ") == len(ROWS)


def test_filters_are_pushed_and_payloads_skipped(spark, archive, monkeypatch):
    records = warc.read_records(spark, archive)
    some = records.filter((F.col("record_type") == "revisit") & F.col("refers_to").isNotNull())
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter " not in plan
    assert {r.record_type for r in some.collect()} == {"revisit"}
    assert records.filter(F.col("target_uri").startswith("u1") & (F.col("payload_bytes") > 3)).count() == 1
    assert records.filter(F.col("record_id").isin("urn:page:7", "urn:page:99")).count() == 1
    reader = warc.WarcReader({"path": archive})
    reader.wanted = [("record_type", "in", {"revisit"})]
    real = warc.Members.block

    def only_http(self, length, stop_at_http=False):
        assert stop_at_http
        return real(self, length, stop_at_http)

    monkeypatch.setattr(warc.Members, "block", only_http)
    assert sum(1 for p in reader.partitions() for _ in reader.read(p)) == some.count() == 4


@pytest.mark.parametrize("split", [200, 1000, 7777])
def test_every_stretch_has_its_own_records(archive, split):
    reader = warc.WarcReader({"path": archive, "splitBytes": str(split), "payload": "skip"})
    got = [r[1] for p in reader.partitions() for r in reader.read(p)]
    assert sorted(got) == sorted(f"urn:page:{'none' if i is None else i}" for i, *_ in ROWS)


def test_archives_of_others(spark, tmp_path):
    """Members without the length field, and other record types."""
    rng = random.Random(1)
    raw = []
    for i in range(5):
        block = bytes(rng.randrange(256) for _ in range(5000))
        head = f"WARC/1.0\r\nWARC-Type: {'warcinfo' if i == 2 else 'resource'}\r\nWARC-Record-ID: <urn:uuid:{uuid.UUID(int=i)}>\r\nContent-Length: {len(block)}\r\n\r\n"
        raw.append(gzip.compress(head.encode() + block + b"\r\n\r\n"))
    (tmp_path / "x.warc.gz").write_bytes(b"".join(raw))
    got = warc.read_records(spark, str(tmp_path)).filter("record_type = 'resource'").collect()
    assert [r.payload_bytes for r in got] == [5000] * 4


@pytest.mark.parametrize("split", [200, 1000, 7777, 10**6])
@pytest.mark.parametrize("own", ["", "first", "last", "between", "turns"])
def test_every_stretch_of_archives_of_others(tmp_path, split, own):
    """Members without the length field are found behind the first stretch, too, also among members with it."""
    rng = random.Random(2)
    members = []
    for i in range(40):
        row = {"record_type": "resource", "record_id": f"urn:{i}"}
        raw = warc.record(row, rng.randbytes(rng.randrange(1, 3000)), 0)
        ours = {"": False, "first": i < 9, "last": i > 30, "between": 12 < i < 25, "turns": i % 4 == 3}[own]
        members.append(warc.member(raw) if ours else gzip.compress(raw))
    (tmp_path / "x.warc.gz").write_bytes(b"".join(members))
    reader = warc.WarcReader({"path": str(tmp_path), "splitBytes": str(split), "payload": "skip"})
    assert [r[1] for p in reader.partitions() for r in reader.read(p)] == [f"urn:{i}" for i in range(40)]


def test_broken_archives(tmp_path):
    (tmp_path / "x.warc.gz").write_bytes(b"no gzip here")
    reader = warc.WarcReader({"path": str(tmp_path)})
    with pytest.raises(ValueError):
        list(reader.read(reader.partitions()[0]))
    row = {"record_type": "response", "record_id": "a", "payload_digest": sha(b"one")}
    (tmp_path / "x.warc.gz").write_bytes(warc.member(warc.record(row, b"two", 3)))
    with pytest.raises(ValueError, match="digest"):
        list(reader.read(reader.partitions()[0]))
    (tmp_path / "x.warc.gz").write_bytes(warc.member(warc.record(row, bytes(range(256)) * 99, 3))[:-2000])
    reader.payload = "skip"
    assert len(list(reader.read(reader.partitions()[0]))) <= 1


def test_unknown_option():
    with pytest.raises(ValueError):
        warc.WarcReader({"path": "x", "payload": "some"})


def test_skipping_keeps_nothing_of_a_long_record(tmp_path):
    """A record of another writer that nobody wants is inflated through without being held."""
    row = {"record_type": "resource", "record_id": "urn:long"}
    long = gzip.compress(warc.record(row, random.Random(3).randbytes(24_000_000), 0), 1)
    short = gzip.compress(warc.record(row | {"record_id": "urn:short"}, b"x", 0))
    (tmp_path / "x.warc.gz").write_bytes(long + short)
    reader = warc.WarcReader({"path": str(tmp_path), "payload": "skip"})
    reader.wanted = [("record_id", "in", {"urn:short"})]
    tracemalloc.start()
    assert [r[1] for p in reader.partitions() for r in reader.read(p)] == ["urn:short"]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 4_000_000
