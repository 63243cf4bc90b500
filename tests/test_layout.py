"""Search index, clustered files and buckets: equal rows, and fewer files, row groups and shuffles."""

import glob
import random
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cargolens.catalog.documents import MANIFEST
from cargolens.operators.predicates import like_pattern, search_contains
from cargolens.plans import manifest as man
from cargolens.sources import search_index as si
from cargolens.sources.bucketed import store, stored, write_bucketed
from cargolens.sources.clustered import bounds, write_clustered
from cargolens.standins import StandIns

QUERIES = ["rr", "eti_1", "m%3.x", r"a\_b", r"50\%", "", "%", "_", "é漢字x", "😀😀b", "zzz", "mnr1", "abc%xyz", "\\", r"q\z9", "name 1"]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(1)
    odd = [None, "", "ab", "A_B", "50%", "x50%y", "É漢字X", "😀😀B", "ABC and XYZ", "XYZ ABC", "\\", "QZ9", "Q\\Z9", "ETIX1", "RR"]
    rows = [(i, f"{'MNR' if i < 100 else 'NAME '}{i}.XML") for i in range(400)]
    rows += [(1000 + i, v) for i, v in enumerate(odd * 2)] + [(5, "MNR5.XML")] * 3
    rows = [(i, v, rng.choice(["a", "b c/d", None])) for i, v in rows]
    path = f"{tmp_path_factory.mktemp('with blank and %')}/t"
    df = spark.createDataFrame(rows, "id long, name string, part string")
    df.repartitionByRange(6, "name").write.partitionBy("part").parquet(path)
    return path


def both(spark, path, query, upper=True):
    want = search_contains(spark.read.parquet(path), "name", query, upper)
    return [sorted(map(str, x.collect())) for x in (si.search(spark, path, "name", query, upper), want)]


def test_equal_rows_with_and_without_index(spark, table):
    for query in ["mnr1", None]:  # no index yet
        got, want = both(spark, table, query)
        assert got == want
    assert si.index_files(spark, table, "name") == len(si.files_of(spark, table)) > 6
    assert si.index_files(spark, table, "name") == 0
    for query in QUERIES:
        for upper in (True, False):
            got, want = both(spark, table, query, upper)
            assert got == want, query
    assert both(spark, table, None)[0] == []
    # files that came later are opened, indexed or not
    more = spark.createDataFrame([(7000, "LATER MNR1", "a"), (7001, None, "b c/d")], "id long, name string, part string")
    more.coalesce(1).write.partitionBy("part").mode("append").parquet(table)
    for late in (0, 2):
        for query in ("later", "mnr1", "zzz"):
            got, want = both(spark, table, query)
            assert got == want
        assert si.index_files(spark, table, "name") == (0 if late else 2)


def test_files_without_the_grams_are_not_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 20).select("id", F.concat(F.lit("F"), F.lpad("id", 4, "0")).alias("name")).write.parquet(path)
    assert si.index_files(spark, path, "name") == 20
    assert len(si.files_for(spark, path, "name", like_pattern("f0123"))) == 1
    assert len(si.files_for(spark, path, "name", like_pattern("f012_"))) == 1
    assert len(si.files_for(spark, path, "name", like_pattern("f%9"))) == 20
    assert si.files_for(spark, path, "name", like_pattern("nowhere")) == []
    assert len(si.search(spark, path, "name", "f0123").inputFiles()) == 1
    assert si.search(spark, path, "name", "nowhere").collect() == []


def test_a_stopped_index_run_leaves_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(5).selectExpr("id", "'abcdef' name").write.parquet(path)

    def stopped(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(si, "publish", stopped)
        with pytest.raises(RuntimeError):
            si.index_files(spark, path, "name")
    assert si.search(spark, path, "name", "cde", upper=False).count() == 5
    assert si.index_files(spark, path, "name") > 0
    assert si.search(spark, path, "name", "cde", upper=False).count() == 5


def test_grams(spark):
    rows = [(None,), ("",), ("ab",), ("abc",), ("ababab",), ("é漢😀x",)]
    got = [r.g for r in spark.createDataFrame(rows, "t string").select(si.grams("t").alias("g")).collect()]
    assert [sorted(g or []) for g in got] == [[], [], [], ["abc"], ["aba", "bab"], ["é漢😀", "漢😀x"]]
    assert si.literal_runs(r"%a\_b_c\\%d%") == ["a_b", "c\\", "d"]


def groups_read(path, columns, low, high):
    """Row groups whose statistics allow a row in all ranges, and all row groups."""
    read = total = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            total += 1
            stats = [meta.row_group(g).column(names.index(c)).statistics for c in columns]
            read += all(s.min <= h and s.max >= lo for s, lo, h in zip(stats, low, high, strict=True))
    return read, total


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_row_groups_of_two_ranges(spark, tmp_path, kind):
    start = datetime(2024, 1, 1)
    df = spark.range(20_000).selectExpr(
        "id", f"cast(timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, pmod(hash(id), 500000)) as {kind}) at", "concat('s', lpad(pmod(hash(id, 1), 50), 2, 0)) source"
    )
    plain, laid = str(tmp_path / "plain"), str(tmp_path / "laid")
    df.repartitionByRange(32, "at").write.parquet(plain)
    write_clustered(df, laid, ["at", "source"], 32)
    assert sorted(spark.read.parquet(laid).collect()) == sorted(df.collect())
    read, total = groups_read(laid, ["source"], ["s10"], ["s12"])
    assert total >= 16 and read <= total * 0.4
    if kind == "timestamp_ntz":
        assert groups_read(plain, ["source"], ["s10"], ["s12"])[0] == 32  # sorting by time alone prunes no source
        day = [start + timedelta(minutes=1000)], [start + timedelta(minutes=2000)]
        assert groups_read(laid, ["at"], *day)[0] <= total * 0.5
        day = [day[0][0], "s10"], [day[1][0], "s12"]
        assert groups_read(laid, ["at", "source"], *day)[0] <= total * 0.2
    found = spark.read.parquet(laid).filter("source between 's10' and 's12'")
    assert found.count() == df.filter("source between 's10' and 's12'").count()


def test_clustered_odd_rows(spark, tmp_path):
    """Nulls, one hot value, repeated rows, clashing names and an empty table."""
    rows = [(None, None, 1)] * 5 + [("x", 1.5, 2)] * 3000 + [(f"v{i}", float("nan") if i % 3 else -float(i), i) for i in range(300)]
    df = spark.createDataFrame(rows, "_place string, n0 double, `_n0.x` long").repartition(4)
    path = str(tmp_path / "t")
    write_clustered(df, path, ["_place", "n0"], 8)
    got = spark.read.parquet(path)
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert max(sizes) < 1000  # the hot value lies in several files
    empty = str(tmp_path / "empty")
    write_clustered(df.limit(0), empty, ["_place"])
    assert spark.read.schema(df.schema).parquet(empty).count() == 0
    assert bounds(df.limit(0), ["n0"]) == {"n0": []}
    with pytest.raises(ValueError):
        write_clustered(df, path, [])


# ---- buckets -------------------------------------------------------------


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffles(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def test_children_of_a_shipment_are_not_shuffled(spark, tmp_path, no_broadcast):
    t = StandIns(spark, "/root/testdata/sf0.001", MANIFEST)
    kept = store(t, man.CHILDREN, "kept_", 4, str(tmp_path))
    plain, bucketed = (man.shipment_details(x) for x in (t, kept))
    before, after = shuffles(plain), shuffles(bucketed)
    # what is left: the pairs of master and shipment, and two lookups of addresses and names
    assert sum("(shipment_id#" in x for x in after) <= 4 < 10 <= sum("(shipment_id#" in x for x in before)
    again = man.shipment_details(stored(spark, t, man.CHILDREN, "kept_"))
    want = sorted(map(str, plain.collect()))
    assert want and sorted(map(str, bucketed.collect())) == want == sorted(map(str, again.collect()))
    for name in man.CHILDREN:
        assert kept[name].count() == t[name].count()
        assert len(glob.glob(f"{tmp_path}/{name}/*.parquet")) <= 4
        spark.sql(f"drop table kept_{name}")


def test_odd_keys_in_buckets(spark, tmp_path):
    rows = [(None, "a"), (None, "b"), (5, "c"), (5, None), (-7, "d")] + [(1, "hot")] * 50
    df = spark.createDataFrame(rows, "k long, v string")
    got = write_bucketed(df, "odd_keys", "k", 4, f"{tmp_path}/odd")
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="already exists"):
        write_bucketed(df, "odd_keys", "k", 4, f"{tmp_path}/other")
    with pytest.raises(ValueError):
        write_bucketed(df, "no_buckets", "k", 0, f"{tmp_path}/none")
    nothing = write_bucketed(df.limit(0), "no_rows", "k", 2, f"{tmp_path}/no_rows")
    assert nothing.join(got, "k").count() == 0 and got.join(got, "k").count() == 2505
    for name in ("odd_keys", "no_rows"):
        spark.sql(f"drop table {name}")
