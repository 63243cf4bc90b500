"""Manifest shredding: aligned, lockstep, malformed, typed; and the stream."""

from datetime import datetime
from decimal import Decimal

import pytest

from cargolens.operators import xml_shred as xs
from cargolens.sources.commits import committed
from cargolens.streaming import shred as shred_module
from cargolens.streaming.shred import shred_batch, shred_stream

NOW = datetime(2025, 1, 2, 3, 4, 5)

CONTAINERS = """<Containers>
<Container><ContianerNumber>C1</ContianerNumber><ManifestNo>F1</ManifestNo><PieceCount>5</PieceCount><ReeferIndicator>on</ReeferIndicator></Container>
<Container><ContianerNumber>C2</ContianerNumber><PieceCount></PieceCount><WeightKg>1.5</WeightKg><ReeferIndicator>0</ReeferIndicator></Container>
<Container><ContianerNumber>C3</ContianerNumber><ManifestNo>F3</ManifestNo><PieceCount>many</PieceCount></Container>
</Containers>"""
HOUSES = """<Houses>
<House><HBLNumber>H1</HBLNumber><ShipperInfo>Bolt &amp; Nut &lt;Co&gt;</ShipperInfo></House>
<House><HBLNumber>H2</HBLNumber><HouseContainers>
<HouseContainer><MasterContianerNumber>C1</MasterContianerNumber><Package>2</Package></HouseContainer>
<HouseContainer><MasterContianerNumber>C3</MasterContianerNumber></HouseContainer></HouseContainers></House>
</Houses>"""
PARTIES = """<ShippingParties><ShippingParty><PartyName>P</PartyName><PartyAddress><City>X</City></PartyAddress>
<ContactPerson><Mail>a@example.com</Mail></ContactPerson></ShippingParty></ShippingParties>"""
HEADER = "<Header><MessageID>M1</MessageID><SendDateTime>2025-01-01T10:00:00</SendDateTime></Header>"
FULL = f"<Manifest>{HEADER}<Master><MBLNumber>B1</MBLNumber><MBLWeightKg>12.3456</MBLWeightKg><SeawayBLIndicator>Y</SeawayBLIndicator>" \
       f"<Routing><ETD>2025-02-01</ETD></Routing>{CONTAINERS}{HOUSES}</Master>{PARTIES}</Manifest>"
PREFIXED = '<S:Manifest xmlns:S="urn:x"><S:Header><S:MessageID>M2</S:MessageID></S:Header></S:Manifest>'
EMPTY = "<Manifest><Header><MessageID>M3</MessageID></Header><Master></Master></Manifest>"
BROKEN = "<Manifest><Header><MessageID>M4</Header>"


@pytest.fixture(scope="module")
def messages(spark):
    rows = [(1, FULL), (2, PREFIXED), (3, EMPTY), (4, BROKEN), (5, None)]
    return spark.createDataFrame(rows, "id long, xml_data string")


@pytest.fixture(scope="module")
def good(messages):
    return xs.split_malformed(xs.parse_messages(messages))[0]


def test_quarantine(messages):
    good, bad = xs.split_malformed(xs.parse_messages(messages))
    assert sorted(r.id for r in good.collect()) == [1, 2, 3]
    assert [r.id for r in bad.collect()] == [4]


def test_sections_at_another_depth_are_not_lost(spark):
    wrapped = f"<Envelope><Body>{EMPTY}</Body></Envelope>"
    rows = spark.createDataFrame([(1, wrapped), (2, "<Other><x>1</x></Other>")], "id long, xml_data string")
    good, bad = xs.split_malformed(xs.parse_messages(rows))
    assert [r.id for r in bad.collect()] == [1]
    assert [r.id for r in good.collect()] == [2]
    ids = xs.shred_scalar(good, {"message_id": ("Header/MessageID", "string")})
    assert [r.message_id for r in ids.collect()] == [None]


def test_headers_and_master(good):
    tables = xs.shred(good, NOW)
    headers = {r.message_id: r for r in tables["manifest_headers"].collect()}
    assert set(headers) == {"M1", "M2", "M3"}
    assert headers["M1"].send_datetime == datetime(2025, 1, 1, 10)
    assert headers["M1"].processed_at == NOW and headers["M1"].version is None
    master = {r.message_id: r for r in tables["master_shipments"].collect()}["M1"]
    assert (master.mbl_number, master.mbl_weight_kg, master.seaway_bl_indicator) == ("B1", Decimal("12.346"), True)
    assert {r.message_id: r.etd for r in tables["routing_info"].collect()}["M1"] == datetime(2025, 2, 1)


def test_elements_stay_aligned(good):
    tables = xs.shred(good, NOW)
    boxes = {r.container_number: r for r in tables["containers"].collect()}
    assert {k: r.manifest_no for k, r in boxes.items()} == {"C1": "F1", "C2": None, "C3": "F3"}
    assert {k: r.piece_count for k, r in boxes.items()} == {"C1": 5, "C2": None, "C3": None}
    assert {k: r.reefer_indicator for k, r in boxes.items()} == {"C1": True, "C2": False, "C3": None}
    inner = sorted((r.hbl_number, r.master_container_number, r.package) for r in tables["house_containers"].collect())
    assert inner == [("H2", "C1", 2), ("H2", "C3", None)]
    houses = {r.hbl_number: r.shipper_info for r in tables["house_bills"].collect()}
    assert houses == {"H1": "Bolt & Nut <Co>", "H2": None}
    [party] = tables["shipping_parties"].collect()
    assert (party.message_id, party.party_name, party.city, party.mail) == ("M1", "P", "X", "a@example.com")


def test_table_columns(good):
    widths = {n: len(df.columns) for n, df in xs.shred(good, NOW).items()}
    assert widths == {
        "manifest_headers": 10, "master_shipments": 20, "routing_info": 15, "containers": 12, "house_bills": 31,
        "house_containers": 8, "shipping_parties": 16,
    }


def test_rejected_values(good):
    got = [(r.message_id, r.table, r.column, r.value) for r in xs.cast_rejects(good).collect()]
    assert got == [("M1", "containers", "piece_count", "many")]


def test_lockstep_moves_later_values_up(messages):
    # the malformed message among them stops nothing
    rows, _ = xs.split_malformed(xs.parse_messages(messages))
    boxes = {r.container_number: r.manifest_no for r in xs.shred_lockstep(rows, "containers", NOW).collect()}
    assert boxes == {"C1": "F1", "C2": "F3", "C3": None}
    pairs = [(r.hbl_number, r.master_container_number) for r in xs.shred_lockstep(rows, "house_containers", NOW).collect()]
    assert sorted(pairs) == [("H1", "C1"), ("H2", "C3")]


def test_parties_under_master_and_house(spark):
    inner = PARTIES.replace(">P<", ">Q<")
    text = f"<M>{HEADER}<Master>{PARTIES}<Houses><House><HBLNumber>H</HBLNumber>{inner}</House></Houses></Master></M>"
    good, _ = xs.split_malformed(xs.parse_messages(spark.createDataFrame([(text,)], "xml_data string")))
    assert sorted(r.party_name for r in xs.shred_table(good, "shipping_parties", NOW).collect()) == ["P", "Q"]


def numbers(*ids):
    return "".join(f"<Container><ContianerNumber>{i}</ContianerNumber></Container>" for i in ids)


def test_repeated_sections_are_all_taken(spark):
    text = (
        "<M><Header><MessageID>A</MessageID><MessageID>B</MessageID></Header>"
        f"<Master><MBLNumber/><Containers>{numbers(1)}</Containers><Containers>{numbers(2)}</Containers></Master>"
        f"<Master><MBLNumber>L</MBLNumber><Containers>{numbers(3, 4)}</Containers><Houses><House><HBLNumber>H</HBLNumber>"
        f"</House></Houses><Houses><House><HBLNumber>I</HBLNumber></House></Houses></Master>{PARTIES}{PARTIES}</M>"
    )
    rows = spark.createDataFrame([(1, text)], "id long, xml_data string")
    good, bad = xs.split_malformed(xs.parse_messages(rows))
    assert bad.count() == 0
    t = xs.shred(good, NOW)
    assert [(r.message_id, r.container_number) for r in t["containers"].collect()] == [("A", str(i)) for i in (1, 2, 3, 4)]
    assert [r.hbl_number for r in t["house_bills"].collect()] == ["H", "I"]
    assert [(r.message_id, r.mbl_number) for r in t["master_shipments"].collect()] == [("A", "L")]
    assert t["shipping_parties"].count() == 2 and t["manifest_headers"].count() == 1
    assert [r.container_number for r in xs.shred_lockstep(good, "containers", NOW).collect()] == ["1", "2", "3", "4"]


def test_messages_that_would_lose_a_section_are_quarantined(spark):
    texts = {
        1: f"<M>{HEADER}<Body><Master><Containers>{numbers(1)}</Containers></Master></Body></M>",
        2: f"<M>{HEADER}<Master><Group><Containers>{numbers(1)}</Containers></Group></Master></M>",
        3: f"<M>{HEADER}<Other>{PARTIES}</Other></M>",
        4: f"<M>{HEADER}<Master><Containers>{numbers(1)}</Containers></Master></M>",
    }
    rows = spark.createDataFrame(list(texts.items()), "id long, xml_data string")
    good, bad = xs.split_malformed(xs.parse_messages(rows))
    assert sorted(r.id for r in bad.collect()) == [1, 2, 3] and [r.id for r in good.collect()] == [4]
    # only what is asked for counts
    good, _ = xs.split_malformed(xs.parse_messages(rows, tables=["shipping_parties"]))
    assert sorted(r.id for r in good.collect()) == [1, 2, 4]


def test_stream_takes_each_file_once(spark, messages, tmp_path):
    source, out, check = (str(tmp_path / d) for d in ("in", "out", "check"))
    from pyspark.sql import functions as F

    messages.withColumn("processed", F.col("id") == 5).coalesce(1).write.parquet(source)

    def run():
        shred_stream(spark, source, out, check, NOW).awaitTermination()
        return {t: spark.read.parquet(f"{out}/{t}").count() for t in ("manifest_headers", "containers", "quarantine", "processed")}

    first = run()
    assert first == {"manifest_headers": 3, "containers": 3, "quarantine": 1, "processed": 4}
    assert run() == first
    log = spark.read.parquet(f"{out}/processing_log").collect()
    assert [(r.records_processed, r.process_type) for r in log] == [(4, "ETI_MANIFEST")]
    more = spark.createDataFrame([(9, EMPTY, False)], "id long, xml_data string, processed boolean")
    more.coalesce(1).write.mode("append").parquet(source)
    assert run()["manifest_headers"] == 4
    assert spark.read.parquet(f"{out}/processing_log").count() == 2
    with pytest.raises(ValueError, match="another checkpoint"):
        shred_stream(spark, source, out, str(tmp_path / "check2"), NOW)


def test_a_stopped_batch_shows_in_no_table(spark, tmp_path, monkeypatch):
    """Stopped after the third table, then repeated."""
    out = str(tmp_path)
    batch = spark.createDataFrame([(1, FULL), (2, EMPTY)], "id long, xml_data string")
    shred_batch(batch, 0, out, NOW)
    more = spark.createDataFrame([(3, FULL), (4, BROKEN)], "id long, xml_data string")
    write = shred_module.write_tables

    def stopped(tables, base, batch_id):
        write(dict(list(tables.items())[:3]), base, batch_id)
        raise RuntimeError("lost")

    def counts():
        return {t: committed(spark, out, t).count() for t in (*xs.TABLES, "quarantine", "processed")}

    first = counts()
    with monkeypatch.context() as m:
        m.setattr(shred_module, "write_tables", stopped)
        with pytest.raises(RuntimeError):
            shred_batch(more, 1, out, NOW)
    assert counts() == first
    shred_batch(more, 1, out, NOW)
    assert counts()["manifest_headers"] == first["manifest_headers"] + 1
    assert counts()["quarantine"] == 1 and counts()["processed"] == 4
    done = counts()
    shred_batch(batch, 1, out, NOW)  # committed before: stays
    assert counts() == done
    assert committed(spark, out, "unknown", "a int").collect() == []


def test_tags_in_comments_and_cdata_open_nothing(spark):
    comment = FULL.replace("<Houses>", "<!-- <House> <Container/> --><Houses>")
    cdata = FULL.replace("<PartyName>P<", "<PartyName><![CDATA[<House> & <!-- <Container> ]]><")
    instruction = "<?xml version='1.0'?><?note <House> ?>" + FULL
    # a house outside the list is still found missing, also beside a comment that holds its end
    misplaced = comment.replace("</Houses>", "</Houses><House><HBLNumber>H9</HBLNumber></House><!-- </House> -->")
    rows = [(1, comment), (2, cdata), (3, instruction), (4, misplaced)]
    good, bad = xs.split_malformed(xs.parse_messages(spark.createDataFrame(rows, "id long, xml_data string")))
    assert sorted(r.id for r in good.collect()) == [1, 2, 3]
    assert [r.id for r in bad.collect()] == [4]
    assert xs.shred_table(good, "house_bills", NOW).count() == 6


def _tables(spark, path):
    spark.sql("""select id as o_orderkey, id * 3 as o_custkey, 'F' as o_orderstatus, 10.5d as o_totalprice,
        timestamp_ntz'2001-01-01 00:00:00' as o_orderdate from range(1, 41)""").write.parquet(f"{path}/orders.parquet")
    spark.sql("""select id % 40 + 1 as l_orderkey, id % 9 as l_partkey, id % 7 as l_suppkey, cast(id div 40 + 1 as int) as l_linenumber,
        12.25d as l_extendedprice, if(id % 3 = 0, 'A', 'N') as l_returnflag from range(120)""").write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_messages_are_neither_written_nor_shuffled(spark, tmp_path):
    from cargolens.catalog import tables as cat
    from cargolens.session import names_under, scratch_root
    from cargolens.standins import StandIns

    folder = f"{scratch_root(spark)}/cargolens"
    before = set(names_under(spark, folder))
    messages = cat.manifest_messages(StandIns(spark, _tables(spark, tmp_path)))
    assert set(names_under(spark, folder)) == before
    # texts are made above the last exchange
    plan = messages._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("<Manifest>") == 1 and "<HBLNumber>" in plan.split("Join")[0]
    good, bad = xs.split_malformed(xs.parse_messages(messages))
    assert (good.count(), bad.count()) == (40, 0)
    assert xs.shred_table(good, "containers", NOW).count() == 120


@pytest.mark.parametrize("name", ["xml_quarantine", "xml_nested_aligned"])
def test_both_sides_come_of_one_parse(spark, tmp_path, name):
    from cargolens.catalog import QUERIES

    df = QUERIES[name](spark, _tables(spark, tmp_path))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_xml") == 0
    assert df.count() == 40


def test_staged_messages_keep_the_text_of_malformed_ones_only(spark, monkeypatch):
    from cargolens.streaming import shred as stream

    seen = []
    monkeypatch.setattr(stream, "staged", lambda df, label: seen.append(df) or df)
    text = "<Manifest><Header><MessageID>M1</MessageID></Header></Manifest>"
    batch = spark.createDataFrame([(1, text), (2, text[:-4]), (3, None)], "id long, xml_data string")
    tables = stream.shredded(batch, NOW)
    assert {r.id: r.xml_data for r in seen[0].collect()} == {1: None, 2: text[:-4], 3: None}
    assert [(r.id, r.xml_data) for r in tables["quarantine"].collect()] == [(2, text[:-4])]


@pytest.mark.parametrize(
    "name",
    ["xml_house_bills", "xml_containers_lockstep", "xml_house_containers", "xml_master", "xml_routing", "xml_parties_lockstep",
     "xml_parties", "xml_header"],
)
def test_nothing_is_shuffled_after_the_parse(spark, tmp_path, name):
    """What moves is the columns of orders and lines, with bytes in proportion to them."""
    from cargolens.catalog import QUERIES
    from cargolens.catalog import tables as cat
    from cargolens.standins import StandIns

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    folder = _tables(spark, tmp_path)
    shown = plan(QUERIES[name](spark, folder))
    assert "from_xml" in shown.split("Exchange")[0]
    assert shown.count("Exchange") == plan(cat.manifest_messages(StandIns(spark, folder))).count("Exchange") > 0
    assert "<Manifest>" not in shown.partition("Exchange")[2]


def test_tags_that_show_one_value_are_one_list(spark):
    """The texts of an element, whose tags were put together one by one."""
    from pyspark.sql import functions as F

    from cargolens.catalog import tables as cat

    text = cat._element(xs.HOUSE, cat.VALUES["house_bills"])
    assert text.count("coalesce(") < len(xs.HOUSE) / 3
    spec = {"a": ("A", xs.TEXT), "b": ("B", xs.TEXT), "n": ("N", xs.INT), "c": ("G/C", xs.TEXT), "d": ("G/D", xs.TEXT)}
    values = {"a": "'a-' || k", "b": "'b<' || k", "n": "k % 3", "c": "'c-' || k", "d": "case when k > 1 then 'd' end"}
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    shown = [r.x for r in rows.select(F.expr(cat._element(spec, values)).alias("x")).collect()]
    assert shown == [
        "<A>a-1</A><B>b<1</B><N>1</N><G><C>c-1</C></G>",
        "<A>a-2</A><B>b<2</B><N>2</N><G><C>c-2</C><D>d</D></G>",
        "<G></G>",
    ]


def test_tags_are_searched_by_their_characters_first(spark):
    from pyspark.sql import functions as F

    texts = {
        "<House><House/></House>": 2,
        "<Houses><House a='1'></House><HouseContainer/><MyHouse></MyHouse></Houses>": 1,
        "<p:House></p:House><House>": 2,
        "<p:House></p:House><p:house></p:house>": 1,
        "<!-- <House> --><House\n>": 1,
        "<![CDATA[<House>]]>": 0,
        "<Header><house></house></Header>": 1,
        "<!-- <House> --><house></house>": 0,
    }
    rows = spark.createDataFrame([(t, n + more, more != 0) for t, n in texts.items() for more in (-1, 0, 1) if more < 1 or '<!' in t], "x string, kept int, lost boolean")
    found = rows.withColumn("got", xs._lost(F.col("x"), ["Header", "House"], F.col("kept")))
    assert found.filter("got is distinct from lost").collect() == []
    # only texts whose tags do not come to those parsed are searched at all places
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("House(?<=[<:]House)") < plan.index("THEN false") < plan.index("(?:Header|House)")
    assert rows.select(xs._lost(F.lit(None).cast("string"), ["House"], F.lit(0)).alias("v")).first().v is None


def test_staged_values_give_the_tables_of_the_messages(spark, messages, good):
    """Of a batch the values shown are staged, not lists of all values."""
    inner = PARTIES.replace(">P<", ">Q<")
    boxes = "<HouseContainers><HouseContainer><Package>x</Package></HouseContainer><HouseContainer/></HouseContainers>"
    house = f"<House><HBLNumber/>{boxes}{boxes}{inner}</House>"
    odd = f"<M>{HEADER}<Master/><Master><Houses>{house}</Houses><Houses/><Containers><Container/></Containers>{PARTIES}</Master>{PARTIES}</M>"
    rows = messages.unionByName(spark.createDataFrame([(6, odd), (7, "<M/>"), (8, "")], "id long, xml_data string"))
    parsed = xs.parse_messages(rows)
    sides = xs.split_malformed(parsed)
    shown = xs.values_shown(parsed, "id", "xml_data")
    assert "msg" not in shown.columns and shown.schema["master_shipments"].dataType["mbl_number"].dataType.typeName() == "string"
    for flag, side in zip(("good", "bad"), sides, strict=True):
        assert sorted(r.id for r in shown.filter(flag).collect()) == sorted(r.id for r in side.collect())
    want, got = xs.shred(sides[0], NOW), xs.shred(shown.filter("good"), NOW)
    want["rejects"], got["rejects"] = xs.cast_rejects(sides[0]), xs.cast_rejects(shown.filter("good"))
    for name, df in want.items():
        assert got[name].schema.simpleString() == df.schema.simpleString()
        assert sorted(map(repr, got[name].collect())) == sorted(map(repr, df.collect())), name
    assert want["house_containers"].count() == 6 and want["shipping_parties"].count() == 4
