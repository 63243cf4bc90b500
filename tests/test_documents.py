"""Golden documents with invented parties."""

import csv
import io
import xml.etree.ElementTree as ET
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cargolens.plans import documents as docs
from cargolens.plans import manifest as man
from cargolens.sources import inbox
from cargolens.sources.commits import committed, content_of, publish, reserve_ids
from cargolens.sources.inbox import render, to_outbox

NOW = datetime(2025, 3, 27, 7, 3, 0)
ADDRESSES = "QK AAAXX00EXAMPLE\n.AAAXX01EXAMPLE/SIN01 090516"
AROUND = docs.Interchange("ICS*+ANSI1.1  SENDER           RECEIVER         2503270703000000001", "ICE*000001*000000001")


def table(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


@pytest.fixture(scope="module")
def shared(spark):
    return {
        "ports": table(spark, "id long, code string, name string, country_code string", (1, "AAA", "Alpha", "AA"), (2, "BBB", "Beta", "BB")),
        "countries": table(spark, "id long, code string, name string", (1, "AA", "ALAND"), (2, "BB", "BLAND")),
        "party_addresses": table(
            spark,
            "id long, building_no string, street_name string, city_name string, po_box string, state_name string, country_id long",
            (10, "1", "Main", "Town", None, "North", 1),
            (11, "2", None, "Ville", "99", None, 2),
            (12, "3", "Lost", "Nowhere", "1", "X", 77),
        ),
    }


def test_air_house_list(spark, shared):
    t = {
        **shared,
        "air_shipments": table(
            spark,
            "id long, master_id string, no_of_pieces int, gross_weight_kgs decimal(9,2), hbl_or_hawb_no string, origin_id long, "
            "destination_id long, shipper_name string, consignee_name string",
            (1, "12345678901", 4, Decimal("10.50"), "H1", 1, 9, "SENDER", "TAKER"),
            (2, "12345678901", 4, Decimal("10.50"), "H2", 1, 2, "SENDER", "TAKER"),
            (3, "12345678901", 4, Decimal("10.50"), "H3", 1, 2, None, "TAKER"),
        ),
        "shipment_cargo": table(
            spark, "id long, shipment_header_id long, commodity_description string", (2, 1, "second"), (1, 1, "first")
        ),
        "shipment_parties": table(
            spark, "shipment_header_id long, shipper_address_id long, consignee_address_id long", (1, 10, 11), (2, 10, 12), (3, 10, 11)
        ),
    }
    wanted = table(spark, "id long", (1,), (2,), (3,), (4,))
    got = {r.doc_key: r.content for r in docs.air_house_list(t, ADDRESSES, wanted).collect()}
    head = ADDRESSES + "\nFHL/4\n"
    assert got[1] == head + (
        "MBI/123-45678901/T4K10.50\nHBS/H1/AAA/4/K10.50//first\nSHP/SENDER\n/1 Main Town \n/North\n/AA\n"
        "CNE/TAKER\n/2  Ville 99\n/\n/BB\n"
    )
    assert got[2] is None  # address whose country is unknown
    assert got[3] is None  # no shipper name
    assert got[4] == head + "NO DATA FOUND FOR SHIPMENT 4"
    assert set(r.doc_key for r in docs.air_house_list(t, ADDRESSES).collect()) == {1, 2, 3}


@pytest.fixture(scope="module")
def tables_530(spark):
    return {
        "finance_documents": table(
            spark,
            "did long, company_code string, branch_code string, location_code string, daybook_code string, document_no string, job_uid long, subjob_uid long",
            (1, "C", "B", "L", "DB", "100", 1, 1), (2, "C", "B", "L", "DB", "101", 2, None), (3, "C", "X", "L", "DB", "102", 1, 1),
        ),
        "partners_530": table(
            spark,
            "company_code string, branch_code string, location_code string, sender_code string, receiver_code string, "
            "route_code_origin string, route_code_destination string, sftp_type string",
            ("C", "B", "L", "SND", "RCV", "SPEC", None, "IN"),
        ),
        "jobs": table(spark, "job_uid long, master_no string, pol string, pod string, no_of_pack int", (1, "M1", "P1", "P2", 7), (2, None, "P9", None, None)),
        "subjobs": table(spark, "subjob_uid long, pickup_date timestamp_ntz", (1, datetime(2025, 3, 11, 6, 59))),
        "codes": table(
            spark, "document string, master string, code string, edi_code string",
            ("EDI_530", "PORT_MASTER", "P1", "111"), ("EDI_530", "PORT_MASTER", "P2", "222"), ("OTHER", "PORT_MASTER", "P9", "333"),
        ),
    }


def test_message_530(tables_530):
    out, rejects = docs.message_530(tables_530, NOW, AROUND, first_number=41)
    got = {r.doc_key: r.content.split("\n") for r in out.collect()}
    assert got[1] == [
        "ICS*+ANSI1.1  SENDER           RECEIVER         2503270703000000001",
        "GS*VI*SND*RCV*250327*0703*41*T*1",
        "ST*530*000000001",
        "BV3*SND*111*BK*DB-100*7*250311*0659**M1***222",
        "VI**SPEC********",
        "SE*4*000000001",
        "GE*1*41",
        "ICE*000001*000000001",
    ]
    assert got[2][3] == "BV3*SND**BK*DB-101********"  # nothing after the document number is known
    assert [r.did for r in rejects.collect()] == [3]


def test_message_530_batched(tables_530):
    out, _ = docs.message_530_batched(tables_530, NOW, AROUND)
    rows = out.orderBy("pos").collect()
    assert {r.doc_key for r in rows} == {"SND/RCV"} and [r.pos for r in rows] == [0, 1, 2, 3]
    text = "\n".join(r.line for r in rows).split("\n")
    assert [s for s in text if s.startswith(("ST", "SE", "GE"))] == ["ST*530*0001", "SE*4*0001", "ST*530*0002", "SE*4*0002", "GE*2*1"]


def test_customs_xml(spark, shared):
    t = {
        **shared,
        "subjobs": table(
            spark,
            "subjob_uid long, company_code string, branch_code string, location_code string, pol string, pod string, house_no string, "
            "consignee_code string, consignee_manifest_name string, shipper_code string, shipper_manifest_name string, mark_no string, "
            "external_pack_code string, commodity_description string",
            (1, "C", "B", "L", "AAA", "BBB", "H1", "K1", "Tom & <Sons>", "K2", "Sender", None, "CT", "Fish"),
            (2, "Z", "B", "L", "AAA", "BBB", "H2", "K1", "x", "K2", "y", None, "CT", "Fish"),
            (3, "C", "B", "L", None, "BBB", "H3", "K9", "x", "K2", "y", None, "CT", "Fish"),
        ),
        "subjob_tree": table(spark, "subjob_uid long, job_uid long", (1, 100), (2, 100), (3, 100)),
        "jobs": table(spark, "job_uid long, master_no string, carrier_booking_no string", (100, "M1", "BK1")),
        "partners_customs": table(
            spark,
            "company_code string, branch_code string, location_code string, sender_code string, receiver_code string, document_type string, "
            "lrn string, member_country string, declarant_name string, declarant_id string, declarant_city string, declarant_country string, "
            "declarant_street string, declarant_postcode string, declarant_number string, declarant_email string, sftp_type string",
            ("C", "IN", "1", "SND", "RCV", "F15", "LRN", "DE", None, None, None, None, None, None, None, "d@example.com", "IN"),
        ),
        "subjob_containers": table(
            spark,
            "job_uid long, container_uid long, segment_code string, job_no string, subjob_uid long, external_no_of_pack int, "
            "gross_weight decimal(9,3), volume decimal(9,3)",
            (100, 1, "S", "J", 1, 5, Decimal("0.454"), Decimal("1.0")), (100, 2, "S", "J", 1, 6, Decimal("2072.92"), Decimal("1.0")),
        ),
        "job_containers": table(
            spark,
            "job_uid long, container_uid long, segment_code string, job_no string, container_code string, container_no string, actual_seal string",
            (100, 1, "S", "J", "20", "CN1", "S1"), (100, 2, "S", "J", "40", "CN2", None),
        ),
        "customer_addresses": table(
            spark,
            "customer_code string, address_type string, city string, country_code string, address string, zip_code string, mobile_no string",
            ("K1", "PRIMARY", "Town", "AA", "Street & 1", "Z1", "T1"), ("K2", "BILLING", "Wrong", "AA", "x", "y", "z"),
            ("K2", "PRIMARY", "Ville", "BB", "Road 2", "Z2", "T2"),
        ),
        "codes": table(spark, "document string, master string, code string, edi_code string", ("EDI_ICS2", "CONTAINER_MASTER", "20", "22G1")),
    }
    out, rejects = docs.customs_xml(t, NOW, "http://example.org/envelope", "urn:example:customs")
    got = {r.doc_key: r.content for r in out.collect()}
    assert set(got) == {1, 3}
    assert [r.subjob_uid for r in rejects.collect()] == [2]
    root = ET.fromstring(got[1].encode())
    house = root.find(".//ConsignmentHouseLevel")
    assert house.findtext("totalGrossMass") == "2073.374"
    assert house.findtext("Consignee/name") == "Tom & <Sons>"
    assert house.findtext("Consignee/Address/street") == "Street & 1"
    assert house.findtext("Consignor/Address/city") == "Ville"
    assert house.findtext("GoodsShipment/Buyer/identificationNumber") == "K1"
    assert house.findtext("GoodsShipment/Seller/Address/number") == "T2"
    items = house.findall("GoodsItem")
    assert [i.findtext("goodsItemNumber") for i in items] == ["1", "2"]
    assert [i.findtext("Weight/grossMass") for i in items] == [".454", "2072.920"]
    assert [i.findtext("TransportEquipment/containerSizeAndType") for i in items] == ["22G1", ""]
    assert [i.findtext("TransportEquipment/Seal/identifier") for i in items] == ["S1", ""]
    routing = [(r.findtext("sequenceNumber"), r.findtext("country")) for r in house.findall("CountriesOfRoutingOfConsignment")]
    assert routing == [("1", "AA"), ("2", "BB")]
    assert root.findtext(".//LRN") == "LRN-20250327-F15-001"
    assert root.findtext(".//documentIssueDate") == "2025-03-27T07:03:00.0000000Z"
    assert root.findtext(".//Declarant/Communication/identifier") == "d@example.com"
    bare = ET.fromstring(got[3].encode())
    assert bare.findall(".//GoodsItem") == [] and bare.findtext(".//totalGrossMass") == ""


# ---- sea manifest --------------------------------------------------------


def manifest_tables(spark, shared, **changes):
    cargo = (
        "id long, shipment_header_id long, commodity_description string, marks_and_numbers string, no_of_pieces int, pack_id long, "
        "chargeable_unit decimal(9,3), gross_weight_kgs decimal(12,3), hazardous string, imo_class string, un_number string, "
        "flash_point string, temperature_code string, storage_code string, refrigeration string, minimum_temperature string, maximum_temperature string"
    )
    danger = ("Yes", "Top class", "UN12345", "61.04", "Celsius", "Direct Delivery", "Yes", "-2", "8.25")
    calm = ("No", "none", None, None, None, None, None, None, None)
    t = {
        **shared,
        "config_headers": table(spark, "id long, config_key string", (1, "LINE_CODE"), (2, "AGENT_CODE")),
        "config_values": table(spark, "config_header_id long, config_value string", (1, "44L"), (2, "F7")),
        "masters": table(
            spark, "id long, master_uid string, eta date, service string, service_code string, destination_id long",
            (1, "MA", date(2025, 9, 29), "Sea (FCL/FCL)", "FCL CONTAINER", 1), (2, "MB", date(2025, 9, 19), "Sea", "LCL CONTAINER", 2),
            (3, "MC", date(2025, 9, 1), "Sea", "X", 2),
        ),
        "master_carriers": table(spark, "master_id long, vessel_name string, route_no string", (1, "SHIP ONE", "V1"), (2, "SHIP TWO", "V2"), (3, "SHIP", None)),
        "master_customs": table(spark, "master_id long, rotation_no string", (1, "941"), (2, None), (3, "9")),
        "instalments": table(spark, "master_uid string, rotation_no string, instalment_no long", ("MA", "941", 11)),
        "master_service_links": table(spark, "master_id long, shipment_service_id long", (1, 1), (1, 2), (1, 3), (2, 4), (1, 1)),
        "shipment_services": table(
            spark, "id long, shipment_header_id long, other_trade string, service_trade string",
            (1, 101, "Transit", "Import"), (2, 102, "ReExport", "Import"), (3, 103, None, "Export"), (4, 104, None, "Import"),
        ),
        "shipments": table(
            spark, "id long, origin_id long, destination_id long, service_type string",
            (101, 2, 1, "FCL"), (102, 2, 1, "FCL"), (103, 2, 1, "LCL"), (104, 1, 2, "LCL"),
        ),
        "air_documents": table(spark, "source_id long, document_no string", (101, "AIR1")),
        "ocean_documents": table(spark, "source_id long, document_no string", (101, "OCE1"), (102, "OCE2"), (104, "OCE4")),
        "shipment_extras": table(spark, "shipment_header_id long, transport_document_no string", (103, "ADD3")),
        "shipment_parties": table(
            spark,
            "shipment_header_id long, shipper_name string, consignee_name string, shipper_address_id long, consignee_address_id long, "
            "notify_customer_1_id long, notify_customer_1_address_id long, notify_customer_2_id long, notify_customer_2_address_id long",
            (101, "SENDER", "TAKER", 10, 11, 5, 10, None, None), (102, "SENDER", "TAKER", 10, 11, None, None, None, None),
        ),
        "customers": table(spark, "id long, name string", (5, "NOTIFY CO")),
        "packs": table(spark, "id long, code string, name string", (1, "CTN", "CARTON(S)")),
        "services": table(spark, "code string, transport_mode string", ("FCL", "Ocean"), ("LCL", "Road")),
        "shipment_cargo": table(
            spark, cargo,
            (1, 101, "SHOES \n IN  BOX", "1 TO 17", 735, 1, Decimal("50"), Decimal("19678.14"), *danger),
            (2, 102, "HATS", 'SAY "HI"', 20, 1, None, Decimal("100"), *calm),
            (3, 103, "GLOVES", None, 4, None, Decimal("18.602"), Decimal("1836.4"), *calm),
            (4, 104, "COATS", "N/M", None, 1, Decimal("3"), Decimal("9"), *calm),
        ),
        "shipment_containers": table(
            spark,
            "id long, shipment_id long, master_container_id long, container_sl_no string, external_no_of_piece int, gross_weight_kgs decimal(12,2), volume_in_cbm decimal(9,3)",
            (1, 101, 51, "ABCU1234567", 700, Decimal("8304.50"), Decimal("50")), (2, 101, 52, "ABCU7654322", 35, Decimal("11373.64"), Decimal("1.5")),
            (3, 103, 53, "LCLU0000009", None, Decimal("1836.40"), Decimal("18.602")),
        ),
        "master_containers": table(
            spark, "id long, master_id long, container_id long, actual_seal_number string",
            (51, 1, 61, "SEAL1"), (52, 1, 62, None), (53, 1, 61, "SEAL3"),
        ),
        "container_types": table(spark, "id long, teu string, empty_tare_weight string", (61, "2", " 3750 "), (62, "2", " ")),
    }
    return {**t, **changes}


def fields(line):
    tag, _, rest = line.partition(",")
    return [tag, *next(csv.reader(io.StringIO(rest.replace('"HI"', "'HI'"))))]


@pytest.fixture(scope="module")
def lines(spark, shared):
    t = manifest_tables(spark, shared)
    out = {mode: {r.doc_key: r.content for r in man.manifest(t, carry=mode).collect()} for mode in ("clean", "reference")}
    return t, out


def test_manifest_layout(lines):
    _, out = lines
    text = out["clean"]["MA"].split("\n")
    assert [x.split(",")[0] for x in text] == ["VOY", "BOL", "CON", "CTR", "CON", "CTR", "BOL", "BOL", "CON", "CTR", "END"]
    counts = {x.split(",")[0]: len(fields(x)) - 1 for x in text}
    assert counts == {"VOY": 10, "BOL": 60, "CON": 21, "CTR": 4, "END": 3}
    assert text[0] == 'VOY,"44L","F7","SHIP ONE","V1","AAA","29-Sep-2025","941","MFI","11","00001"'
    assert text[-1] == 'END,"2","1","Version No: 1, Product Sr. No: EDI/1.0"'
    assert out["clean"]["MB"].split("\n")[0] == 'VOY,"44L","F7","SHIP TWO","V2","BBB","19-Sep-2025","","MFI","1","00002"'
    assert out["clean"]["MC"] is None  # no voyage number


def test_manifest_bol(lines):
    _, out = lines
    bol = [fields(x) for x in out["clean"]["MA"].split("\n") if x.startswith("BOL")]
    first, second, third = bol
    assert first[1:8] == ["AIR1", "44L", "F7", "BBB", "BBB", "AAA", "AAA"]
    assert first[10:12] == ["T", "S"] and first[29] == "T9999"
    assert first[14:19] == ["F", "N", "", "FCL/FCL", "BB"]
    assert first[26:29] == ["SENDER", "1,Main,Town,North,ALAND,", "AA"]
    assert first[30:32] == ["TAKER", "2,,Ville,,BLAND,99"]
    assert first[33:35] == ["NOTIFY CO", "1,Main,Town,North,ALAND,"]
    assert first[41:47] == ["1 TO 17", "770000", "SHOES IN BOX", "735", "CARTON(S)", "CTN"]
    assert first[47:58] == ["", "", "2", "4", "3.8", "19678.140", "19678.140", "50.000", "735", "", "735"]
    assert second[1] == "OCE2" and second[10:12] == ["I", ""] and second[29] == "D9999"
    assert second[49:52] == ["0", "", ""]
    assert third[1] == "ADD3" and third[15] == "Y"
    assert third[47:52] == ["LCLU0000009", "9", "", "", ""] and third[56] == "1.836"


def test_manifest_containers(lines):
    _, out = lines
    text = out["clean"]["MA"].split("\n")
    assert fields(text[2])[1:] == [
        "1", "1 TO 17", "SHOES IN BOX", "", "770000", "35", "CARTON(S)", "CTN", "35", "11374", "1.500", "Y", "Top", "UN123", "61.0",
        "C", "D", "Y", "-2.0", "8.3", "C",
    ]
    assert text[3] == 'CTR,"ABCU765432","2","0.0",""'
    assert fields(text[4])[10] == "8305" and text[5] == 'CTR,"ABCU123456","7","3750.0","SEAL1"'
    assert 'SAY "HI"' in text[6]  # quotes stay as they are
    assert fields(text[8])[12:] == ["N", "", "", "", "", "", "", "", "", ""]


def test_manifest_carried_values(lines):
    _, out = lines
    text = out["reference"]["MA"].split("\n")
    bol = [fields(x) for x in text if x.startswith("BOL")]
    assert [b[11] for b in bol] == ["S", "S", "S"]  # transport mode of the first shipment
    assert [b[47] for b in bol] == ["", "", "LCLU0000009"]
    assert [b[49] for b in bol] == ["2", "0", "0"]  # container count of the last full-container shipment
    last = fields([x for x in text if x.startswith("CON")][-1])
    assert last[12:] == ["N", "Top", "UN123", "61.0", "C", "D", "Y", "-2.0", "8.3", "C"]


def test_manifest_null_and_single_shipment(spark, shared, lines):
    t, _ = lines
    one = {r.doc_key: r.content for r in man.manifest(t, shipment_id=102).collect()}
    assert [x.split(",")[0] for x in one["MA"].split("\n")] == ["VOY", "BOL", "END"]
    gone = manifest_tables(spark, shared, ocean_documents=table(spark, "source_id long, document_no string", (104, "OCE4")))
    got = {r.doc_key: r.content for r in man.manifest(gone).collect()}
    assert got["MA"] is None and got["MB"] is not None
    blank = {r.doc_key: r.content for r in man.manifest(gone, null_mode="blank").collect()}
    assert "" in blank["MA"].split("\n")
    assert set(one) == {"MA"}
    # masters that share their uid stay apart
    twins = {**t, "masters": t["masters"].withColumn("master_uid", F.lit("M"))}
    ends = [sum(x.startswith('"END"') or x.startswith("END") for x in r.content.split("\n")) for r in man.manifest(twins, null_mode="blank").collect()]
    assert ends == [1] * t["masters"].count()


def test_second_cargo_row_repeats_containers(spark, shared):
    t = manifest_tables(spark, shared)
    cargo = t["shipment_cargo"]
    same = cargo.filter("id = 1").withColumn("id", F.lit(8).cast("long"))
    other = cargo.filter("id = 1").withColumn("id", F.lit(9).cast("long")).withColumn("marks_and_numbers", F.lit("18 TO 20"))
    t["shipment_cargo"] = cargo.unionByName(same).unionByName(other)
    text = {r.doc_key: r.content for r in man.manifest(t).collect()}["MA"].split("\n")
    con = [(fields(x)[1], fields(x)[2], fields(y)[3]) for x, y in zip(text, text[1:]) if x.startswith("CON")][:4]
    assert con == [("1", "1 TO 17", "0.0"), ("2", "18 TO 20", "0.0"), ("3", "1 TO 17", "7500.0"), ("4", "18 TO 20", "3750.0")]


def test_counters_after_sending(lines):
    t, _ = lines
    got = sorted((r.master_uid, r.rotation_no or "", r.instalment_no) for r in man.manifest_counters(t).collect())
    assert got == [("MA", "941", 12), ("MB", "", 1), ("MC", "9", 1)]


def test_outbox_and_preview(spark, tmp_path):
    rendered = table(spark, "doc_key long, content string, branch_code string", (7, "seven", "B"), (8, "eight", None))
    prior = table(spark, "file_uid long", (41,), (12,))
    assert render(rendered, None, prior, NOW, "EDI_") is rendered
    assert render(rendered, "Y", prior, NOW, "EDI_") is rendered
    out = str(tmp_path / "outbox")
    render(rendered, "N", prior, NOW, "EDI_", out)
    rows = spark.read.parquet(out).orderBy("file_uid").collect()
    assert [(r.file_uid, r.file_name, bytes(r.file_content), r.status, r.attempt) for r in rows] == [
        (42, "EDI_7.txt", b"seven", "NEW", 0), (43, "EDI_8.txt", b"eight", "NEW", 0),
    ]
    assert [(r.company_code, r.branch_code, r.location_code) for r in rows] == [(None, "B", None), (None, None, None)]
    empty = to_outbox(rendered, prior.filter("false"), NOW, "X")
    assert sorted(r.file_uid for r in empty.collect()) == [1, 2]


def test_writers_take_disjoint_ids(spark, tmp_path):
    """Eight writers at once from one counter."""
    folder = str(tmp_path / "ids")
    with ThreadPoolExecutor(8) as pool:
        starts = list(pool.map(lambda n: (reserve_ids(spark, folder, n, 100), n), [3, 1, 4, 1, 5, 9, 2, 6]))
    taken = sorted(i for start, n in starts for i in range(start, start + n))
    assert taken == list(range(100, 131))
    assert not publish(spark, folder, 100, {"next": 0}) and content_of(spark, folder, 100)["next"] > 100


def test_batches_of_the_outbox(spark, tmp_path, monkeypatch):
    out = str(tmp_path)

    def docs(*keys):
        return spark.createDataFrame([(k, f"text {k}") for k in keys], "doc_key long, content string")

    first = inbox.queue_batch(docs(3, 1, 2), 0, out, NOW, "EDI_", first=10)
    assert [(r.file_uid, r.file_name) for r in first.orderBy("file_uid").collect()] == [(10, "EDI_1.txt"), (11, "EDI_2.txt"), (12, "EDI_3.txt")]

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(inbox, "commit_batch", stop)
        with pytest.raises(RuntimeError):
            inbox.queue_batch(docs(4), 1, out, NOW, "EDI_")
    assert committed(spark, out, "outbox").count() == 3
    assert [r.file_uid for r in inbox.queue_batch(docs(4), 1, out, NOW, "EDI_").collect()] == [14]
    assert [r.file_uid for r in inbox.queue_batch(docs(5), 1, out, NOW, "EDI_").collect()] == [14]
    assert inbox.queue_batch(docs(), 2, out, NOW, "EDI_").collect() == []
    assert committed(spark, out, "outbox").count() == 4
