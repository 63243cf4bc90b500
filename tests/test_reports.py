"""Reports on small tables: NULL rules, fan-out, optional parameters, large groups."""

import json
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cargolens.plans import reports


def table(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


def reply(df):
    """The document that ordered rows of text make."""
    order = [c for c in ("section", "pos") if c in df.columns]
    return "".join(r.text for r in df.orderBy(*order).collect())


# ---- finance -------------------------------------------------------------


def finance(spark, wip_rows):
    money = "decimal(12,2)"
    return {
        "shipments": table(
            spark,
            "id long, shipment_uid string, shipment_date timestamp_ntz, group_company_id long, company_id long, branch_id long",
            (1, "S1", datetime(2025, 1, 10, 23, 59), 1, 1, 1), (2, "S2", datetime(2025, 1, 11), 1, 1, 1),
            (3, "S3", datetime(2025, 1, 5), 1, 2, 1),
        ),
        "shipment_services": table(
            spark, "id long, shipment_header_id long, service_id long, service_type string",
            (1, 1, 7, "LCL"), (2, 1, 7, "LCL"), (3, 1, 8, "FCL"), (4, 3, 8, "FCL"),
        ),
        "shipment_rates": table(
            spark,
            f"id long, shipment_header_id long, sell_amount {money}, currency_rate_of_exchange {money}, cost_amount {money}, cost_roe {money}",
            (11, 1, D(100), D(2), D(50), D(1)), (12, 1, D(10), None, D(5), D(1)), (13, 3, None, D(1), D(5), D(2)),
        ),
        "vouchers": table(
            spark, f"id long, shipment_rate_id long, dr_cr string, local_amount {money}",
            (21, 11, "CR", D(150)), (22, 11, "DR", D(30)), (23, 11, "CR", D(80)), (24, 11, "DR", D(20)), (25, 12, "CR", D(4)), (26, 11, "DR", D(9)),
        ),
        "ledger_types": table(
            spark, "record_id long, rcn_type string, account_id long",
            (21, "C_REVENUE", 500), (22, "S_REVENUE", 500), (23, "C_REVENUE", 900), (24, "C_COST", 600), (25, "C_COST", 901), (26, "OTHER", 500),
        ),
        "wip_accounts": table(spark, "wip_revenue_account_id long, wip_cost_account_id long", *wip_rows),
    }


def money(df):
    cols = ["provisionRevenue", "provisionCost", "netGpPercentage", "pnlIncome", "pnlCost", "wipRevenue", "wipCost"]
    return {(r.shipmentId, r.service): tuple(None if r[c] is None else float(r[c]) for c in cols) for r in df.collect()}


def test_wip_multiplies_service_rows(spark):
    t = finance(spark, [(900, None), (None, 901)])
    got = money(reports.wip_finance(t, date(2025, 1, 31)))
    assert got[(1, "FCL")] == (200.0, 55.0, 72.5, 120.0, 20.0, 80.0, -4.0)
    assert got[(1, "LCL")] == (400.0, 110.0, 72.5, 240.0, 40.0, 160.0, -8.0)
    assert got[(2, None)] == (None, None, 0.0, 0.0, 0.0, 0.0, 0.0)
    assert got[(3, "FCL")] == (None, 10.0, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_wip_reply(spark):
    t = finance(spark, [(900, None), (None, 901)])
    rows = json.loads(reply(reports.wip_reply(t, date(2025, 1, 31))))
    assert [(r["shipmentId"], r["service"]) for r in rows] == [(1, "FCL"), (1, "LCL"), (2, None), (3, "FCL")]
    gone = {"status": "error", "message": "No shipment data found"}
    assert json.loads(reply(reports.wip_reply(t, date(1999, 1, 1)))) == gone
    assert json.loads(reports.failure_reply(ValueError('a "b"'))) == {"Status": "Failure", "Message": 'a "b"'}
    assert json.loads(reports.failure_reply(ValueError("x"), finance=True)) == {"status": "failure", "message": "x"}


def test_wip_null_guard(spark):
    t = finance(spark, [(900, None), (None, 901)])
    as_written = money(reports.wip_finance(t, date(2025, 1, 31), null_guard="reference"))
    # the NULL cost account makes NOT IN never true; 901 has no revenue account
    assert as_written[(1, "FCL")] == (200.0, 55.0, 72.5, 120.0, 0.0, 80.0, 0.0)
    full = money(reports.wip_finance(finance(spark, [(900, 901)]), date(2025, 1, 31), null_guard="reference"))
    assert full[(1, "FCL")] == (200.0, 55.0, 72.5, 120.0, 20.0, 80.0, -4.0)


def test_wip_filters(spark):
    t = finance(spark, [(900, 901)])

    def keys(*a, **k):
        return sorted(money(reports.wip_finance(t, *a, **k)), key=str)

    assert keys(date(2025, 1, 10)) == [(1, "FCL"), (1, "LCL"), (3, "FCL")]
    assert keys(date(2025, 1, 31), date(2025, 1, 11)) == [(2, None)]
    assert keys(date(2025, 1, 31), service_id=8) == [(1, "FCL"), (3, "FCL")]
    assert keys(date(2025, 1, 31), company_id=2) == [(3, "FCL")]
    assert keys(date(2025, 1, 31), shipment_id=2) == [(2, None)]
    assert keys(None) == []
    assert keys(date(2025, 1, 31), mode="Fully_Revenue_Booked") == [(1, "FCL"), (1, "LCL")]
    assert keys(date(2025, 1, 31), mode="Fully_Cost_Booked") == []
    assert keys(date(2025, 1, 31), mode="Partial_cost_Booked") == [(1, "FCL"), (1, "LCL"), (3, "FCL")]
    assert keys(date(2025, 1, 31), mode="anything") == []
    narrow = money(reports.wip_finance(t, date(2025, 1, 31), company_id=1))
    wide = money(reports.wip_finance(t, date(2025, 1, 31)))
    assert all(wide[k] == v for k, v in narrow.items())


# ---- daily status --------------------------------------------------------


def status_tables(spark, containers=3):
    names = sorted(set(reports.STATUS_FIELDS.values()) - {"id", "shipment_date"})
    dates = {"etd", "atd", "eta", "ata"}
    ddl = "id long, shipment_date date, customer_id long, " + ", ".join(f"{n} {'timestamp_ntz' if n in dates else 'string'}" for n in names)

    def ship(i, day, customer):
        row = [i, day, customer]
        for n in names:
            row.append(datetime(2025, 9, 5, 1) if n == "etd" else None if n in dates else f"S{i:03d}" if n == "shipment_uid" else n)
        return tuple(row)

    return {
        "shipment_list": table(spark, ddl, ship(1, date(2025, 1, 10), 5), ship(2, date(2025, 1, 9), 5), ship(3, date(2024, 1, 1), 5), ship(4, date(2025, 1, 10), 6)),
        "user_customers": table(spark, "registration_no long, customer_id long", (70, 5), (71, 5), (71, 6), (99, 6)),
        "users": table(spark, "id long", (70,), (71,), (72,)),
        "shipment_containers": table(spark, "shipment_id long, master_container_id long", *[(2, i) for i in range(containers)], (3, 0)),
        "master_containers": table(
            spark, "id long, container_id long, container_number string", *[(i, i % 2, f"C{i:04d}") for i in range(max(containers, 1))]
        ),
        "container_types": table(spark, "id long, code string", (0, "20GP"), (1, "40HC")),
        "user_preferences": table(spark, "web_user_master_id long, column_preferences string", (70, '["id"]')),
        "user_triggers": table(
            spark,
            "web_user_master_id long, mail_id array<string>, day_status boolean, days array<string>, status_list array<string>, last_trigger_date timestamp_ntz",
            (71, ["a@example.com"], True, ["MON"], [], None),
        ),
    }


def test_daily_status(spark):
    rows = reports.daily_status(status_tables(spark), 30, date(2025, 1, 20)).collect()
    assert sorted((r.login, r.id, r.shipmentid) for r in rows) == [(70, 1, 1), (70, 2, 2), (71, 1, 1), (71, 2, 2), (71, 3, 4)]
    two = [r for r in rows if r.login == 70 and r.shipmentid == 2][0]
    assert (two.noOfContainers, two.containerNumber) == ("2*20GP,1*40HC", "C0000,C0001,C0002")
    assert (two.estimatedDeparture, two.actualArrival, two.hsCode) == ("05-SEP-25", None, "")
    one = [r for r in rows if r.login == 70 and r.shipmentid == 1][0]
    assert (one.noOfContainers, one.containerNumber) == (None, None)
    only = reports.daily_status(status_tables(spark), 30, date(2025, 1, 20), login=70).collect()
    assert {r.login for r in only} == {70}
    assert len(rows[0]) == len(reports.STATUS_COLUMNS) + 1


def whole(rows, key):
    """Replies from their rows."""
    texts = {}
    for r in sorted(rows.collect(), key=lambda r: r.pos):
        texts.setdefault(r[key], []).append(r.text)
    return {k: json.loads("".join(t)) for k, t in texts.items()}


def test_daily_status_envelope(spark):
    t = status_tables(spark)
    got = whole(reports.daily_status_envelope(t, 30, date(2025, 1, 20)), "login")
    assert set(got) == {70, 71, 72}
    assert got[72] == {"Status": "Error", "Message": "Shipment List not available"}
    assert got[70]["userColumns"] == ["id"] and got[70]["userTrigger"] is None
    assert [d["shipment"] for d in got[71]["data"]] == ["S001", "S002", "S004"]
    assert got[71]["userTrigger"][0]["mailId"] == ["a@example.com"]
    assert list(got[70]["data"][0]) == reports.STATUS_COLUMNS
    plain = whole(reports.daily_status_envelope(t, 30, date(2025, 1, 20), preferences=False), "login")
    assert isinstance(plain[70], list) and plain[70] == got[70]["data"]


# ---- the smaller reports -------------------------------------------------


def test_inbound_monitor(spark):
    t = {
        "inbound_files": table(
            spark, "id long, source string, received_at timestamp_ntz, status string, file_name string",
            (1, "A", datetime(2025, 1, 2, 10), "Completed", "ONE.XML"), (2, "A", datetime(2025, 1, 1, 9), "Error", "TWO.XML"),
            (3, "B", datetime(2025, 1, 3), "pending", "ONE-B.XML"), (4, "A", datetime(2024, 1, 1), "Error", "ONE.OLD"),
        ),
        "inbound_masters": table(
            spark, "id long, source_reference_id long, master_uid string, obl_number string", (11, 1, "J1", "O1"), (12, 2, "J2", None), (13, 1, "J1", "O1"),
        ),
        "inbound_shipments": table(spark, "id long, inbound_master_id long", (1, 11), (2, 11), (3, 13)),
    }
    log = [tuple(r) for r in reports.inbound_log(t, "", date(2025, 1, 5)).orderBy("serialNo").collect()]
    assert log == [
        ("A", 1, "2025-01-01", "09:00:00", "TWO.XML", "J2", None, 0),
        ("A", 2, "2025-01-02", "10:00:00", "ONE.XML", "J1", "O1", 3),
    ]
    assert tuple(reports.inbound_kpi(t, "one", date(2025, 1, 5)).first()) == (2, 1, 0)
    assert tuple(reports.inbound_kpi(t, None, date(2025, 1, 5)).first()) == (0, 0, 0)
    now = datetime(2025, 1, 5, 1, 2, 3, 4000)
    got = whole(reports.inbound_monitor(t, "one", now), "source")
    assert got["A"]["timestamp"] == "2025-01-05T01:02:03.004+05:30" and got["A"]["error"] is None
    assert [f["fileName"] for f in got["A"]["result"]["fileProcessingLog"]] == ["ONE.XML"]
    assert got["B"]["result"]["fileProcessingLog"] == [] and got["B"]["result"]["totalFilesRequired"] == 2


def test_port_list(spark):
    t = {"ports": table(spark, "name string, country_code string, code string, transport_mode string", ("DELTA", "AA", "D1", "Sea"), ("delta", "AA", "D2", None), ("ZETA", "ZZ", None, "Air"))}

    def codes(kind, search):
        return [(r.portCode, r.listValue) for r in reports.port_list(t, kind, search).collect()]

    assert codes("port", "del") == [("D1", "DELTA-(D1)")]
    assert codes("PORT_MASTER", "eta") == [(None, None)]
    assert codes("AGENT", "del") == codes(None, "del") == codes("port", None) == []
    assert [p["portCode"] for p in json.loads(reply(reports.port_reply(t, "port", "e")))] == ["D1", None]
    assert reply(reports.port_reply(t, "AGENT", "del")) == "[]"


def test_sailing_schedule(spark):
    t = {
        "ports": table(spark, "id long, code string, name string, country_code string", (1, "A", "Alpha", "AA"), (2, "B", "Beta", "BB")),
        "schedules": table(
            spark,
            "schedule_id string, origin_id long, destination_id long, co_loader_id long, origin_name string, destination_name string, vessel_name string, "
            "route_no string, etd timestamp_ntz, eta timestamp_ntz, load_port_cutoff_date timestamp_ntz, service string",
            ("s1", 1, 2, None, "o", "d", "v", "r", datetime(2025, 1, 5), datetime(2025, 1, 9, 12), datetime(2025, 1, 3), "FCL"),
            ("s2", 2, 1, 4, "o", "d", "v", "r", datetime(2025, 1, 5), None, datetime(2025, 1, 3), "fcl/lcl"),
            ("s3", 1, 9, 4, "o", "d", "v", "r", None, None, None, "FCL"),
        ),
    }

    def found(*a):
        return sorted(r.scheduleId for r in reports.sailing_schedule(t, *a).collect())

    assert found("A", "B", "") == ["s1"] and found("", None, "") == ["s1", "s2"]
    assert found(None, "", "FCL") == ["s1"] and found("A", None, "") == [] and found("", "", None) == []
    row = reports.sailing_schedule(t, "A", "B", "FCL").first()
    assert (row.isCoload, row.originName, row.polName, row.cutOffToArrival, row.departureToArrival) == ("N", "Alpha", "o", "6 Days", "4 Days")


def test_sales_enquiry(spark):
    t = {
        "user_customers": table(spark, "registration_no long, customer_id long", (70, 5)),
        "enquiries": table(spark, "id long, customer_id long, enquiry_no string, enquiry_date date, quote_by_date date", (1, 5, "E1", date(2025, 1, 2), None), (2, 5, "E2", date(2024, 1, 2), None), (3, 5, "E3", date(2025, 1, 3), None)),
        "enquiry_services": table(
            spark, "enquiry_detail_id long, origin_id long, destination_id long, tos_id long, origin_name string, destination_name string",
            (1, 1, 2, 1, "o", "d"), (1, 1, 2, 1, "o", "d"), (1, 1, 9, 1, "o", "x"),
        ),
        "enquiry_dimensions": table(spark, "enquiry_detail_id long, gross_weight_kgs decimal(9,2), volume_in_weight decimal(9,2)", (1, D(5), D(1)), (1, D(6), None)),
        "terms": table(spark, "id long, name string", (1, "FOB")),
        "ports": table(spark, "id long, code string, country_code string", (1, "A", "AA"), (2, "B", "BB")),
    }
    got = {(r.enquiryNo, r.destinationName): (r.destination, r.tos, r.grossWeightKgs, r.volumeInWeight) for r in reports.sales_enquiry(t, 30, date(2025, 1, 10)).collect()}
    assert got == {("E1", "d"): ("B", "FOB", D(22), D(2)), ("E1", "x"): (None, "FOB", D(11), D(1)), ("E3", None): (None, None, None, None)}


def test_user_bundle(spark):
    t = {
        "users": table(spark, "id long, user_id string, lov_status string, email string, company_logo binary", (1, "a", "Active", "e", bytearray(b"logo")), (2, "b", "Inactive", None, None), (3, "c", "Active", None, None)),
        "user_customers": table(spark, "registration_no long, customer_id long, company_code string", (1, 10, "X"), (1, 11, "Y"), (1, None, "Z"), (1, 12, "W")),
        "customers": table(spark, "id long, customer_uid string, name string", (10, "U10", "Ten"), (12, "U12", "Twelve")),
        "user_modules": table(spark, "master_id long, module_id long", (1, 5), (1, 6)),
        "modules": table(spark, "id long, label string, path string", (5, "Home", "/")),
    }
    got = {r.userName: r for r in reports.user_bundle(t).collect()}
    assert set(got) == {"a", "c"}
    assert [c["customerCode"] for c in json.loads(got["a"].customers)] == ["U10", "U12"]
    assert json.loads(got["a"].modules) == [{"label": "Home", "path": "/"}]
    assert got["a"].companyLogo == "bG9nbw==" and (got["c"].customers, got["c"].modules) == ("[]", "[]")


def test_hot_shipment_keeps_all_containers(spark):
    rows = reports.daily_status(status_tables(spark, containers=100), 30, date(2025, 1, 20), login=70)
    hot = rows.filter(F.col("shipmentid") == 2).collect()
    assert [(r.id, r.noOfContainers) for r in hot] == [(2, "50*20GP,50*40HC")]
    assert hot[0].containerNumber.split(",") == [f"C{i:04d}" for i in range(100)]
