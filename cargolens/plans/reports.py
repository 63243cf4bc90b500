"""Reports for all logins, shipments and files at once.

Every function takes a mapping of table name to DataFrame. Keys that the
single-call form takes as a parameter stay as columns; filter on them for one
key. Report rows are the result; JSON replies are built from them as ordered
rows of text.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.text import (
    CLOCK,
    ISO_DATE,
    REPLY_STAMP,
    json_text,
    short_upper_date,
    whole_days,
)
from cargolens.operators.aggregates import margin_pct, signed_ledger, status_counts
from cargolens.operators.joins import left_join_agg, membership_flags, role_join
from cargolens.operators.lists import count_by_code, json_item, nest, reply_rows, string_list, text_rows
from cargolens.operators.ordered import serial
from cargolens.operators.predicates import (
    booking_state,
    date_window,
    flag_present,
    list_value,
    lookback,
    open_range,
    optional_eq,
    pair_or_all,
    search_contains,
)

Tables = Mapping[str, DataFrame]


def notice(**fields: str) -> str:
    """Text of a reply that only says how it went."""
    return json.dumps(fields, separators=(",", ":"))


# Replies without rows, and the answer when a report's job fails.
NO_SHIPMENTS = notice(Status="Error", Message="Shipment List not available")
NO_FINANCE = notice(status="error", message="No shipment data found")
INACTIVE = notice(status="FAIL", message="Account is inactive")


def failure_reply(error: Exception, finance: bool = False) -> str:
    """What a caller answers with when the job of a reply failed."""
    return notice(status="failure", message=str(error)) if finance else notice(Status="Failure", Message=str(error))


# ---- daily status --------------------------------------------------------

# Report field and the shipment column it shows.
STATUS_FIELDS = {
    "shipmentid": "id",
    "shipment": "shipment_uid",
    "bookedDate": "shipment_date",
    "hblNumber": "hbl_no",
    "origin": "origin_name",
    "originCountryCode": "origin_country_code",
    "destination": "destination_name",
    "destinationCountryCode": "destination_country_code",
    "mode": "transport_mode",
    "orderNo": "order_no",
    "tosName": "tos_name",
    "bookingDate": "order_confirmation",
    "readyDate": "order_ready",
    "pickupDate": "order_pickup",
    "departure": "order_departure",
    "arrival": "order_arrival",
    "estimatedDeparture": "etd",
    "actualDeparture": "atd",
    "estimatedArrival": "eta",
    "actualArrival": "ata",
    "status": "status",
    "shipper": "shipper_name",
    "consignee": "consignee_name",
    "notify": "notify_name",
    "billing": "billing_customer_name",
    "commodityDescription": "commodity_description",
    "totalWeight": "gross_weight_kgs",
    "totalVolume": "volume_in_cbm",
    "packageType": "pack_name",
    "noOfUnits": "no_of_pieces",
    "cargoPickup": "pickup_required",
    "doorDelivery": "delivery_required",
    "cargoReadyDate": "order_ready",
    "cargoType": "cargo_type",
}
SHORT_DATES = ("estimatedDeparture", "actualDeparture", "estimatedArrival", "actualArrival")
STATUS_COLUMNS = ["id", *STATUS_FIELDS, "hsCode", "noOfContainers", "containerNumber"]


def daily_status(t: Tables, days: int, as_of: date, login: int | None = None) -> DataFrame:
    """One row per login and recent shipment."""
    logins = optional_eq(t["user_customers"], "registration_no", login).select("registration_no", "customer_id")
    users = t["users"].select(F.col("id").alias("registration_no"))
    recent = lookback(t["shipment_list"], "shipment_date", days, as_of)
    rows = recent.join(logins.join(users, "registration_no"), "customer_id")
    numbered = serial(
        rows.withColumnRenamed("id", "_shipment").withColumnRenamed("registration_no", "login"),
        ["login"],
        ["shipment_uid", "_shipment"],
        "_serial",
    )

    ids = (recent if login is None else rows).select(F.col("id").alias("shipment_id"))
    boxes = (
        t["shipment_containers"]
        .select("shipment_id", F.col("master_container_id").alias("id"))
        .join(ids, "shipment_id", "left_semi")
        .join(t["master_containers"].select("id", "container_id", "container_number"), "id")
    )
    types = t["container_types"].select(F.col("id").alias("container_id"), "code")
    counts = count_by_code(boxes.join(types, "container_id"), ["shipment_id"], "code", "noOfContainers")
    numbers = string_list(boxes, ["shipment_id"], "container_number", "containerNumber")

    shown = numbered.join(numbers.withColumnRenamed("shipment_id", "_shipment"), "_shipment", "left")
    shown = shown.join(counts.withColumnRenamed("shipment_id", "_shipment"), "_shipment", "left")
    cols = []
    for field, source in STATUS_FIELDS.items():
        value = F.col("_shipment" if source == "id" else source)
        cols.append((short_upper_date(value) if field in SHORT_DATES else value).alias(field))
    return shown.select(
        "login",
        F.col("_serial").alias("id"),
        *cols,
        F.lit("").alias("hsCode"),
        "noOfContainers",
        "containerNumber",
    )


def daily_status_envelope(t: Tables, days: int, as_of: date, preferences: bool = True) -> DataFrame:
    """JSON reply per login as rows ``(login, pos, text)``: rows, column preferences, mail triggers.

    Without ``preferences`` the reply is the older plain array. The texts of a
    login in order of ``pos`` are its reply.
    """
    rows = daily_status(t, days, as_of)
    items = rows.select("login", F.col("id").alias("pos"), json_item("id", {c: c for c in STATUS_COLUMNS}).alias("text"))
    shown = rows.select("login").distinct().withColumn("_shown", F.lit(True))
    out = t["users"].select(F.col("id").alias("login")).join(shown, "login", "left")
    head, tail = F.lit("["), F.lit("]")
    if preferences:
        columns = t["user_preferences"].groupBy(F.col("web_user_master_id").alias("login")).agg(
            F.min("column_preferences").alias("_columns")
        )
        trigger_fields = {
            "mailId": "mail_id",
            "dayStatus": "day_status",
            "days": "days",
            "statusList": "status_list",
            "lastTriggeredDate": "last_trigger_date",
        }
        # The trigger table is keyed by login, so the array holds its one row.
        trigger = F.array(F.struct(*[F.col(c).alias(n) for n, c in trigger_fields.items()]))
        triggers = t["user_triggers"].select(
            F.col("web_user_master_id").alias("login"), json_text(trigger).alias("_triggers")
        )
        out = out.join(columns, "login", "left").join(triggers, "login", "left")
        none = F.lit("null")
        head = F.concat(F.lit('{"userColumns":'), F.coalesce("_columns", none), F.lit(',"data":['))
        tail = F.concat(F.lit('],"userTrigger":'), F.coalesce("_triggers", none), F.lit("}"))
    missing = F.lit(NO_SHIPMENTS)
    heads = out.select(
        "login",
        F.when(F.col("_shown"), head).otherwise(missing).alias("head"),
        F.when(F.col("_shown"), tail).alias("tail"),
    )
    return text_rows(heads, items, ["login"])


# ---- inbound files -------------------------------------------------------


def inbound_log(t: Tables, search: str | None, as_of: date, frm: date | None = None, to: date | None = None) -> DataFrame:
    """Received files with their jobs and house counts, numbered per source."""
    files = search_contains(date_window(t["inbound_files"], "received_at", as_of, frm, to), "file_name", search)
    # only what belongs to the files found is aggregated
    wanted = files.select(F.col("id").alias("source_reference_id"))
    masters = t["inbound_masters"].select("id", "source_reference_id", "master_uid", "obl_number")
    masters = masters.join(wanted, "source_reference_id", "left_semi")
    houses = t["inbound_shipments"].select("id", "inbound_master_id")
    masters = left_join_agg(
        masters,
        houses.join(masters.select(F.col("id").alias("inbound_master_id")), "inbound_master_id", "left_semi"),
        {"id": "inbound_master_id"},
        {"_houses": F.count("id")},
    ).drop("id")
    rows = files.select("id", "source", "received_at", "file_name").join(
        masters, F.col("id") == F.col("source_reference_id")
    )
    keys = ["source", "received_at", "file_name", "master_uid", "obl_number"]
    grouped = rows.groupBy(*keys).agg(F.sum(F.coalesce("_houses", F.lit(0))).alias("houseCount"))
    numbered = serial(grouped, ["source"], keys[1:], "serialNo")
    return numbered.select(
        "source",
        "serialNo",
        F.date_format("received_at", ISO_DATE).alias("date"),
        F.date_format("received_at", CLOCK).alias("time"),
        F.col("file_name").alias("fileName"),
        F.col("master_uid").alias("jobId"),
        F.col("obl_number").alias("mblNo"),
        "houseCount",
    )


def inbound_kpi(t: Tables, search: str | None, as_of: date, frm: date | None = None, to: date | None = None) -> DataFrame:
    """Counts over all sources in the window."""
    files = search_contains(date_window(t["inbound_files"], "received_at", as_of, frm, to), "file_name", search)
    counts = {"successfullyProcessed": "Completed", "failedErrors": "Error"}
    return status_counts(files, "status", counts, "totalFilesRequired")


def inbound_monitor(
    t: Tables, search: str | None, now: datetime, frm: date | None = None, to: date | None = None
) -> DataFrame:
    """JSON reply per source as rows ``(source, pos, text)``: counts and file log."""
    log = inbound_log(t, search, now.date(), frm, to)
    fields = {c: c for c in log.columns if c != "source"}
    items = log.select("source", F.col("serialNo").alias("pos"), json_item("serialNo", fields).alias("text"))
    kpi = inbound_kpi(t, search, now.date(), frm, to)
    stamp = F.date_format(F.lit(now).cast("timestamp_ntz"), REPLY_STAMP)
    result = F.struct(
        *[F.col(c) for c in kpi.columns],
        stamp.alias("lastSyncTime"),
        F.array().cast("array<string>").alias("fileProcessingLog"),
    )
    reply = kpi.select(success_reply(result, stamp).alias("r")).scalar()
    heads = t["inbound_files"].select("source").distinct().withColumn("_reply", reply)
    # the files go between the brackets of the empty log
    heads = heads.select(
        "source",
        F.concat(F.substring_index("_reply", "[]", 1), F.lit("[")).alias("head"),
        F.concat(F.lit("]"), F.substring_index("_reply", "[]", -1)).alias("tail"),
    )
    return text_rows(heads, items, ["source"])


def success_reply(result: Column, stamp: Column) -> Column:
    """Reply text: status, success flag, time, payload, no error."""
    return json_text(
        F.struct(
            F.lit(200).alias("httpStatus"),
            F.lit(True).alias("success"),
            stamp.alias("timestamp"),
            result.alias("result"),
            F.lit(None).cast("string").alias("error"),
        )
    )


# ---- ports, schedules, enquiries ----------------------------------------


def port_list(t: Tables, master_type: str | None, search: str | None) -> DataFrame:
    """Ports whose name contains the upper-cased search; other types are empty."""
    known = master_type is not None and master_type.upper() in ("PORT_MASTER", "PORT")
    ports = search_contains(t["ports"], "name", search if known else None)
    return ports.select(
        F.col("name").alias("portName"),
        F.col("country_code").alias("portCountry"),
        F.col("code").alias("portCode"),
        F.lit("PORT").alias("type"),
        F.col("transport_mode").alias("transportMode"),
        list_value(F.col("name"), F.col("code")).alias("listValue"),
    )


def _same(df: DataFrame) -> dict[str, str]:
    return {c: c for c in df.columns}


def port_reply(t: Tables, master_type: str | None, search: str | None) -> DataFrame:
    """JSON array of the ports found, as rows ``(pos, text)``; ``[]`` without any or for other types."""
    ports = port_list(t, master_type, search)
    return reply_rows(ports, ["portName", "portCode", "portCountry", "transportMode"], _same(ports))


def schedule_reply(t: Tables, origin: str | None, destination: str | None, service: str | None) -> DataFrame:
    """JSON array of the sailings found, as rows ``(pos, text)``; ``[]`` without any."""
    rows = sailing_schedule(t, origin, destination, service)
    return reply_rows(rows, ["scheduleId", *[c for c in rows.columns if c != "scheduleId"]], _same(rows))


def sailing_schedule(t: Tables, origin: str | None, destination: str | None, service: str | None) -> DataFrame:
    rows = search_contains(t["schedules"], "service", service, upper=False)
    ports = {"origin": "origin_id", "destination": "destination_id"}
    renamed = rows.withColumnsRenamed({"origin_name": "polName", "destination_name": "podName"})
    named = role_join(renamed, t["ports"], ports, ["code", "name", "country_code"])
    found = pair_or_all(named, "origin_code", "destination_code", origin, destination)
    return found.select(
        F.col("origin_code").alias("originCode"),
        F.col("origin_name").alias("originName"),
        F.col("destination_code").alias("destinationCode"),
        flag_present(F.col("co_loader_id")).alias("isCoload"),
        F.col("origin_code").alias("pol"),
        "polName",
        F.col("destination_code").alias("pod"),
        "podName",
        F.col("origin_country_code").alias("originCountryCode"),
        F.col("destination_country_code").alias("destinationCountryCode"),
        F.col("schedule_id").alias("scheduleId"),
        F.col("vessel_name").alias("vessel"),
        F.col("route_no").alias("voyage"),
        F.col("etd").alias("departureDate"),
        F.col("eta").alias("arrivalDate"),
        F.col("load_port_cutoff_date").alias("cutoffDate"),
        whole_days(F.col("eta"), F.col("load_port_cutoff_date")).alias("cutOffToArrival"),
        whole_days(F.col("eta"), F.col("etd")).alias("departureToArrival"),
    )


def sales_enquiry(t: Tables, days: int | None, as_of: date, login: int | None = None) -> DataFrame:
    """Enquiries per login with summed dimensions.

    Dimensions are summed per enquiry and equal service rows counted before
    they meet, so no dimension row is repeated; a sum times a count gives the
    total of the full join.
    """
    logins = optional_eq(t["user_customers"], "registration_no", login).select("registration_no", "customer_id")
    recent = lookback(t["enquiries"], "enquiry_date", days, as_of)
    enquiries = logins.join(recent, "customer_id")
    asked = recent if login is None else enquiries
    wanted = asked.select(F.col("id").alias("enquiry_detail_id"))
    weights = t["enquiry_dimensions"].join(wanted, "enquiry_detail_id", "left_semi")
    sums = {"_gross": F.sum("gross_weight_kgs"), "_volume": F.sum("volume_in_weight")}
    rows = left_join_agg(enquiries, weights, {"id": "enquiry_detail_id"}, sums)
    services = t["enquiry_services"].join(wanted, "enquiry_detail_id", "left_semi").groupBy(
        "enquiry_detail_id", "origin_id", "destination_id", "tos_id", "origin_name", "destination_name"
    ).agg(F.count(F.lit(1)).alias("_times"))
    rows = rows.join(services, F.col("id") == F.col("enquiry_detail_id"), "left")
    rows = rows.withColumnsRenamed({"origin_name": "originName", "destination_name": "destinationName"})
    rows = role_join(rows, t["terms"], {"tos": "tos_id"}, ["name"], how="left")
    ports = {"origin": "origin_id", "destination": "destination_id"}
    rows = role_join(rows, t["ports"], ports, ["code", "country_code"], how="left")
    return rows.groupBy(
        "registration_no",
        F.col("enquiry_no").alias("enquiryNo"),
        F.col("enquiry_date").alias("enquiryDate"),
        F.col("origin_code").alias("origin"),
        "originName",
        F.col("origin_country_code").alias("originCountry"),
        F.col("destination_code").alias("destination"),
        "destinationName",
        F.col("destination_country_code").alias("destinationCountry"),
        F.col("quote_by_date").alias("validUpto"),
        F.col("tos_name").alias("tos"),
    ).agg(
        F.sum(F.col("_gross") * F.coalesce("_times", F.lit(1))).alias("grossWeightKgs"),
        F.sum(F.col("_volume") * F.coalesce("_times", F.lit(1))).alias("volumeInWeight"),
    )


def enquiry_reply(t: Tables, days: int | None, as_of: date, login: int | None = None) -> DataFrame:
    """JSON array per login by enquiry date, as rows ``(registration_no, pos, text)``; one NULL text without enquiries."""
    rows = sales_enquiry(t, days, as_of, login)
    fields = {c: c for c in rows.columns if c != "registration_no"}
    order = ["enquiryDate", "enquiryNo", *[c for c in fields if c not in ("enquiryDate", "enquiryNo")]]
    numbered = serial(rows, ["registration_no"], order, "pos")
    items = numbered.select("registration_no", "pos", json_item("pos", fields).alias("text"))
    shown = items.select("registration_no").distinct().withColumn("_shown", F.lit(True))
    logins = optional_eq(t["user_customers"], "registration_no", login).select("registration_no").distinct()
    heads = logins.join(shown, "registration_no", "left").select(
        "registration_no", F.when(F.col("_shown"), "[").alias("head"), F.when(F.col("_shown"), "]").alias("tail")
    )
    return text_rows(heads, items, ["registration_no"])


# ---- finance -------------------------------------------------------------


def _wip_flags(ledger: DataFrame, accounts: DataFrame, null_guard: str) -> DataFrame:
    if null_guard not in ("own_column", "reference"):
        raise ValueError(f"unknown null_guard {null_guard!r}")
    guard = "wip_cost_account_id" if null_guard == "own_column" else "wip_revenue_account_id"
    revenue = accounts.filter("wip_revenue_account_id is not null").select("wip_revenue_account_id")
    cost = accounts.filter(F.col(guard).isNotNull()).select("wip_cost_account_id")
    return membership_flags(ledger, "account_id", {"_wip_revenue": revenue, "_wip_cost": cost})


def wip_finance(
    t: Tables,
    to_date: date | None,
    from_date: date | None = None,
    group_company_id: int | None = None,
    company_id: int | None = None,
    branch_id: int | None = None,
    service_id: int | None = None,
    mode: str | None = None,
    shipment_id: int | None = None,
    null_guard: str = "own_column",
) -> DataFrame:
    """Provisional, booked and work-in-progress money per shipment and service.

    Service rows of one type multiply the amounts of a shipment, as joining
    them to the rates does; here the sums are multiplied by their count.
    ``null_guard="reference"`` takes cost accounts only from rows with a
    revenue account, NULLs included: then one NULL makes all booked cost 0.
    """
    equal = {"group_company_id": group_company_id, "company_id": company_id, "branch_id": branch_id, "id": shipment_id}
    shipments = open_range(t["shipments"], "shipment_date", from_date, to_date)
    for column, value in equal.items():
        shipments = optional_eq(shipments, column, value)
    narrow = from_date is not None or any(v is not None for v in equal.values())

    rates, vouchers = t["shipment_rates"], t["vouchers"]
    if narrow:
        wanted = shipments.select(F.col("id").alias("shipment_header_id"))
        rates = rates.join(wanted, "shipment_header_id", "left_semi")
        rate_ids = rates.select(F.col("id").alias("shipment_rate_id"))
        vouchers = vouchers.join(rate_ids, "shipment_rate_id", "left_semi")

    ledger = vouchers.join(t["ledger_types"], F.col("id") == F.col("record_id"))
    ledger = _wip_flags(ledger, t["wip_accounts"], null_guard)
    amount, side, kind = F.col("local_amount"), F.col("dr_cr"), F.col("rcn_type")
    revenue, cost = kind.isin("C_REVENUE", "S_REVENUE"), kind == "C_COST"
    booked = ledger.groupBy("shipment_rate_id").agg(
        signed_ledger(amount, side, "CR", revenue & ~F.col("_wip_revenue")).alias("income"),
        signed_ledger(amount, side, "DR", cost & ~F.col("_wip_cost")).alias("cost"),
        signed_ledger(amount, side, "CR", revenue & F.col("_wip_revenue")).alias("wip_revenue"),
        signed_ledger(amount, side, "DR", cost & F.col("_wip_cost")).alias("wip_cost"),
    )

    def zero(c: str) -> Column:
        return F.coalesce(c, F.lit(0))

    priced = rates.join(booked, rates["id"] == booked["shipment_rate_id"], "left")
    money = priced.groupBy("shipment_header_id").agg(
        F.sum(F.col("sell_amount") * F.col("currency_rate_of_exchange")).alias("_revenue"),
        F.sum(F.col("cost_amount") * F.col("cost_roe")).alias("_cost"),
        F.sum(zero("sell_amount") * zero("currency_rate_of_exchange")).alias("_revenue0"),
        F.sum(zero("cost_amount") * zero("cost_roe")).alias("_cost0"),
        *[F.sum(zero(c)).alias(f"_{c}") for c in ("income", "wip_revenue", "wip_cost")],
        F.sum(zero("cost")).alias("_booked_cost"),
    )
    services = optional_eq(t["shipment_services"], "service_id", service_id)
    services = services.groupBy("shipment_header_id", "service_type").agg(F.count(F.lit(1)).alias("_times"))

    rows = shipments.select("id", "shipment_uid", "shipment_date").join(
        services.withColumnRenamed("shipment_header_id", "id"), "id", "left" if service_id is None else "inner"
    )
    rows = rows.join(money.withColumnRenamed("shipment_header_id", "id"), "id", "left")
    times = F.coalesce("_times", F.lit(1))
    result = rows.select(
        F.col("id").alias("shipmentId"),
        F.col("service_type").alias("service"),
        F.col("shipment_uid").alias("shipmentUid"),
        F.col("shipment_date").alias("jobDate"),
        (F.col("_revenue") * times).alias("provisionRevenue"),
        (F.col("_cost") * times).alias("provisionCost"),
        margin_pct(zero("_revenue0") * times, zero("_cost0") * times).alias("netGpPercentage"),
        (zero("_income") * times).alias("pnlIncome"),
        (zero("_booked_cost") * times).alias("pnlCost"),
        (zero("_wip_revenue") * times).alias("wipRevenue"),
        (zero("_wip_cost") * times).alias("wipCost"),
    )
    return booking_state(result, mode)


def wip_reply(t: Tables, to_date: date | None, **options) -> DataFrame:
    """JSON array of ``wip_finance`` with the same options, as rows ``(pos, text)``; a notice without shipments."""
    rows = wip_finance(t, to_date, **options)
    return reply_rows(rows, ["shipmentId", "service"], _same(rows), empty=NO_FINANCE)


# ---- users ---------------------------------------------------------------


def user_bundle(t: Tables) -> DataFrame:
    """Active users with their customers and modules, as JSON arrays."""
    mapped = t["user_customers"].join(t["customers"], F.col("customer_id") == F.col("id"), "left")
    customers = nest(
        mapped,
        ["registration_no"],
        ["customer_id", "company_code"],
        {"customerCode": "customer_uid", "customerName": "name", "companyCode": "company_code"},
        "customers",
        where=F.col("id").isNotNull(),
    ).withColumnRenamed("registration_no", "id")
    allowed = t["user_modules"].join(t["modules"], F.col("module_id") == F.col("id")).drop("id")
    modules = nest(allowed, ["master_id"], ["module_id"], {"label": "label", "path": "path"}, "modules")
    lists = customers.join(modules.withColumnRenamed("master_id", "id"), "id", "full")
    users = t["users"].filter("lov_status = 'Active'")
    rows = users.join(lists, "id", "left")
    return rows.select(
        F.col("user_id").alias("userName"),
        "email",
        F.base64("company_logo").alias("companyLogo"),
        F.coalesce(json_text(F.col("customers")), F.lit("[]")).alias("customers"),
        F.coalesce(json_text(F.col("modules")), F.lit("[]")).alias("modules"),
    )


def user_reply(t: Tables) -> DataFrame:
    """JSON reply per user as rows ``(login, section, pos, text)``: status and data, or a notice for inactive users.

    The texts in order of section and pos are the reply. Sections 1 and 3 hold
    the customers and the modules, so no list has to fit in one value.
    """
    active = F.coalesce(F.col("lov_status") == "Active", F.lit(False))
    users = t["users"].select(F.col("id").alias("login"), active.alias("_active"), "user_id", "email", "company_logo")
    zero = F.lit(0).cast("long").alias("pos")
    about = json_text(
        F.struct(F.col("user_id").alias("userName"), F.col("email").alias("email"), F.base64("company_logo").alias("companyLogo"))
    )
    opening = F.concat(F.lit('{"status":"SUCCESS","data":'), F.left(about, F.length(about) - 1), F.lit(',"customers":['))
    rows = users.select("login", F.lit(0).alias("section"), zero, F.when(F.col("_active"), opening).otherwise(INACTIVE).alias("text"))
    logins = users.filter("_active").select("login")
    for section, text in ((2, '],"modules":['), (4, "]}}")):
        rows = rows.unionByName(logins.select("login", F.lit(section).alias("section"), zero, F.lit(text).alias("text")))

    mapped = t["user_customers"].withColumnRenamed("registration_no", "login").join(logins, "login", "left_semi")
    customers = mapped.join(t["customers"], F.col("customer_id") == F.col("id"))
    allowed = t["user_modules"].withColumnRenamed("master_id", "login").join(logins, "login", "left_semi")
    modules = allowed.join(t["modules"], F.col("module_id") == F.col("id"))
    lists = (
        (1, customers, ["customer_id", "company_code"], {"customerCode": "customer_uid", "customerName": "name", "companyCode": "company_code"}),
        (3, modules, ["module_id"], {"label": "label", "path": "path"}),
    )
    for section, items, order, fields in lists:
        numbered = serial(items.select("login", *order, *[c for c in fields.values() if c not in order]), ["login"], order, "pos")
        item = json_item("pos", fields).alias("text")
        rows = rows.unionByName(numbered.select("login", F.lit(section).alias("section"), "pos", item))
    return rows
