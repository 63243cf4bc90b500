"""Outbound documents, rendered for all keys in one job.

Documents of a fixed number of lines are one text expression per row. Others
are built as line rows on their own grain, tagged with sort columns, and
gathered last.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolens.functions.text import (
    COMPACT_DATE,
    COMPACT_TIME,
    ISSUE_STAMP,
    address_line,
    fixed_three,
    nz,
    oracle_concat,
    split_number,
    xml_escape,
)
from cargolens.operators.joins import lookup, partner_lookup, role_join, role_lookup, translate_code
from cargolens.operators.numbering import assign_sequence
from cargolens.operators.ordered import first_per_key, serial
from cargolens.session import staged

Tables = Mapping[str, DataFrame]


def _now(as_of: datetime) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


# ---- air house list ------------------------------------------------------

# Format line of the air house list, notice for an unknown shipment.
AIR_FORMAT = "FHL/4\n"
NO_DATA = "NO DATA FOUND FOR SHIPMENT "


def air_house_list(t: Tables, address_lines: str, references: DataFrame | None = None) -> DataFrame:
    """``(doc_key, content)`` per shipment, or per id in ``references``.

    ``address_lines`` are the teletype addresses of receiver and sender, which open the text.
    A missing party address, or one whose country is unknown, makes the whole
    text NULL; an unknown shipment gives a notice instead.
    """
    opening = f"{address_lines}\n{AIR_FORMAT}"
    shipments = t["air_shipments"].withColumn("_found", F.lit(True))
    if references is not None:
        shipments = references.select("id").join(shipments, "id", "left")
    commodity = first_per_key(
        t["shipment_cargo"].select(F.col("shipment_header_id").alias("id"), F.col("id").alias("_cargo"), "commodity_description"),
        ["id"],
        ["_cargo"],
    ).drop("_cargo")
    parties = first_per_key(
        t["shipment_parties"].select(
            F.col("shipment_header_id").alias("id"), "shipper_address_id", "consignee_address_id"
        ),
        ["id"],
        ["shipper_address_id", "consignee_address_id"],
    )
    address = t["party_addresses"].join(
        t["countries"].select(F.col("id").alias("country_id"), F.col("code").alias("_country")), "country_id"
    )
    a = F.col
    line = address_line(a("building_no"), a("street_name"), a("city_name"), a("po_box"))
    block = F.concat(F.lit("/"), line, F.lit("\n/"), nz(a("state_name")), F.lit("\n/"), nz(a("_country")), F.lit("\n"))
    blocks = address.select("id", block.alias("block"))
    roles = {"shipper": "shipper_address_id", "consignee": "consignee_address_id"}
    parties = role_lookup(parties, "id", roles, blocks, ["block"])

    rows = role_join(shipments, t["ports"], {"origin": "origin_id", "destination": "destination_id"}, ["code"], how="left")
    rows = rows.join(commodity, "id", "left").join(parties, "id", "left")
    pieces, weight = a("no_of_pieces").cast("string"), a("gross_weight_kgs").cast("string")
    text = F.concat(
        F.lit(opening + "MBI/"),
        split_number(a("master_id")),
        F.lit("/T"),
        pieces,
        F.lit("K"),
        weight,
        F.lit("\nHBS/"),
        a("hbl_or_hawb_no"),
        F.lit("/"),
        nz(a("origin_code")),
        nz(a("destination_code")),
        F.lit("/"),
        pieces,
        F.lit("/K"),
        weight,
        F.lit("//"),
        nz(a("commodity_description")),
        F.lit("\nSHP/"),
        a("shipper_name"),
        F.lit("\n"),
        a("shipper_block"),
        F.lit("CNE/"),
        a("consignee_name"),
        F.lit("\n"),
        a("consignee_block"),
    )
    notice = F.concat(F.lit(opening + NO_DATA), a("id").cast("string"))
    return rows.select(a("id").alias("doc_key"), F.when(a("_found"), text).otherwise(notice).alias("content"))


# ---- 530 message ---------------------------------------------------------

# Fixed value: segments of one transaction.
SEGMENT_COUNT = "4"
PARTNER_KEYS = ["company_code", "branch_code", "location_code"]


@dataclass(frozen=True)
class Interchange:
    """The two segments around a 530 file; they name the parties' systems, so they are given, not known here."""

    opening: str
    closing: str


def _documents_530(t: Tables) -> tuple[DataFrame, DataFrame]:
    found, rejects = partner_lookup(t["finance_documents"], t["partners_530"], PARTNER_KEYS)
    rows = lookup(found, t["jobs"].select("job_uid", "master_no", "pol", "pod", "no_of_pack"), ["job_uid"])
    rows = lookup(rows, t["subjobs"].select("subjob_uid", "pickup_date"), ["subjob_uid"])
    rows = translate_code(rows, t["codes"], "EDI_530", "PORT_MASTER", "pol", "_from")
    rows = translate_code(rows, t["codes"], "EDI_530", "PORT_MASTER", "pod", "_to")
    return rows, rejects


def _gs(as_of: datetime, sequence: Column) -> Column:
    now = _now(as_of)
    return oracle_concat(
        "GS*VI*", F.col("sender_code"), "*", F.col("receiver_code"), "*", F.date_format(now, COMPACT_DATE), "*",
        F.date_format(now, COMPACT_TIME), "*", sequence, "*T*1",
    )


def _transaction(number: Column) -> Column:
    """ST, BV3, VI and SE segments of one document; NULL counts as empty."""
    c = F.col
    return oracle_concat(
        "ST*530*", number, "\nBV3*", c("sender_code"), "*", c("_from"), "*BK*", c("daybook_code"), "-", c("document_no"),
        "*", c("no_of_pack"), "*", F.date_format("pickup_date", COMPACT_DATE), "*", F.date_format("pickup_date", COMPACT_TIME),
        "**", c("master_no"), "***", c("_to"), "\nVI**", c("route_code_origin"), "*", c("route_code_destination"), "*******",
        f"\nSE*{SEGMENT_COUNT}*", number,
    )


def message_530(t: Tables, as_of: datetime, around: Interchange, first_number: int = 1) -> tuple[DataFrame, DataFrame]:
    """One message per finance document, and the documents without a partner."""
    rows, rejects = _documents_530(t)
    numbered = assign_sequence(rows, ["did"], "_gs06", base=first_number - 1)
    text = oracle_concat(
        around.opening, "\n", _gs(as_of, F.col("_gs06")), "\n", _transaction(F.lit("000000001")), "\nGE*1*", F.col("_gs06"),
        "\n", around.closing,
    )
    docs = numbered.select(F.col("did").alias("doc_key"), *PARTNER_KEYS, text.alias("content"))
    return docs, rejects


def message_530_batched(
    t: Tables, as_of: datetime, around: Interchange, first_number: int = 1
) -> tuple[DataFrame, DataFrame]:
    """One message per sender and receiver holding all their documents, as rows ``(doc_key, pos, line)``.

    A message grows with the documents, so it stays in lines: head, documents
    and trailer; in order and joined by line breaks they are the file. Documents are numbered 0001, 0002, … and counted in the trailer.
    """
    rows, rejects = _documents_530(t)
    keyed = rows.withColumn("doc_key", oracle_concat(F.col("sender_code"), "/", F.col("receiver_code")))
    numbered = serial(keyed, ["doc_key"], ["did"], "_no")
    number = F.when(F.col("_no") < 10000, F.lpad(F.col("_no").cast("string"), 4, "0")).otherwise(F.col("_no").cast("string"))
    body = numbered.select("doc_key", F.col("_no").alias("pos"), _transaction(number).alias("line"))
    batches = keyed.groupBy("doc_key", "sender_code", "receiver_code").agg(F.count(F.lit(1)).alias("_count"))
    batches = assign_sequence(batches, ["doc_key"], "_gs06", base=first_number - 1)
    opening = oracle_concat(around.opening, "\n", _gs(as_of, F.col("_gs06")))
    trailer = oracle_concat("GE*", F.col("_count"), "*", F.col("_gs06"), "\n", around.closing)
    head = batches.select("doc_key", F.lit(0).cast("long").alias("pos"), opening.alias("line"))
    tail = batches.select("doc_key", (F.col("_count") + 1).alias("pos"), trailer.alias("line"))
    docs = head.unionByName(body).unionByName(tail)
    return docs, rejects


# ---- customs XML ---------------------------------------------------------

# Envelope and codes of the customs message.
ENVELOPE = (
    '<?xml version="1.0" encoding="UTF-8"?>\n'
    '<S:Envelope xmlns:S="http://www.w3.org/2003/05/soap-envelope"'
    ' xmlns:wsa="http://schemas.xmlsoap.org/ws/2004/03/addressing"'
    ' xmlns:ebi="{}"'
    ' xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"'
    ' xmlns:xsd="http://www.w3.org/2001/XMLSchema">\n'
)
SEA_MODE = "1"
IN_CONTAINER = "1"
PREPAID = "A"
MASTER_DOCUMENT = "N704"
HOUSE_DOCUMENT = "N714"
PERSON_TYPE = "2"
PACKED_STATUS = "B"
SUPPLIER_TYPE = "2"


#: Column of a name: that of a row, or the field of a struct in a list.
Of = Callable[[str], Column]


def _el(tag: str, *content: Column | str) -> Column:
    """``<tag>text</tag>``; text is escaped, NULL is empty."""
    inner = [F.lit(c) if isinstance(c, str) else xml_escape(c) for c in content]
    return F.concat(F.lit(f"<{tag}>"), *inner, F.lit(f"</{tag}>\n"))


def _group(tag: str, *children: Column) -> Column:
    return F.concat(F.lit(f"<{tag}>\n"), *children, F.lit(f"</{tag}>\n"))


def _address(c: Of, role: str, extra_line: bool = False) -> Column:
    parts = [
        _el("city", c(f"{role}_city")),
        _el("country", c(f"{role}_country_code")),
        _el("street", c(f"{role}_address")),
        _el("postCode", c(f"{role}_zip_code")),
    ]
    if extra_line:
        parts.append(_el("streetAdditionalLine", ""))
    return _group("Address", *parts, _el("number", c(f"{role}_mobile_no")))


def _party(c: Of, tag: str, name: str, role: str, id_column: str | None = None, extra_line: bool = False) -> Column:
    number = [_el("identificationNumber", c(id_column))] if id_column else []
    return _group(
        tag, _el("name", c(name)), *number, _el("typeOfPerson", PERSON_TYPE), _address(c, role, extra_line)
    )


def _routing(c: Of, number: str, country: str) -> Column:
    return _group("CountriesOfRoutingOfConsignment", _el("sequenceNumber", number), _el("country", c(country)))


def goods_items(t: Tables) -> DataFrame:
    """One row per packed container of a house, numbered within the house."""
    keys = ["job_uid", "container_uid", "segment_code", "job_no"]
    packed = t["subjob_containers"].join(
        t["job_containers"].select(*keys, "container_code", "container_no", "actual_seal"), keys
    )
    order = ["container_code", "container_no", "actual_seal", "external_no_of_pack", "gross_weight", "volume", *keys]
    of_house = Window.partitionBy("subjob_uid").orderBy(*order)
    return packed.withColumn("item_no", F.row_number().over(of_house).cast("long"))


def _customs_head(c: Of, now: Column, namespace: str, action: str) -> Column:
    return F.concat(
        F.lit(ENVELOPE.format(namespace) + "<S:Header>\n<wsa:From><wsa:Address>urn:scac:"),
        xml_escape(c("sender_code")),
        F.lit("</wsa:Address></wsa:From>\n"),
        _el("wsa:To", "urn:zz:", c("receiver_code")),
        _el("wsa:Action", action),
        _el("ebi:TestIndicator", "T"),
        F.lit("</S:Header>\n<S:Body>\n<SMFENS2>\n"),
        _group("SMFAPI", _el("senderID", c("sender_code")), _el("recipientID", c("receiver_code")), _el("docType", c("document_type"))),
        F.lit("<SMFENS2FilingBody>\n"),
        _el("LRN", c("lrn"), "-", F.date_format(now, "yyyyMMdd"), "-", c("document_type"), "-001"),
        _el("documentIssueDate", F.date_format(now, ISSUE_STAMP)),
        _el("specificCircumstanceIndicator", c("document_type")),
        _group("AddressedMemberState", _el("country", c("member_country"))),
        _el("SplitConsignment", ""),
        _group("ActiveBorderTransportMeans", _el("modeOfTransport", SEA_MODE)),
        F.lit("<ConsignmentMasterLevel>\n<ConsignmentHouseLevel>\n"),
        _el("containerIndicator", IN_CONTAINER),
        _el("totalGrossMass", fixed_three(c("_mass"))),
        _group("PlaceOfAcceptance", _el("unlocode", c("pol"))),
        _group("TransportDocumentMasterLevel", _el("documentNumber", c("master_no")), _el("type", MASTER_DOCUMENT)),
        _group("Carrier", _el("identificationNumber", c("carrier_booking_no"))),
        _party(c, "Consignee", "consignee_manifest_name", "consignee"),
    )


def _customs_tail(c: Of) -> Column:
    return F.concat(
        _party(c, "Consignor", "shipper_manifest_name", "shipper", extra_line=True),
        _group("TransportCharges", _el("methodOfPayment", PREPAID)),
        _group("PlaceOfDelivery", _el("unlocode", c("pod"))),
        _group(
            "GoodsShipment",
            _party(c, "Buyer", "consignee_manifest_name", "consignee", id_column="consignee_code"),
            _party(c, "Seller", "shipper_manifest_name", "shipper"),
        ),
        _routing(c, "1", "from_country_code"),
        _routing(c, "2", "to_country_code"),
        _group("TransportDocumentHouseLevel", _el("documentNumber", c("house_no")), _el("type", HOUSE_DOCUMENT)),
        F.lit("</ConsignmentHouseLevel>\n</ConsignmentMasterLevel>\n"),
        _group(
            "Declarant",
            _el("name", c("declarant_name")),
            _el("identificationNumber", c("declarant_id")),
            _group(
                "Address",
                _el("city", c("declarant_city")),
                _el("country", c("declarant_country")),
                _el("street", c("declarant_street")),
                _el("postCode", c("declarant_postcode")),
                _el("number", c("declarant_number")),
            ),
            _group("Communication", _el("identifier", c("declarant_email")), _el("type", "EM")),
        ),
        F.lit("</SMFENS2FilingBody>\n</SMFENS2>\n</S:Body>\n</S:Envelope>"),
    )


def _goods_item(c: Of) -> Column:
    return _group(
        "GoodsItem",
        _el("goodsItemNumber", c("item_no")),
        _group(
            "Commodity",
            _el("descriptionOfGoods", c("commodity_description")),
            _group("CommodityCode", _el("harmonizedSystemSubHeadingCode", "")),
            _group("DangerousGoods", _el("unNumber", "")),
        ),
        _group("Weight", _el("grossMass", fixed_three(c("gross_weight")))),
        _group(
            "Packaging",
            _el("shippingMarks", c("mark_no")),
            _el("numberOfPackages", c("external_no_of_pack")),
            _el("typeOfPackages", c("external_pack_code")),
        ),
        _group(
            "TransportEquipment",
            _el("containerSizeAndType", c("_size_type")),
            _el("containerPackedStatus", PACKED_STATUS),
            _el("containerSupplierType", SUPPLIER_TYPE),
            _el("containerIdentificationNumber", c("container_no")),
            _el("numberOfSeals", "1"),
            _group("Seal", _el("identifier", c("actual_seal"))),
        ),
    )


def customs_xml(t: Tables, as_of: datetime, namespace: str, action: str) -> tuple[DataFrame, DataFrame]:
    """``(doc_key, content)`` and the queue's three codes per house, and the houses without a partner.

    ``namespace`` and ``action`` are those of the receiving network's envelope.
    """
    c = F.col
    houses = t["subjobs"].join(t["subjob_tree"], "subjob_uid").join(
        t["jobs"].select("job_uid", "master_no", "carrier_booking_no"), "job_uid"
    )
    found, rejects = partner_lookup(houses, t["partners_customs"].drop("branch_code", "location_code"), ["company_code"])
    # read for the parties, the texts and the items
    found = staged(found, "houses")
    weight = t["subjob_containers"].groupBy("subjob_uid").agg(F.sum(F.coalesce("gross_weight", F.lit(0))).alias("_mass"))
    columns = ["city", "country_code", "address", "zip_code", "mobile_no"]
    primary = t["customer_addresses"].filter("address_type = 'PRIMARY'")
    primary = first_per_key(primary.select("customer_code", *columns), ["customer_code"], ["city", "address"])
    roles = {"consignee": "consignee_code", "shipper": "shipper_code"}
    rows = role_lookup(found, "subjob_uid", roles, primary, columns, dim_key="customer_code")
    rows = rows.join(weight, "subjob_uid", "left")
    ports = t["ports"].select("code", "country_code")
    rows = role_join(rows, ports, {"from": "pol", "to": "pod"}, ["country_code"], key="code", how="left")
    found_items = found.select("subjob_uid", "commodity_description", "mark_no", "external_pack_code")
    items = translate_code(goods_items(t), t["codes"], "EDI_ICS2", "CONTAINER_MASTER", "container_code", "_size_type")
    items = items.join(found_items, "subjob_uid")

    def listed(df: DataFrame, fields: list[str], name: str) -> DataFrame:
        return df.groupBy("subjob_uid").agg(F.collect_list(F.struct(*fields)).alias(name))

    def texts(rows: str, text: Callable[[Of], Column], *order: str) -> Column:
        # Texts end in a line break, which stands between them again.
        one = F.transform(rows, lambda x: F.struct(*[x[o] for o in order], F.rtrim(text(lambda n: x[n]), F.lit("\n")).alias("v")))
        return F.transform(F.sort_array(one), lambda x: x["v"])

    def of_houses(text: Callable[[Of], Column]) -> Column:
        # a key with a single row, as nearly all have, needs no list of texts
        single = F.rtrim(text(lambda n: F.get("houses", F.lit(0))[n]), F.lit("\n"))
        return F.when(F.size("houses") == 1, F.array(single)).otherwise(texts("houses", text))

    # Columns are gathered, not texts: a text is made when its document is.
    shown = [x for x in rows.columns if x not in ("subjob_uid", *PARTNER_KEYS)]
    boxed = ["item_no", "gross_weight", "external_no_of_pack", "_size_type", "container_no", "actual_seal"]
    whole = listed(rows, shown, "houses").join(listed(items, [*boxed, *found_items.columns[1:]], "items"), "subjob_uid", "left")
    whole = whole.join(found.select("subjob_uid", *PARTNER_KEYS), "subjob_uid")
    head = of_houses(lambda of: _customs_head(of, _now(as_of), namespace, action))
    between = F.coalesce(texts("items", _goods_item, "item_no"), F.array().cast("array<string>"))
    parts = F.concat(head, between, of_houses(_customs_tail))
    docs = whole.select(c("subjob_uid").alias("doc_key"), F.array_join(parts, "\n").alias("content"), *PARTNER_KEYS)
    return docs, rejects
