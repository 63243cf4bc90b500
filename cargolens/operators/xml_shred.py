"""Manifest XML to seven relational tables.

Each message is parsed once into a nested struct in which every tag may be
repeated. By default the elements are exploded, so values stay with their
element. ``shred_lockstep`` expands parallel value lists side by side instead:
a tag missing in one element then moves the values of later elements up.

Header, master and routing give one row per message, each column the first
value found. A message whose sections are not all where the schema looks for
them is quarantined as a whole rather than shredded in part.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.text import to_boolean

TEXT, INT, DEC, TIME, BOOL = "string", "int", "decimal(18,3)", "timestamp_ntz", "boolean"

# Column, element path and type of each table. The spellings of
# the elements are part of the message format.
HEADER = {
    "message_id": ("MessageID", TEXT),
    "action_code": ("ActionCode", TEXT),
    "sender_code": ("SenderCode", TEXT),
    "receiver_code": ("ReceiverCode", TEXT),
    "message_type": ("MessageType", TEXT),
    "company_code": ("CompanyCode", TEXT),
    "branch_code": ("BranchCode", TEXT),
    "send_datetime": ("SendDateTime", TIME),
    "version": ("Version", TEXT),
}
MASTER = {
    "mbl_number": ("MBLNumber", TEXT),
    "master_file_number": ("MasterFileNumber", TEXT),
    "op_type": ("OPType", TEXT),
    "master_bl_type_code": ("MasterBlTypeCode", TEXT),
    "mbl_origin_agent_code": ("MBLOriginAgentCode", TEXT),
    "mbl_dest_agent_code": ("MBLDestAgentCode", TEXT),
    "carrier_code": ("CarrierCode", TEXT),
    "carrier_name": ("CarrierName", TEXT),
    "master_service_code": ("MasterServiceCode", TEXT),
    "mbl_load_type": ("MBLLoadType", TEXT),
    "type_of_move": ("TypeOfMove", TEXT),
    "mbl_pay_type": ("MBLPayType", TEXT),
    "mbl_total_package": ("MBLTotalPackage", INT),
    "mbl_marking": ("MBLMarking", TEXT),
    "mbl_description": ("MBLDescription", TEXT),
    "mbl_weight_kg": ("MBLWeightKg", DEC),
    "mbl_volume_cbm": ("MBLVolumnCBM", DEC),
    "seaway_bl_indicator": ("SeawayBLIndicator", BOOL),
}
ROUTING = {
    "depart_vessel_name": ("DepartVesselName", TEXT),
    "depart_voyage_no": ("DepartVoyageNo", TEXT),
    "arrival_vessel_name": ("ArrivalVesselName", TEXT),
    "etd": ("ETD", TIME),
    "loading_port_code": ("LoadingPortCode", TEXT),
    "loading_port_name": ("LoadingPortName", TEXT),
    "tranship_port_code": ("TranshipPortCode", TEXT),
    "tranship_port_name": ("TranshipPortName", TEXT),
    "discharge_port_code": ("DischargePortCode", TEXT),
    "discharge_port_name": ("DischargePortName", TEXT),
    "carrier_place_receipt": ("CarrierPlaceReceipt", TEXT),
    "carrier_place_delivery": ("CarrierPlaceDelivery", TEXT),
    "atd": ("ATD", TIME),
}
CONTAINER = {
    "container_number": ("ContianerNumber", TEXT),
    "manifest_no": ("ManifestNo", TEXT),
    "container_type": ("ContainerType", TEXT),
    "seal_number": ("SealNumber", TEXT),
    "piece_count": ("PieceCount", INT),
    "weight_kg": ("WeightKg", DEC),
    "cbm": ("CBM", DEC),
    "unit_measure_code": ("UnitMeasureCode", TEXT),
    "reefer_indicator": ("ReeferIndicator", BOOL),
    "dg_indicator": ("DGIndicator", BOOL),
}
HOUSE = {
    "hbl_number": ("HBLNumber", TEXT),
    "hbl_doc_number": ("HBLDocNumber", TEXT),
    "reference_number": ("ReferenceNumber", TEXT),
    "hbl_bl_type_code": ("HblBlTypeCode", TEXT),
    "shipper_code": ("ShipperCode", TEXT),
    "shipper_info": ("ShipperInfo", TEXT),
    "consignee_code": ("ConsigneeCode", TEXT),
    "consignee_info": ("ConsigneeInfo", TEXT),
    "notify_party_code": ("NotifyPartyCode", TEXT),
    "notify_info": ("NotifyInfo", TEXT),
    "hbl_booking_number": ("HBLBookingNumber", TEXT),
    "hbl_service_code": ("HBLServiceCode", TEXT),
    "incoterms": ("INCOTERMS", TEXT),
    "hbl_pay_type": ("HBLPayType", TEXT),
    "place_receipt_port_code": ("PlaceReceiptPortCode", TEXT),
    "place_receipt": ("PlaceReceipt", TEXT),
    "place_delivery_port_code": ("PlaceDeliveryPortCode", TEXT),
    "place_delivery": ("PlaceDelivery", TEXT),
    "country_origin_code": ("CountryOriginCode", TEXT),
    "ultimate_country_code": ("UltimateCountryCode", TEXT),
    "hbl_marking": ("HBLMarking", TEXT),
    "hbl_description": ("HBLDescription", TEXT),
    "hbl_total_package": ("HBLTotalPackage", INT),
    "unit_measure_code": ("UnitMeasureCode", TEXT),
    "hbl_weight_kg": ("HBLWeightKg", DEC),
    "hbl_cbm": ("HBLCBM", DEC),
    "hbl_packing": ("HBLPacking", TEXT),
    "telex_release_indicator": ("TelexReleaseIndicator", BOOL),
    "hbl_origin_agent_code": ("HBLOriginAgentCode", TEXT),
}
HOUSE_CONTAINER = {
    "master_container_number": ("MasterContianerNumber", TEXT),
    "package": ("Package", INT),
    "unit_measure_code": ("UnitMeasureCode", TEXT),
    "gross_weight": ("GrossWeight", DEC),
    "cbm": ("CBM", DEC),
}
PARTY = {
    "party_name": ("PartyName", TEXT),
    "address_line1": ("PartyAddress/AddressLine1", TEXT),
    "address_line2": ("PartyAddress/AddressLine2", TEXT),
    "city": ("PartyAddress/City", TEXT),
    "region": ("PartyAddress/Region", TEXT),
    "postal_code": ("PartyAddress/PostalCode", TEXT),
    "country_code": ("PartyAddress/CountryCode", TEXT),
    "country_name": ("PartyAddress/CountryName", TEXT),
    "contact_name": ("ContactPerson/ContactName", TEXT),
    "phone_area": ("ContactPerson/PhoneArea", TEXT),
    "phone": ("ContactPerson/Phone", TEXT),
    "fax_area": ("ContactPerson/FaxArea", TEXT),
    "fax": ("ContactPerson/Fax", TEXT),
    "mail": ("ContactPerson/Mail", TEXT),
}

#: Columns of each target table that come after ``message_id``.
TABLES = {
    "manifest_headers": HEADER,
    "master_shipments": MASTER,
    "routing_info": ROUTING,
    "containers": CONTAINER,
    "house_bills": HOUSE,
    "house_containers": {"hbl_number": ("HBLNumber", TEXT), **HOUSE_CONTAINER},
    "shipping_parties": PARTY,
}

_CORRUPT = "_malformed"

# Where the elements of each table stand in a message.
ELEMENTS = {
    "manifest_headers": ("Header",),
    "master_shipments": ("Master",),
    "routing_info": ("Master/Routing",),
    "containers": ("Master/Containers/Container",),
    "house_bills": ("Master/Houses/House",),
    "house_containers": ("Master/Houses/House/HouseContainers/HouseContainer",),
    "shipping_parties": (
        "Master/Houses/House/ShippingParties/ShippingParty",
        "Master/ShippingParties/ShippingParty",
        "ShippingParties/ShippingParty",
    ),
}
#: Tables with one row per message, whose columns take the first value found.
SINGLE = ("manifest_headers", "master_shipments", "routing_info")
MESSAGE_ID = "Header/MessageID"
HOUSE_NUMBER = "Master/Houses/House/HBLNumber"


def _leaves(tables: Iterable[str]) -> list[str]:
    """Paths of all values that the tables need."""
    paths = [MESSAGE_ID]
    for name in tables:
        spec = HOUSE_CONTAINER if name == "house_containers" else TABLES[name]
        paths += [f"{element}/{path}" for element in ELEMENTS[name] for path, _ in spec.values()]
        if name == "house_containers":
            paths.append(HOUSE_NUMBER)
    return list(dict.fromkeys(paths))


def message_schema(tables: Iterable[str] = TABLES) -> str:
    """DDL of a message cut to what the tables need; all values are lists of text."""
    tree: dict = {}
    for path in _leaves(tables):
        node = tree
        for tag in path.split("/"):
            node = node.setdefault(tag, {})

    def ddl(node: dict) -> str:
        return ", ".join(f"{tag}: array<{f'struct<{ddl(sub)}>' if sub else 'string'}>" for tag, sub in node.items())

    return f"struct<{ddl(tree)}, {_CORRUPT}: string>"


def _under(parents: Column, path: str) -> Column:
    """All elements, or values, that a path leads to from an array of elements."""
    for tag in path.split("/"):
        parents = F.flatten(F.filter(parents[tag], lambda x: x.isNotNull()))
    return parents


def _found(path: str) -> Column:
    """All elements, or values, at a path of the message; an empty array where there are none."""
    tag, _, rest = path.partition("/")
    top = F.col("msg")[tag]
    return F.coalesce(_under(top, rest) if rest else top, F.array())


def _texts(values: Column) -> Column:
    return F.filter(values, lambda x: x != "")


def _first(path: str) -> Column:
    return F.get(_texts(_found(path)), F.lit(0))


def _elements(name: str) -> Column:
    found = [_found(path) for path in ELEMENTS[name]]
    return F.concat(*found) if len(found) > 1 else found[0]


#: Comments, CDATA and processing instructions: tags in there open nothing.
NO_MARKUP = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>"


def _lost(text: Column, tags: list[str], kept: Column) -> Column:
    """Whether a text opens the tags, prefixed or not, outside comments, CDATA and processing instructions, another time than ``kept``.

    Each tag is searched by its fixed characters first, which skips most of a
    text and misses no opening tag. Where a text without markup has as many as
    were parsed, nothing is lost. Otherwise all places are looked at.
    """
    places = (rf"{tag}(?<=[<:]{tag})(?<!</[\w.-]{{1,99}}:{tag})[\s/>]" for tag in tags)
    at_most = sum((F.regexp_count(text, F.lit(place)) for place in places), F.lit(0))
    # most texts have nothing to take out but the first line
    markup = F.contains(text, F.lit("<!")) | F.contains(text, F.lit("<?"))
    clean = F.when(markup, F.regexp_replace(text, NO_MARKUP, ""))
    opened = F.regexp_count(F.coalesce(clean, text), F.lit(rf"<(?:[\w.-]++:)?+(?:{'|'.join(tags)})[\s/>]"))
    return F.when((at_most == kept) & ~markup, F.lit(False)).otherwise(opened != kept)


def parse_messages(df: DataFrame, xml_col: str = "xml_data", tables: Iterable[str] = TABLES) -> DataFrame:
    """Add ``msg``: the message as one nested struct, and ``_lost``: whether it has sections that are not in there.

    Only what ``tables`` need is parsed. ``_lost`` compares the opening tags
    of their elements in the text, outside comments, CDATA and processing
    instructions, with the elements parsed. The parse sits inside a generator:
    filters on its result cannot be pushed below it, which would parse every
    message a second time.
    """
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
        "ignoreNamespace": "true",
        "ignoreSurroundingSpaces": "false",
    }
    wanted = [t for t in TABLES if t in set(tables) | {"manifest_headers"}]
    parsed = df.withColumn("msg", F.explode(F.array(F.from_xml(xml_col, message_schema(tables), options))))
    tags = list(dict.fromkeys(ELEMENTS[t][0].rpartition("/")[2] for t in wanted))
    kept = sum((F.size(_elements(t)) for t in wanted), F.lit(0))
    return parsed.withColumn("_lost", _lost(F.col(xml_col), tags, kept))


def is_malformed() -> Column:
    """Whether a parsed message goes to quarantine; NULL without XML."""
    return F.col(f"msg.{_CORRUPT}").isNotNull() | F.col("_lost")


def marks(parsed: DataFrame) -> DataFrame:
    """Parsed messages cut to what ``split_malformed`` looks at: small enough to stage, so both sides come of one parse."""
    malformed = F.when(F.col(f"msg.{_CORRUPT}").isNotNull(), F.lit("")).alias(_CORRUPT)
    return parsed.withColumn("msg", F.when(F.col("msg").isNotNull(), F.struct(malformed)))


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages that parsed in full, and those to quarantine; rows without XML are in neither."""
    bad = is_malformed()
    return parsed.filter(F.col("msg").isNotNull() & ~bad), parsed.filter(bad).drop("msg", "_lost")


def _typed(c: Column, type_: str) -> Column:
    if type_ == TEXT:
        return F.when(c != "", c)
    if type_ == BOOL:
        return to_boolean(c)
    return F.trim(c).try_cast(type_)


def _value(element: Column, path: str) -> Column:
    """First value at a path of an element."""
    tag, _, rest = path.partition("/")
    values = element[tag]
    return F.get(_under(values, rest) if rest else values, F.lit(0))


def _values(element: Column, spec: Mapping[str, tuple[str, str]]) -> list[Column]:
    return [_value(element, path).alias(c) for c, (path, _) in spec.items()]


def _first_values(name: str) -> list[Column]:
    [element] = ELEMENTS[name]
    return [_first(f"{element}/{path}").alias(c) for c, (path, _) in TABLES[name].items()]


def values_shown(parsed: DataFrame, *kept: str) -> DataFrame:
    """Parsed messages cut to the values their tables show, one text each instead of a list; columns ``kept`` stay.

    ``good`` and ``bad`` tell the two sides of ``split_malformed``; the values are those of good messages. Small enough to
    stage: ``shred`` and ``cast_rejects`` read these rows like parsed messages.
    """
    bad = is_malformed()
    good = F.coalesce(F.col("msg").isNotNull() & ~bad, F.lit(False))

    def boxes(house: Column) -> Column:
        number = _value(house, "HBLNumber").alias("hbl_number")
        return F.transform(_under(house["HouseContainers"], "HouseContainer"), lambda x: F.struct(number, *_values(x, HOUSE_CONTAINER)))

    def rows(name: str) -> Column:
        if name in SINGLE:
            return F.struct(*_first_values(name))
        if name == "house_containers":
            return F.flatten(F.filter(F.transform(_elements("house_bills"), boxes), lambda x: x.isNotNull()))
        return F.transform(_elements(name), lambda x: F.struct(*_values(x, TABLES[name])))

    shown = {"_message_id": _first(MESSAGE_ID), **{name: rows(name) for name in TABLES}}
    flags = [good.alias("good"), F.coalesce(bad, F.lit(False)).alias("bad")]
    return parsed.select(*kept, *flags, *[F.when(good, c).alias(name) for name, c in shown.items()])


def _raw_table(good: DataFrame, name: str) -> DataFrame:
    """One target table with text columns, one row per message or per element."""
    if name in good.columns:
        if name in SINGLE:
            return good.select("_message_id", f"{name}.*")
        return good.select("_message_id", F.explode(name).alias("e")).select("_message_id", "e.*")
    message_id = _first(MESSAGE_ID).alias("_message_id")
    if name in SINGLE:
        return good.select(message_id, *_first_values(name))
    e = F.col("e")
    if name == "house_containers":
        rows = good.select(message_id, F.explode(_elements("house_bills")).alias("e"))
        boxes = _under(e["HouseContainers"], "HouseContainer")
        rows = rows.select("_message_id", _value(e, "HBLNumber").alias("hbl_number"), F.explode(boxes).alias("e"))
        return rows.select("_message_id", "hbl_number", *_values(e, HOUSE_CONTAINER))
    return good.select(message_id, F.explode(_elements(name)).alias("e")).select("_message_id", *_values(e, TABLES[name]))


def shred_table(good: DataFrame, name: str, as_of: datetime) -> DataFrame:
    """One typed target table of parsed messages."""
    key = [] if name == "manifest_headers" else [F.col("_message_id").alias("message_id")]
    return _raw_table(good, name).select(
        *key,
        *[_typed(F.col(c), ty).alias(c) for c, (_, ty) in TABLES[name].items()],
        F.lit(as_of).cast("timestamp_ntz").alias("processed_at"),
    )


def shred(good: DataFrame, as_of: datetime) -> dict[str, DataFrame]:
    """The seven typed tables of parsed messages."""
    return {name: shred_table(good, name, as_of) for name in TABLES}


def cast_rejects(good: DataFrame) -> DataFrame:
    """Values that are present but do not fit their column's type."""
    parts = []
    for name, spec in TABLES.items():
        tests = []
        for c, (_, ty) in spec.items():
            if ty != TEXT:
                lost = (F.trim(F.col(c)) != "") & _typed(F.col(c), ty).isNull()
                tests.append(F.when(lost, F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))))
        if tests:
            found = F.explode(F.array_compact(F.array(*tests))).alias("r")
            rows = _raw_table(good, name).select(F.col("_message_id").alias("message_id"), found)
            parts.append(rows.select("message_id", F.lit(name).alias("table"), "r.column", "r.value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- lists expanded side by side ----------------------------------------


def shred_scalar(good: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """First value at each path of parsed messages, NULL when there is none."""
    return good.select(*[_typed(_first(path), ty).alias(c) for c, (path, ty) in columns.items()])


def shred_lockstep(good: DataFrame, table: str, as_of: datetime) -> DataFrame:
    """Parallel value lists of a table of parsed messages, expanded side by side.

    Shorter lists end in NULL. Parties of houses come first, then those of
    masters, then those of the message.
    """
    spec = TABLES[table]

    def values(c: str, path: str) -> Column:
        if table == "house_containers" and c == "hbl_number":
            return _found(HOUSE_NUMBER)
        return F.concat(*[_found(f"{element}/{path}") for element in ELEMENTS[table]])

    lists = [_texts(values(c, path)).alias(c) for c, (path, _) in spec.items()]
    message_id = _first(MESSAGE_ID).alias("message_id")
    zipped = good.select(message_id, *lists).select("message_id", F.explode(F.arrays_zip(*spec)).alias("e"))
    stamp = F.lit(as_of).cast("timestamp_ntz").alias("processed_at")
    return zipped.select("message_id", *[_typed(F.col(f"e.{c}"), ty).alias(c) for c, (_, ty) in spec.items()], stamp)
