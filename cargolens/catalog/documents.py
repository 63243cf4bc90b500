"""Outbound documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from cargolens.catalog.registry import query
from cargolens.plans import documents as docs
from cargolens.plans import manifest as man
from cargolens.session import scratch_path
from cargolens.sources.bucketed import store

NOW = datetime(2001, 8, 1, 7, 5, 9)

# Invented addresses of the parties' systems.
ADDRESSES = "QK AAAXX00EXAMPLE\n.AAAXX01EXAMPLE/SIN01 090516"
AROUND = docs.Interchange("ICS*+ANSI1.1  SENDER           RECEIVER         2503270703000000001", "ICE*000001*000000001")
NAMESPACE, ACTION = "http://example.org/envelope", "urn:example:customs"

# ---- stand-ins -----------------------------------------------------------

_PARTIES = """
    select o_orderkey as shipment_header_id, 'SHIPPER ' || o_custkey as shipper_name,
           'CONSIGNEE ' || (o_custkey + 1) as consignee_name, o_custkey as shipper_address_id,
           o_custkey + 1 as consignee_address_id, case when o_orderkey % 2 = 0 then o_custkey + 2 end as notify_customer_1_id,
           case when o_orderkey % 2 = 0 then o_custkey + 2 end as notify_customer_1_address_id,
           case when o_orderkey % 5 = 0 then o_custkey + 3 end as notify_customer_2_id,
           case when o_orderkey % 7 = 0 then o_custkey + 3 end as notify_customer_2_address_id
    from {orders}"""
_ADDRESSES = """
    select c_custkey as id, cast(c_custkey as string) as building_no, c_mktsegment as street_name,
           case when c_custkey % 6 = 0 then null else 'CITY ' || c_nationkey end as city_name, 'PO' || c_custkey as po_box,
           case when c_custkey % 10 = 0 then null else 'STATE ' || (c_custkey % 9) end as state_name,
           cast(c_nationkey as bigint) as country_id
    from {customer}"""
_CARGO = """
    select o_orderkey as id, o_orderkey as shipment_header_id, 'GOODS ' || chr(10) || '  ' || (o_orderkey % 40) as commodity_description,
           'MARK  ' || o_custkey as marks_and_numbers, o_orderkey % 90 as no_of_pieces, o_custkey % 6 as pack_id,
           cast(o_orderkey % 700 as decimal(18,2)) + cast(0.25 as decimal(18,2)) as chargeable_unit, cast(o_totalprice as decimal(18,2)) as gross_weight_kgs,
           case when o_orderkey % 7 = 0 then 'Yes' else 'No' end as hazardous, 'Class' || (o_orderkey % 9) as imo_class,
           'UN' || o_orderkey as un_number, cast(o_orderkey % 100 as decimal(9,2)) as flash_point,
           case when o_orderkey % 2 = 0 then 'Celsius' end as temperature_code,
           case o_orderkey % 4 when 0 then 'Direct Delivery' when 1 then 'Storage in Sheds' when 2 then 'Storage in Yards' end as storage_code,
           'Yes' as refrigeration, cast(2.5 as decimal(9,2)) as minimum_temperature, cast(8 as decimal(9,2)) as maximum_temperature
    from {orders}"""

AIR = {
    "air_shipments": """
        select o_orderkey as id, lpad(cast(o_orderkey as string), 11, '0') as master_id, o_orderkey % 90 as no_of_pieces,
               cast(o_totalprice as decimal(18,2)) as gross_weight_kgs, 'HAWB' || o_orderkey as hbl_or_hawb_no,
               o_custkey % 25 as origin_id, o_custkey % 31 as destination_id, 'SHIPPER ' || o_custkey as shipper_name,
               case when o_orderkey % 99 = 0 then null else 'CONSIGNEE ' || o_custkey end as consignee_name
        from {orders} where o_orderkey % 20 <> 3""",
    "shipment_parties": _PARTIES,
    "party_addresses": _ADDRESSES,
    "shipment_cargo": """
        select l_orderkey || '-' || lpad(cast(l_linenumber as string), 3, '0') || '-' || l_partkey as id, l_orderkey as shipment_header_id,
               'PART ' || l_partkey as commodity_description
        from {lineitem}""",
    "references": "select o_orderkey as id from {orders}",
}

_BLOCK = """'/' || coalesce({0}.building_no, '') || ' ' || coalesce({0}.street_name, '') || ' ' || coalesce({0}.city_name, '') || ' '
    || coalesce({0}.po_box, '') || chr(10) || '/' || coalesce({0}.state_name, '') || chr(10) || '/' || {1}.code || chr(10)"""
_HEAD = " || chr(10) || ".join(f"'{x}'" for x in f"{ADDRESSES}\n{docs.AIR_FORMAT}".split("\n"))

query(
    "doc_air_house_list",
    f"""select r.id as doc_key, case when s.id is null then {_HEAD} || 'NO DATA FOUND FOR SHIPMENT ' || r.id else
        {_HEAD} || 'MBI/' || substr(s.master_id, 1, 3) || '-' || substr(s.master_id, 4) || '/T' || s.no_of_pieces || 'K' || s.gross_weight_kgs
        || chr(10) || 'HBS/' || s.hbl_or_hawb_no || '/' || coalesce(o.code, '') || coalesce(d.code, '') || '/' || s.no_of_pieces || '/K'
        || s.gross_weight_kgs || '//' || coalesce(g.goods, '') || chr(10) || 'SHP/' || s.shipper_name || chr(10) || {_BLOCK.format('a', 'ac')}
        || 'CNE/' || s.consignee_name || chr(10) || {_BLOCK.format('b', 'bc')} end as content
        from "references" r left join air_shipments s on s.id = r.id left join ports o on o.id = s.origin_id left join ports d on d.id = s.destination_id
        left join (select shipment_header_id, arg_min(commodity_description, id) as goods from shipment_cargo group by 1) g on g.shipment_header_id = r.id
        left join shipment_parties p on p.shipment_header_id = r.id
        left join party_addresses a on a.id = p.shipper_address_id left join countries ac on ac.id = a.country_id
        left join party_addresses b on b.id = p.consignee_address_id left join countries bc on bc.id = b.country_id""".replace('"references"', "refs"),
    {**{k: v for k, v in AIR.items() if k != "references"}, "refs": AIR["references"]},
)(lambda t: docs.air_house_list(t, ADDRESSES, t["refs"]))

# ---- 530 -----------------------------------------------------------------

MESSAGE_530 = {
    "finance_documents": """
        select o_orderkey as did, 'CO' || (o_custkey % 12) as company_code, 'B' || (o_custkey % 2) as branch_code,
               cast('40051' as string) as location_code, 'DB' as daybook_code, cast(o_orderkey as string) as document_no,
               o_orderkey as job_uid, case when o_orderkey % 4 = 0 then null else o_orderkey end as subjob_uid
        from {orders}""",
    "partners_530": """
        select 'CO' || n_nationkey as company_code, 'B' || (n_nationkey % 2) as branch_code, cast('40051' as string) as location_code,
               'SND' || (n_nationkey % 3) as sender_code, 'RCV' || (n_nationkey % 2) as receiver_code, 'SPEC' as route_code_origin,
               case when n_nationkey % 4 = 0 then null else 'AUTH' end as route_code_destination, 'IN' as sftp_type
        from {nation} where n_nationkey <> 5""",
    "jobs": """
        select o_orderkey as job_uid, 'MST' || o_orderkey as master_no, 'P' || (o_custkey % 25) as pol, 'P' || (o_orderkey % 25) as pod,
               o_orderkey % 90 as no_of_pack
        from {orders}""",
    "subjobs": "select o_orderkey as subjob_uid, o_orderdate + interval '7' hour as pickup_date from {orders}",
    "codes": """
        select 'EDI_530' as document, 'PORT_MASTER' as master, 'P' || n_nationkey as code, cast(998205000 + n_nationkey as string) as edi_code
        from {nation} where n_nationkey % 5 <> 4""",
}

_TX = """'ST*530*' || {0} || chr(10) || 'BV3*' || p.sender_code || '*' || coalesce(a.edi_code, '') || '*BK*' || d.daybook_code || '-' || d.document_no
    || '*' || j.no_of_pack || '*' || coalesce(strftime(s.pickup_date, '%y%m%d'), '') || '*' || coalesce(strftime(s.pickup_date, '%H%M'), '') || '**'
    || j.master_no || '***' || coalesce(b.edi_code, '') || chr(10) || 'VI**' || p.route_code_origin || '*' || coalesce(p.route_code_destination, '')
    || '*******' || chr(10) || 'SE*4*' || {0}"""
_GS = "'GS*VI*' || {0}.sender_code || '*' || {0}.receiver_code || '*010801*0705*' || {1} || '*T*1'"
_FROM_530 = """from finance_documents d join partners_530 p on p.company_code = d.company_code and p.branch_code = d.branch_code
    and p.location_code = d.location_code left join jobs j on j.job_uid = d.job_uid left join subjobs s on s.subjob_uid = d.subjob_uid
    left join codes a on a.code = j.pol left join codes b on b.code = j.pod"""

query(
    "doc_530",
    f"""select did as doc_key, '{AROUND.opening}' || chr(10) || {_GS.format('x', 'seq')} || chr(10) || tx || chr(10) || 'GE*1*' || seq
          || chr(10) || '{AROUND.closing}' as content
        from (select d.did, p.sender_code, p.receiver_code, row_number() over (order by d.did) as seq, {_TX.format("'000000001'")} as tx {_FROM_530}) x""",
    MESSAGE_530,
)(lambda t: docs.message_530(t, NOW, AROUND)[0].select("doc_key", "content"))

query(
    "doc_530_rejects",
    """select did from finance_documents d where not exists (select 1 from partners_530 p where p.company_code = d.company_code
         and p.branch_code = d.branch_code and p.location_code = d.location_code and p.sftp_type = 'IN')""",
    MESSAGE_530,
)(lambda t: docs.message_530(t, NOW, AROUND)[1].select("did"))

query(
    "doc_530_batched",
    f"""with x as (select *, sender_code || '/' || receiver_code as doc_key, row_number() over (partition by sender_code, receiver_code order by did) as no
            from (select d.did, p.sender_code, p.receiver_code, {_TX.format("'#'")} as tx {_FROM_530})),
          z as (select doc_key, sender_code, receiver_code, count(*) as n, row_number() over (order by doc_key) as seq from x group by 1, 2, 3),
          l as (select doc_key, no, replace(tx, '#', case when no < 10000 then lpad(cast(no as string), 4, '0') else cast(no as string) end) as line from x
            union all select doc_key, 0, '{AROUND.opening}' || chr(10) || {_GS.format('z', 'seq')} from z
            union all select doc_key, n + 1, 'GE*' || n || '*' || seq || chr(10) || '{AROUND.closing}' from z)
        select doc_key, cast(no as bigint) as pos, line from l""",
    MESSAGE_530,
)(lambda t: docs.message_530_batched(t, NOW, AROUND)[0])

# ---- customs XML ---------------------------------------------------------

CUSTOMS = {
    "subjobs": """
        select o_orderkey as subjob_uid, 'CO' || (o_custkey % 30) as company_code, 'BR' || (o_custkey % 3) as branch_code,
               'LO' || (o_custkey % 2) as location_code, 'P' || (o_custkey % 25) as pol, 'P' || (o_orderkey % 25) as pod,
               'HB' || o_orderkey as house_no, o_custkey as consignee_code, 'CON & <' || o_custkey || '>' as consignee_manifest_name,
               o_custkey + 1 as shipper_code, 'SHIP ' || o_custkey as shipper_manifest_name,
               case when o_orderkey % 3 = 0 then null else 'MARK' || o_orderkey end as mark_no, 'CT' as external_pack_code,
               'GOODS ' || (o_orderkey % 40) as commodity_description
        from {orders}""",
    "subjob_tree": "select o_orderkey as subjob_uid, -o_orderkey as job_uid from {orders}",
    "jobs": "select -o_orderkey as job_uid, 'MST' || o_orderkey as master_no, 'BK' || o_orderkey as carrier_booking_no from {orders}",
    "partners_customs": """
        select 'CO' || n_nationkey as company_code, 'IN' as branch_code, '40051' as location_code, 'SND' || n_nationkey as sender_code,
               'RCV' || n_nationkey as receiver_code, 'F15' as document_type, 'LRN' || n_nationkey as lrn, 'DE' as member_country,
               'DECLARANT' as declarant_name, 'ID' || n_nationkey as declarant_id, 'TOWN' as declarant_city, 'DE' as declarant_country,
               'STREET & CO' as declarant_street, '12345' as declarant_postcode, cast(null as string) as declarant_number,
               'd@example.com' as declarant_email, 'IN' as sftp_type
        from {nation}""",
    "job_containers": """
        select l_orderkey as job_uid, l_linenumber as container_uid, 'S' as segment_code, 1 as job_no,
               'K' || (min(l_partkey) % 5) as container_code, 'CN' || min(l_partkey) as container_no,
               case when l_linenumber % 2 = 0 then 'SEAL' || min(l_suppkey) end as actual_seal
        from {lineitem} group by l_orderkey, l_linenumber""",
    "subjob_containers": """
        select l_orderkey as job_uid, l_linenumber as container_uid, 'S' as segment_code, 1 as job_no, l_orderkey as subjob_uid,
               cast(sum(l_quantity) as bigint) as external_no_of_pack, sum(cast(l_discount * 7 as decimal(18,3))) as gross_weight,
               cast(1.5 as decimal(9,3)) as volume
        from {lineitem} group by l_orderkey, l_linenumber""",
    "customer_addresses": """
        select c_custkey as customer_code, case when c_custkey % 3 = 0 then 'BILLING' else 'PRIMARY' end as address_type,
               'CITY ' || c_nationkey as city, 'C' || c_nationkey as country_code, c_mktsegment || ' & SONS' as address,
               'Z' || c_custkey as zip_code, 'T' || c_custkey as mobile_no
        from {customer}""",
    "codes": """
        select 'EDI_ICS2' as document, 'CONTAINER_MASTER' as master, 'K' || r_regionkey as code, '4' || r_regionkey as edi_code
        from {region} where r_regionkey < 4""",
}

NL = "chr(10)"


def _esc(e: str) -> str:
    return f"replace(replace(replace(coalesce(cast({e} as string), ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _xel(tag: str, e: str) -> str:
    return f"'<{tag}>' || {_esc(e)} || '</{tag}>' || {NL}"


def _xgroup(tag: str, *children: str) -> str:
    return f"'<{tag}>' || {NL} || {' || '.join(children)} || '</{tag}>' || {NL}"


def _xaddress(a: str, extra: bool = False) -> str:
    parts = [_xel("city", f"{a}.city"), _xel("country", f"{a}.country_code"), _xel("street", f"{a}.address"), _xel("postCode", f"{a}.zip_code")]
    if extra:
        parts.append(_xel("streetAdditionalLine", "''"))
    return _xgroup("Address", *parts, _xel("number", f"{a}.mobile_no"))


def _xparty(tag: str, name: str, a: str, number: str | None = None, extra: bool = False) -> str:
    parts = [_xel("name", name)]
    if number:
        parts.append(_xel("identificationNumber", number))
    return _xgroup(tag, *parts, _xel("typeOfPerson", "'2'"), _xaddress(a, extra))


def _three(e: str) -> str:
    text = f"cast(cast({e} as decimal(18,3)) as string)"
    return f"case when left({text}, 2) = '0.' then substr({text}, 2) else {text} end"


def _text(*lines: str) -> str:
    return " || ".join(f"'{x}' || {NL}" for x in lines)


_ITEM = _xgroup(
    "GoodsItem",
    _xel("goodsItemNumber", "i.no"),
    _xgroup(
        "Commodity",
        _xel("descriptionOfGoods", "h.commodity_description"),
        _xgroup("CommodityCode", _xel("harmonizedSystemSubHeadingCode", "''")),
        _xgroup("DangerousGoods", _xel("unNumber", "''")),
    ),
    _xgroup("Weight", _xel("grossMass", _three("i.gross_weight"))),
    _xgroup("Packaging", _xel("shippingMarks", "h.mark_no"), _xel("numberOfPackages", "i.external_no_of_pack"), _xel("typeOfPackages", "h.external_pack_code")),
    _xgroup(
        "TransportEquipment",
        _xel("containerSizeAndType", "k.edi_code"),
        _xel("containerPackedStatus", "'B'"),
        _xel("containerSupplierType", "'2'"),
        _xel("containerIdentificationNumber", "i.container_no"),
        _xel("numberOfSeals", "'1'"),
        _xgroup("Seal", _xel("identifier", "i.actual_seal")),
    ),
)
_ENVELOPE = " || chr(10) || ".join(f"'{x}'" for x in docs.ENVELOPE.format(NAMESPACE).split("\n"))
_XML = " || ".join(
    [
        _ENVELOPE,
        _text("<S:Header>"),
        f"'<wsa:From><wsa:Address>urn:scac:' || {_esc('p.sender_code')} || '</wsa:Address></wsa:From>' || {NL}",
        f"'<wsa:To>urn:zz:' || {_esc('p.receiver_code')} || '</wsa:To>' || {NL}",
        _text(f"<wsa:Action>{ACTION}</wsa:Action>", "<ebi:TestIndicator>T</ebi:TestIndicator>", "</S:Header>", "<S:Body>", "<SMFENS2>"),
        _xgroup("SMFAPI", _xel("senderID", "p.sender_code"), _xel("recipientID", "p.receiver_code"), _xel("docType", "p.document_type")),
        _text("<SMFENS2FilingBody>"),
        _xel("LRN", "p.lrn || '-20010801-' || p.document_type || '-001'"),
        _xel("documentIssueDate", "'2001-08-01T07:05:09.0000000Z'"),
        _xel("specificCircumstanceIndicator", "p.document_type"),
        _xgroup("AddressedMemberState", _xel("country", "p.member_country")),
        _xel("SplitConsignment", "''"),
        _xgroup("ActiveBorderTransportMeans", _xel("modeOfTransport", "'1'")),
        _text("<ConsignmentMasterLevel>", "<ConsignmentHouseLevel>"),
        _xel("containerIndicator", "'1'"),
        _xel("totalGrossMass", _three("w.mass")),
        _xgroup("PlaceOfAcceptance", _xel("unlocode", "h.pol")),
        _xgroup("TransportDocumentMasterLevel", _xel("documentNumber", "j.master_no"), _xel("type", "'N704'")),
        _xgroup("Carrier", _xel("identificationNumber", "j.carrier_booking_no")),
        _xparty("Consignee", "h.consignee_manifest_name", "ca"),
        "coalesce(w.items, '')",
        _xparty("Consignor", "h.shipper_manifest_name", "sa", extra=True),
        _xgroup("TransportCharges", _xel("methodOfPayment", "'A'")),
        _xgroup("PlaceOfDelivery", _xel("unlocode", "h.pod")),
        _xgroup(
            "GoodsShipment",
            _xparty("Buyer", "h.consignee_manifest_name", "ca", number="h.consignee_code"),
            _xparty("Seller", "h.shipper_manifest_name", "sa"),
        ),
        _xgroup("CountriesOfRoutingOfConsignment", _xel("sequenceNumber", "'1'"), _xel("country", "pl.country_code")),
        _xgroup("CountriesOfRoutingOfConsignment", _xel("sequenceNumber", "'2'"), _xel("country", "pd.country_code")),
        _xgroup("TransportDocumentHouseLevel", _xel("documentNumber", "h.house_no"), _xel("type", "'N714'")),
        _text("</ConsignmentHouseLevel>", "</ConsignmentMasterLevel>"),
        _xgroup(
            "Declarant",
            _xel("name", "p.declarant_name"),
            _xel("identificationNumber", "p.declarant_id"),
            _xgroup(
                "Address",
                _xel("city", "p.declarant_city"),
                _xel("country", "p.declarant_country"),
                _xel("street", "p.declarant_street"),
                _xel("postCode", "p.declarant_postcode"),
                _xel("number", "p.declarant_number"),
            ),
            _xgroup("Communication", _xel("identifier", "p.declarant_email"), _xel("type", "'EM'")),
        ),
        _text("</SMFENS2FilingBody>", "</SMFENS2>", "</S:Body>"),
        "'</S:Envelope>'",
    ]
)

query(
    "doc_customs_xml",
    f"""with i as (select s.subjob_uid, s.gross_weight, s.external_no_of_pack, c.container_code, c.container_no, c.actual_seal,
              row_number() over (partition by s.subjob_uid order by c.container_code nulls first, c.container_no nulls first, c.actual_seal nulls first,
                s.external_no_of_pack, s.gross_weight, s.volume, s.job_uid, s.container_uid) as no
            from subjob_containers s join job_containers c on c.job_uid = s.job_uid and c.container_uid = s.container_uid
              and c.segment_code = s.segment_code and c.job_no = s.job_no),
        w as (select i.subjob_uid, sum(coalesce(i.gross_weight, 0)) as mass, string_agg({_ITEM}, '' order by i.no) as items
              from i join subjobs h on h.subjob_uid = i.subjob_uid left join codes k on k.code = i.container_code group by 1)
        select h.subjob_uid as doc_key, h.company_code, h.branch_code, h.location_code, {_XML} as content
        from subjobs h join subjob_tree st on st.subjob_uid = h.subjob_uid join jobs j on j.job_uid = st.job_uid
        join partners_customs p on p.company_code = h.company_code left join w on w.subjob_uid = h.subjob_uid
        left join customer_addresses ca on ca.customer_code = h.consignee_code and ca.address_type = 'PRIMARY'
        left join customer_addresses sa on sa.customer_code = h.shipper_code and sa.address_type = 'PRIMARY'
        left join ports pl on pl.code = h.pol left join ports pd on pd.code = h.pod""",
    CUSTOMS,
)(lambda t: docs.customs_xml(t, NOW, NAMESPACE, ACTION)[0])

# ---- sea manifest --------------------------------------------------------

MANIFEST = {
    "masters": """
        select c_custkey as id, 'MAS' || c_custkey as master_uid, date '2001-08-10' + cast(c_custkey % 20 as int) as eta,
               case when c_custkey % 8 = 0 then 'SEA' else 'SEA (' || c_mktsegment || ')' end as service,
               case c_mktsegment when 'BUILDING' then 'FCL CONTAINER' when 'MACHINERY' then 'LCL CONTAINER'
                    when 'AUTOMOBILE' then 'RO-RO UNIT' else c_mktsegment end as service_code,
               cast(c_nationkey as bigint) as destination_id
        from {customer}""",
    "master_carriers": """
        select c_custkey as master_id, 'VESSEL ' || (c_custkey % 30) as vessel_name,
               case when c_custkey % 11 = 0 then null else 'V' || c_custkey end as route_no
        from {customer}""",
    "master_customs": """
        select c_custkey as master_id, case when c_custkey % 3 = 0 then null else 'ROT' || (c_custkey % 7) end as rotation_no
        from {customer} where c_custkey % 13 <> 0""",
    "instalments": """
        select 'MAS' || c_custkey as master_uid, 'ROT' || (c_custkey % 7) as rotation_no, c_custkey % 5 + 1 as instalment_no
        from {customer} where c_custkey % 4 = 0""",
    "master_service_links": "select o_custkey as master_id, o_orderkey as shipment_service_id from {orders}",
    "air_documents": "select o_orderkey as source_id, 'AIR' || o_orderkey as document_no from {orders} where o_orderkey % 3 = 0",
    "ocean_documents": "select o_orderkey as source_id, 'OBL' || o_orderkey as document_no from {orders} where o_orderkey % 3 = 1",
    "shipment_extras": """
        select o_orderkey as shipment_header_id, 'ADD' || o_orderkey as transport_document_no from {orders} where o_orderkey % 50 <> 2""",
    "shipment_parties": _PARTIES,
    "party_addresses": _ADDRESSES,
    # Some shipments have a second cargo row with other marks.
    "shipment_cargo": f"""
        {_CARGO} union all
        select id + 1 - 1, shipment_header_id, commodity_description, marks_and_numbers || ' MORE', no_of_pieces, pack_id, chargeable_unit,
               gross_weight_kgs, hazardous, imo_class, un_number, flash_point, temperature_code, storage_code, refrigeration,
               minimum_temperature, maximum_temperature
        from ({_CARGO}) x where id % 17 = 0""".replace("id + 1 - 1", "-id - 1"),
    "shipment_containers": """
        select l_orderkey || '-' || l_linenumber as id, l_orderkey as shipment_id, l_orderkey || '-' || l_linenumber as master_container_id,
               'CNTU' || lpad(cast(min(l_partkey) as string), 6, '0') || (l_linenumber % 10) as container_sl_no,
               case when l_linenumber % 5 = 0 then null else cast(sum(l_quantity) as bigint) end as external_no_of_piece,
               sum(cast(l_extendedprice as decimal(18,2))) as gross_weight_kgs, sum(cast(l_quantity / 10 as decimal(9,3))) as volume_in_cbm
        from {lineitem} group by l_orderkey, l_linenumber""",
    "master_containers": """
        select l_orderkey || '-' || l_linenumber as id, min(o_custkey) as master_id, min(l_partkey) as container_id,
               'SEAL / ' || min(l_suppkey) as actual_seal_number
        from {lineitem} join {orders} on o_orderkey = l_orderkey group by l_orderkey, l_linenumber""",
    "config_headers": """
        select s_suppkey as id, case s_suppkey when 3 then 'LINE_CODE' when 5 then 'AGENT_CODE' else 'KEY' || s_suppkey end as config_key
        from {supplier}""",
    "config_values": "select s_suppkey as config_header_id, 'L' || s_nationkey as config_value from {supplier} where s_suppkey <> 5",
}


def _fields(tag: str, *cols: str) -> str:
    return f"""'{tag},"' || """ + """ || '","' || """.join(cols) + """ || '"'"""


def _z(e: str) -> str:
    return f"coalesce(cast({e} as string), '')"


_CONFIG = "coalesce((select min(v.config_value) from config_headers h left join config_values v on v.config_header_id = h.id where h.config_key = '{}'), '')"
_LINE, _AGENT = _CONFIG.format("LINE_CODE"), _CONFIG.format("AGENT_CODE")
_VOYAGE = """voyage as (select m.id, c.vessel_name, c.route_no, p.code as port_code, m.eta, u.rotation_no,
      nullif(regexp_extract(m.service, '\\(([^)]+)\\)', 1), '') as service,
      case m.service_code when 'FCL CONTAINER' then 'F' when 'LCL CONTAINER' then 'L' when 'RO-RO UNIT' then 'R' end as cargo_code
    from masters m join master_carriers c on c.master_id = m.id join master_customs u on u.master_id = m.id join ports p on p.id = m.destination_id)"""
_VOY = "voy as (select m.id as master_id, m.master_uid, " + _fields(
    "VOY", _LINE, _AGENT, _z("v.vessel_name"), "v.route_no", "v.port_code", "strftime(v.eta, '%d-%b-%Y')", _z("v.rotation_no"), "'MFI'",
    "cast(coalesce(i.instalment_no, 1) as string)", "lpad(cast(row_number() over (order by m.id) as string), 5, '0')",
) + """ as line from masters m left join voyage v on v.id = m.id
    left join instalments i on i.master_uid = m.master_uid and i.rotation_no = v.rotation_no)"""  # fmt: skip

_ADDRESS = "(select {0} from party_addresses a left join countries k on k.id = a.country_id where a.id = p.{1})"
_FULL = "coalesce(a.building_no, '') || ',' || coalesce(a.street_name, '') || ',' || coalesce(a.city_name, '') || ',' || coalesce(a.state_name, '') || ',' || coalesce(k.name, '') || ',' || coalesce(a.po_box, '')"


def _addr(role: str, value: str = _FULL) -> str:
    return _ADDRESS.format(value, role)


def _detail_sql(carried: bool) -> str:
    def carry(test: str, value: str) -> str:
        if not carried:
            return f"case when {test} then {value} end"
        # the last shipment up to this one for which the block was set
        return f"""(last_value(case when {test} then {{'v': {value}}} end ignore nulls)
            over (partition by master_id order by shipment_id rows between unbounded preceding and current row))['v']"""

    transit, lcl, dg = "coalesce(left(trade, 1) = 'T', false)", "container_service = 'LCL'", "hazardous = 'Y'"
    unit = "left(temperature_code, 1)"
    storage = "case storage_code when 'Direct Delivery' then 'D' when 'Storage in Sheds' then 'S' when 'Storage in Yards' then 'Y' else '' end"
    return f"""
      pairs as (select distinct l.master_id, s.shipment_header_id as shipment_id from master_service_links l
                join shipment_services s on s.id = l.shipment_service_id join shipments h on h.id = s.shipment_header_id),
      svc as (select shipment_header_id, arg_min({{'o': other_trade, 's': service_trade}}, id) as x from shipment_services group by 1),
      cargo as (select * from shipment_cargo qualify row_number() over (partition by shipment_header_id order by id) = 1),
      boxes as (select c.*, m.master_id, m.actual_seal_number, k.teu, coalesce(cast(nullif(trim(k.empty_tare_weight), '') as decimal(18,3)), 0) as tare
                from shipment_containers c join master_containers m on m.id = c.master_container_id join container_types k on k.id = m.container_id),
      sums as (select master_id, shipment_id, cast(sum(cast(teu as decimal(18,3))) as decimal(18,0)) as teu,
                 cast((cast(sum(tare) * 1000 as bigint) + 50000) // 100000 / 10.0 as decimal(18,1)) as tare from boxes group by 1, 2),
      counts as (select shipment_id, count(*) as boxes, arg_min(container_sl_no, id) as box from shipment_containers group by 1),
      raw as (select q.master_id, q.shipment_id, h.service_type as container_service,
          case when case when v.x.o = 'ReExport' then 'Import' else v.x.o end = 'Transit' then 'Transit' else v.x.s end as trade,
          regexp_replace(g.marks_and_numbers, '\\s+', ' ', 'g') as marks, regexp_replace(g.commodity_description, '\\s+', ' ', 'g') as commodity,
          g.no_of_pieces as pieces, pk.name as pack_name, pk.code as pack_code, cast(g.chargeable_unit as decimal(9,3)) as volume,
          cast(g.gross_weight_kgs as decimal(9,3)) as gross, case when g.hazardous = 'Yes' then 'Y' else 'N' end as hazardous,
          g.imo_class, g.un_number, g.flash_point, g.temperature_code, g.storage_code, g.refrigeration, g.minimum_temperature, g.maximum_temperature,
          coalesce(ad.document_no, od.document_no, ex.transport_document_no) as bill_no, p.shipper_name, p.consignee_name,
          {_addr('shipper_address_id')} as shipper_address, {_addr('shipper_address_id', 'k.code')} as shipper_country,
          {_addr('consignee_address_id')} as consignee_address, n1.name as notify1_name, {_addr('notify_customer_1_address_id')} as notify1_address,
          n2.name as notify2_name, {_addr('notify_customer_2_address_id')} as notify2_address, po.code as origin_code, po.country_code as origin_country,
          pd.code as discharge_code, coalesce(ct.boxes, 0) as box_count, ct.box, su.teu, su.tare,
          case sv.transport_mode when 'Ocean' then 'S' when 'Air' then 'A' when 'Road' then 'R' end as mode
        from pairs q join shipments h on h.id = q.shipment_id left join svc v on v.shipment_header_id = q.shipment_id
        left join cargo g on g.shipment_header_id = q.shipment_id left join packs pk on pk.id = g.pack_id
        left join air_documents ad on ad.source_id = q.shipment_id left join ocean_documents od on od.source_id = q.shipment_id
        left join shipment_extras ex on ex.shipment_header_id = q.shipment_id left join shipment_parties p on p.shipment_header_id = q.shipment_id
        left join customers n1 on n1.id = p.notify_customer_1_id left join customers n2 on n2.id = p.notify_customer_2_id
        left join ports po on po.id = h.origin_id left join ports pd on pd.id = h.destination_id
        left join counts ct on ct.shipment_id = q.shipment_id left join sums su on su.master_id = q.master_id and su.shipment_id = q.shipment_id
        left join services sv on sv.code = h.service_type),
      det as (select *, {carry(transit, 'mode')} as c_mode, {carry(lcl, 'box')} as c_box, {carry(lcl, 'right(box, 1)')} as c_digit,
          {carry(lcl, 'cast((cast(gross * 1000 as bigint) + 500) // 1000 / 1000.0 as decimal(9,3))')} as c_tonnes, {carry(f'not {lcl}', 'box_count')} as c_boxes, {carry(f'not {lcl}', 'teu')} as c_teu,
          {carry(f'not {lcl}', 'tare')} as c_tare, {carry(dg, 'left(imo_class, 3)')} as d_imo, {carry(dg, 'left(un_number, 5)')} as d_un,
          {carry(dg, 'cast(flash_point as decimal(5,1))')} as d_flash, {carry(dg, unit)} as d_unit, {carry(dg, storage)} as d_storage,
          {carry(dg, 'left(refrigeration, 1)')} as d_ref, {carry(dg, 'cast(minimum_temperature as decimal(5,1))')} as d_min,
          {carry(dg, 'cast(maximum_temperature as decimal(5,1))')} as d_max from raw)"""


_E = "''"
_BOL = "bol as (select d.master_id, d.shipment_id, " + _fields(
    "BOL", "d.bill_no", _LINE, _AGENT, "d.origin_code", "d.origin_code", "d.discharge_code", "d.discharge_code", _E, _E,
    _z("left(d.trade, 1)"), _z("d.c_mode"), _E, _E, _z("v.cargo_code"), "case when d.container_service = 'LCL' then 'Y' else 'N' end", _E,
    _z("v.service"), _z("d.origin_country"), *[_E] * 7, _z("d.shipper_name"), _z("d.shipper_address"), _z("d.shipper_country"),
    "case when left(d.trade, 1) = 'T' then 'T9999' else 'D9999' end", _z("d.consignee_name"), _z("d.consignee_address"), _E, _z("d.notify1_name"),
    _z("d.notify1_address"), _E, _z("d.notify2_name"), _z("d.notify2_address"), _E, _E, _E, _z("d.marks"), "'770000'", _z("d.commodity"), _z("d.pieces"),
    _z("d.pack_name"), _z("d.pack_code"), _z("d.c_box"), _z("d.c_digit"), _z("d.c_boxes"), _z("d.c_teu"), _z("d.c_tare"), _z("d.gross"), _z("d.gross"),
    _z("d.volume"), _z("d.pieces"), _z("d.c_tonnes"), _z("d.pieces"), _E, _E, _E,
) + " as line from det d left join voyage v on v.id = d.master_id)"
_GROUPED = """grouped as (select b.master_id, b.shipment_id, substr(b.container_sl_no, 1, length(b.container_sl_no) - 1) as ctr, right(b.container_sl_no, 1) as digit,
      regexp_replace(g.marks_and_numbers, '\\s+', ' ', 'g') as marks, regexp_replace(g.commodity_description, '\\s+', ' ', 'g') as commodity,
      b.external_no_of_piece as pieces, b.gross_weight_kgs as gross, b.volume_in_cbm as volume, b.actual_seal_number as seal, sum(b.tare) as tare
    from boxes b left join shipment_cargo g on g.shipment_header_id = b.shipment_id group by all),
  numbered as (select *, row_number() over (partition by master_id, shipment_id order by digit, ctr, pieces nulls first, gross, volume, seal, marks, commodity) as sr_no from grouped)"""
_CON = "con as (select n.master_id, n.shipment_id, n.sr_no, " + _fields(
    "CON", "cast(n.sr_no as string)", _z("n.marks"), _z("n.commodity"), _E, "'770000'", _z("n.pieces"), _z("d.pack_name"), _z("d.pack_code"), _z("n.pieces"),
    _z("cast(round(n.gross, 0) as decimal(18,0))"), _z("n.volume"), _z("d.hazardous"), _z("d.d_imo"), _z("d.d_un"), _z("d.d_flash"), _z("d.d_unit"),
    _z("d.d_storage"), _z("d.d_ref"), _z("d.d_min"), _z("d.d_max"), _z("d.d_unit"),
) + " || chr(10) || " + _fields("CTR", "n.ctr", "n.digit", _z("cast(n.tare as decimal(18,1))"), _z("n.seal")) + """ as line
    from numbered n join det d on d.master_id = n.master_id and d.shipment_id = n.shipment_id)"""  # fmt: skip
_END = (
    "fin as (select m.id as master_id, "
    + _fields("END", _z("count(*) filter (d.box_count > 0)"), _z("count(*) filter (d.box_count = 0)"), f"'{man.END_REMARK}'")
    + " as line from masters m left join det d on d.master_id = m.id group by 1)"
)


def _manifest_sql(select: str, carried: bool = False) -> str:
    return f"with {', '.join([_VOYAGE, _VOY, _detail_sql(carried), _BOL, _GROUPED, _CON, _END])} {select}"


_WHOLE = """, lines as (
    select master_id, 0 as sec, 0 as ship, 0 as no, line from voy union all select master_id, 1, shipment_id, 0, line from bol
    union all select master_id, 1, shipment_id, sr_no, line from con union all select master_id, 2, 0, 0, line from fin)
  select m.master_uid as doc_key,
    case when not bool_or(l.line is null) then string_agg(l.line, chr(10) order by l.sec, l.ship, l.no) end as content
  from lines l join masters m on m.id = l.master_id group by 1"""


def _whole(carried: bool) -> str:
    return _manifest_sql("", carried).rstrip() + _WHOLE


query("doc_manifest_voy", _manifest_sql("select master_id, master_uid, line from voy"), MANIFEST)(lambda t: man.voy_lines(t))
query("doc_manifest_bol", _manifest_sql("select master_id, shipment_id, line from bol"), MANIFEST)(
    lambda t: man.bol_lines(t, man.shipment_details(t, dangerous=False))
)


@query("doc_manifest_bol_bucketed", _manifest_sql("select master_id, shipment_id, line from bol"), MANIFEST)
def _(t):
    """The same from child tables kept in buckets of their shipment."""
    folder = scratch_path(t.spark, "shipments")
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    kept = store(t, man.CHILDREN, f"{folder.rpartition('/')[2].replace('-', '_')}_", buckets, folder)
    return man.bol_lines(kept, man.shipment_details(kept, dangerous=False))


query("doc_manifest_con_ctr", _manifest_sql("select master_id, shipment_id, sr_no, line from con"), MANIFEST)(
    lambda t: man.container_lines(t, man.container_details(t))
)
query("doc_manifest_end", _manifest_sql("select master_id, line from fin"), MANIFEST)(
    lambda t: man.end_lines(t, man.box_counts(t))
)
query("doc_manifest", _whole(False), MANIFEST)(lambda t: man.manifest(t))
query("doc_manifest_carried", _whole(True), MANIFEST)(lambda t: man.manifest(t, carry="reference"))
query(
    "doc_manifest_counters",
    f"""with {_VOYAGE}, s as (select m.master_uid, v.rotation_no from masters m left join voyage v on v.id = m.id)
        select coalesce(i.master_uid, s.master_uid) as master_uid, coalesce(i.rotation_no, s.rotation_no) as rotation_no,
          cast(case when s.master_uid is null then i.instalment_no else coalesce(i.instalment_no, 0) + 1 end as bigint) as instalment_no
        from instalments i full join s on s.master_uid = i.master_uid and s.rotation_no = i.rotation_no""",
    MANIFEST,
)(lambda t: man.manifest_counters(t).withColumn("instalment_no", F.col("instalment_no").cast("long")))
