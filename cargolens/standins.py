"""Freight tables derived from the shared test tables.

Each entry is a projection or grouping written in SQL that Spark and DuckDB
read alike; base tables stand in braces. Spark runs the text over the parquet
tables; the oracle uses it as a common table expression. The freight operators
themselves never see the base tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

#: Fixed "today" of all registered queries.
AS_OF = date(2001, 8, 1)

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_LINE_ID = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"
_SERVICE = "case when o_orderpriority < '3' then 'LCL' else 'FCL' end"

TABLES: dict[str, str] = {
    "inbound_files": """
        select event_id as id, event_type as source, ts as received_at,
               case when value < 8 then 'Error' when value < 30 then 'Completed' else 'pending' end as status,
               upper(event_type) || '_' || event_id || '.XML' as file_name,
               case when event_id % 3 = 0 then props end as json_data,
               case when event_id % 3 = 1 then '<r><k>' || event_id || '</k></r>' end as xml_data,
               case when event_id % 3 = 2 then 'UNB+' || event_id end as other_data
        from {events}""",
    "inbound_masters": """
        select o_orderkey as id, o_orderkey - o_orderkey % 2 as source_reference_id,
               'JOB' || o_custkey as master_uid, 'OBL' || o_orderkey as obl_number
        from {orders}""",
    "inbound_shipments": f"""
        select {_LINE_ID} as id, l_orderkey as inbound_master_id from {{lineitem}}""",
    "shipment_list": """
        select o_orderkey as id, 'SHP' || lpad(cast(o_orderkey as string), 12, '0') as shipment_uid,
               cast(o_orderdate as date) as shipment_date, 'HBL' || o_orderkey as hbl_no,
               'PORT ' || (o_custkey % 25) as origin_name, 'C' || (o_custkey % 25) as origin_country_code,
               'PORT ' || (o_orderkey % 25) as destination_name, 'C' || (o_orderkey % 25) as destination_country_code,
               case when o_orderkey % 3 = 0 then 'Air' else 'Ocean' end as transport_mode,
               'ORD' || o_orderkey as order_no, o_orderpriority as tos_name,
               o_orderdate as order_confirmation, o_orderdate + interval '1' day as order_ready,
               o_orderdate + interval '2' day as order_pickup, o_orderdate + interval '3' day as order_departure,
               case when o_orderstatus = 'F' then o_orderdate + interval '20' day end as order_arrival,
               o_orderdate + interval '3' day as etd,
               case when o_orderstatus <> 'O' then o_orderdate + interval '4' day end as atd,
               o_orderdate + interval '18' day as eta,
               case when o_orderstatus = 'F' then o_orderdate + interval '20' day end as ata,
               o_orderstatus as status, 'SHIPPER ' || (o_custkey % 100) as shipper_name,
               'CONSIGNEE ' || (o_custkey % 77) as consignee_name, 'NOTIFY ' || (o_custkey % 50) as notify_name,
               'BILL ' || o_custkey as billing_customer_name, 'GOODS ' || (o_orderkey % 40) as commodity_description,
               cast(floor(o_totalprice) as bigint) as gross_weight_kgs, o_custkey % 60 as volume_in_cbm,
               'CARTON' as pack_name, o_orderkey % 90 as no_of_pieces,
               case when o_orderkey % 2 = 0 then 'Yes' else 'No' end as pickup_required,
               case when o_orderkey % 5 = 0 then 'Yes' else 'No' end as delivery_required,
               case when o_orderkey % 7 = 0 then 'DG' else 'General' end as cargo_type, o_custkey as customer_id
        from {orders}""",
    "shipment_containers": f"""
        select {_LINE_ID} as id, l_orderkey as shipment_id, l_partkey as master_container_id from {{lineitem}}""",
    "master_containers": """
        select p_partkey as id, p_partkey as container_id, 'CN' || lpad(cast(p_partkey as string), 8, '0') as container_number
        from {part}""",
    "container_types": """
        select p_partkey as id, p_type as code, cast(p_size as string) as teu,
               case when p_size % 4 = 0 then ' ' when p_size % 4 = 1 then null
                    else ' ' || (p_size * 100) || '.5 ' end as empty_tare_weight
        from {part}""",
    "users": """
        select cast(n_nationkey as bigint) as id, 'user' || n_nationkey as user_id,
               case when n_nationkey % 9 = 8 then 'Inactive' else 'Active' end as lov_status,
               'u' || n_nationkey || '@example.com' as email, cast(n_name as binary) as company_logo
        from {nation}""",
    "user_customers": """
        select cast(c_nationkey as bigint) as registration_no, c_custkey as customer_id,
               'CO' || (c_custkey % 4) as company_code
        from {customer}""",
    "customers": """
        select c_custkey as id, 'CUS' || c_custkey as customer_uid, c_name as name
        from {customer} where c_acctbal > 0""",
    "user_modules": """
        select cast(s_nationkey as bigint) as master_id, s_suppkey as module_id from {supplier}""",
    "modules": """
        select s_suppkey as id, s_name as label, '/m/' || s_suppkey as path from {supplier} where s_acctbal > 0""",
    "ports": """
        select cast(n_nationkey as bigint) as id, 'P' || n_nationkey as code, n_name as name,
               'C' || n_regionkey as country_code,
               case when n_nationkey % 2 = 0 then 'Ocean' else 'Air' end as transport_mode
        from {nation}""",
    "supplier_ports": """
        select s_suppkey as id, 'P' || s_suppkey as code, upper(s_name) as name, 'C' || s_nationkey as country_code,
               case when s_suppkey % 2 = 0 then 'Ocean' else 'Air' end as transport_mode
        from {supplier}""",
    "countries": """
        select cast(n_nationkey as bigint) as id, 'C' || n_nationkey as code, n_name as name
        from {nation} where n_nationkey < 20""",
    "terms": """
        select cast(r_regionkey as bigint) as id, 'TOS' || r_regionkey as code, r_name as name from {region}""",
    "packs": """
        select cast(r_regionkey as bigint) as id, 'PK' || r_regionkey as code, 'PACK ' || r_name as name from {region}""",
    "services": """
        select 'FCL' as code, 'Ocean' as transport_mode from {region} where r_regionkey = 0
        union all select 'LCL' as code, 'Road' as transport_mode from {region} where r_regionkey = 1""",
    "schedules": f"""
        select {_LINE_ID} as schedule_id, l_suppkey % 25 as origin_id, l_partkey % 25 as destination_id,
               case when l_linestatus = 'F' then l_suppkey end as co_loader_id,
               'ORIGIN ' || (l_suppkey % 25) as origin_name, 'DEST ' || (l_partkey % 25) as destination_name,
               'VESSEL ' || l_suppkey as vessel_name, 'V' || l_partkey as route_no, l_shipdate as etd,
               l_shipdate + cast(l_quantity as int) * interval '13' hour as eta,
               l_shipdate - l_linenumber * interval '7' hour as load_port_cutoff_date,
               case l_returnflag when 'A' then 'FCL' when 'N' then 'LCL' else 'FCL/LCL' end as service
        from {{lineitem}}""",
    "enquiries": """
        select o_orderkey as id, o_custkey as customer_id, 'ENQ' || (o_orderkey - o_orderkey % 2) as enquiry_no,
               cast(o_orderdate as date) as enquiry_date, cast(o_orderdate + interval '30' day as date) as quote_by_date
        from {orders}""",
    "enquiry_services": """
        select o_orderkey as enquiry_detail_id, o_custkey % 25 as origin_id, o_orderkey % 30 as destination_id,
               o_orderkey % 6 as tos_id, 'ORIGIN ' || (o_custkey % 25) as origin_name,
               'DEST ' || (o_orderkey % 30) as destination_name
        from {orders}
        union all
        select o_orderkey as enquiry_detail_id, o_custkey % 25 as origin_id, o_orderkey % 30 as destination_id,
               o_orderkey % 6 as tos_id, 'ORIGIN ' || (o_custkey % 25) as origin_name,
               'DEST ' || (o_orderkey % 30) as destination_name
        from {orders} where o_orderstatus = 'P'""",
    "enquiry_dimensions": """
        select l_orderkey as enquiry_detail_id, cast(l_quantity as decimal(18,2)) as gross_weight_kgs,
               cast(l_extendedprice as decimal(18,2)) as volume_in_weight
        from {lineitem}""",
    "shipments": f"""
        select o_orderkey as id, 'SHP' || lpad(cast(o_orderkey as string), 12, '0') as shipment_uid,
               o_orderdate as shipment_date, cast(1 as bigint) as group_company_id, o_custkey % 2 as company_id,
               o_custkey % 3 as branch_id, o_custkey % 25 as origin_id, o_orderkey % 25 as destination_id,
               {_SERVICE} as service_type
        from {{orders}}""",
    "shipment_services": f"""
        select o_orderkey as id, o_orderkey as shipment_header_id, o_custkey % 4 as service_id,
               {_SERVICE} as service_type,
               case when o_orderkey % 6 = 0 then 'Transit' when o_orderkey % 6 = 1 then 'ReExport' else 'Other' end as other_trade,
               case when o_custkey % 2 = 0 then 'Import' else 'Export' end as service_trade
        from {{orders}}
        union all
        select -o_orderkey - 1 as id, o_orderkey as shipment_header_id, o_custkey % 4 as service_id,
               {_SERVICE} as service_type, 'Other' as other_trade, 'Import' as service_trade
        from {{orders}} where o_orderstatus = 'P'""",
    "shipment_rates": """
        select l_orderkey || '-' || l_linenumber as id, l_orderkey as shipment_header_id,
               case when max(case when l_returnflag = 'A' then 1 else 0 end) = 0 then sum(cast(l_extendedprice as decimal(18,2))) end as sell_amount,
               cast(1 - min(l_discount) as decimal(9,4)) as currency_rate_of_exchange,
               sum(cast(l_quantity * 100 as decimal(18,2))) as cost_amount,
               cast(1 + min(l_tax) as decimal(9,4)) as cost_roe
        from {lineitem} group by l_orderkey, l_linenumber""",
    "vouchers": f"""
        select {_LINE_ID} as id, l_orderkey || '-' || l_linenumber as shipment_rate_id,
               case l_linestatus when 'F' then 'CR' else 'DR' end as dr_cr,
               cast(l_extendedprice as decimal(18,2)) as local_amount
        from {{lineitem}}""",
    "ledger_types": f"""
        select {_LINE_ID} as record_id,
               case when l_partkey % 3 = 0 then 'C_REVENUE' when l_partkey % 3 = 1 then 'S_REVENUE' else 'C_COST' end as rcn_type,
               l_suppkey as account_id
        from {{lineitem}}""",
    "wip_accounts": """
        select case when s_acctbal < 500 then s_suppkey end as wip_revenue_account_id,
               case when s_acctbal < 1500 then s_suppkey end as wip_cost_account_id
        from {supplier}""",
}


class StandIns(Mapping):
    """Stand-in tables by name, made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, tables: Mapping[str, str] | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self._sql = dict(TABLES, **(tables or {}))
        self._made: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._made[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.base(name)
        if name not in self._made:
            text = self._sql[name]
            used = {b: self.base(b) for b in set(re.findall(r"\{(\w+)\}", text))}
            self._made[name] = self.spark.sql(text, **used)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._sql)

    def __len__(self) -> int:
        return len(self._sql)


def oracle_text(sql: str, tables: Mapping[str, str] | None = None) -> str:
    """Prefix the stand-ins a query mentions as common table expressions."""
    all_tables = dict(TABLES, **(tables or {}))
    words = set(re.findall(r"\w+", sql))
    ctes = [
        f"{name} as ({re.sub(r'[{}]', '', text).strip()})" for name, text in all_tables.items() if name in words
    ]
    body = sql.strip()
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return f"with {', '.join(ctes)}, {body[5:]}"
    return f"with {', '.join(ctes)} {body}"
