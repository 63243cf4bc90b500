"""Filters, projections, joins, aggregates, windows and scalar functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cargolens.catalog.registry import query
from cargolens.functions import text as fx
from cargolens.operators import aggregates as agg
from cargolens.operators import joins, lists, ordered
from cargolens.operators import predicates as p
from cargolens.session import scratch_path
from cargolens.sources.clustered import write_clustered
from cargolens.sources.search_index import index_files, search
from cargolens.standins import AS_OF


def dbl(c):
    return F.col(c).cast("double").alias(c)


# ---- filters -------------------------------------------------------------

query("flt_equality", "select id, shipment_uid, company_id, branch_id from shipments where company_id = 1 and branch_id = 2")(
    lambda t: t["shipments"]
    .filter((F.col("company_id") == 1) & (F.col("branch_id") == 2))
    .select("id", "shipment_uid", "company_id", "branch_id")
)

query("flt_contains", "select id, file_name from inbound_files where file_name like '%' || upper('rr') || '%'")(
    lambda t: p.search_contains(t["inbound_files"], "file_name", "rr").select("id", "file_name")
)

# wildcards of the searches: any one character, any text, and the same ones escaped
LIKE_NAMES = {
    "named": """
        select o_orderkey as id, 'ETI' || case o_orderkey % 5 when 0 then '_' when 1 then 'X' when 2 then '%' when 3 then chr(92) else '__' end
          || (o_orderkey % 7) || '.XML' as file_name
        from {orders}""",
}
for _no, _search in enumerate(("eti_1", "i%3.x", r"i\_2", r"i\%", r"i\\", "")):
    query(
        f"flt_like_{_no}",
        f"select id, file_name from named where file_name like '%{_search.upper()}%' escape '\\'",
        LIKE_NAMES,
    )(lambda t, s=_search: p.search_contains(t["named"], "file_name", s))


def _indexed_names(t, table: str, files: int) -> str:
    """Path of the table in files that are near in ``file_name``, with its grams beside them."""
    path = scratch_path(t.spark, "searched")
    write_clustered(t[table], path, ["file_name"], files)
    index_files(t.spark, path, "file_name")
    return path


query("flt_contains_indexed", "select id, file_name from inbound_files where file_name like '%' || upper('rr') || '%'")(
    lambda t: search(t.spark, _indexed_names(t, "inbound_files", 12), "file_name", "rr").select("id", "file_name")
)

query(
    "flt_like_indexed",
    "select id, file_name from named where file_name like '%TI\\_%3.X%' escape '\\'",
    LIKE_NAMES,
)(lambda t: search(t.spark, _indexed_names(t, "named", 12), "file_name", r"ti\_%3.x").select("id", "file_name"))


@query(
    "flt_window_clustered",
    """select id, source from inbound_files
       where cast(received_at as date) between date '2024-01-10' - interval '30' day and date '2024-01-10' and source >= 'm'""",
)
def _(t):
    path = scratch_path(t.spark, "clustered")
    write_clustered(t["inbound_files"], path, ["received_at", "source"], 12)
    near = p.date_window(t.spark.read.parquet(path), "received_at", date(2024, 1, 10))
    return near.filter(F.col("source") >= "m").select("id", "source")


query("flt_contains_exact", "select schedule_id, service from schedules where service like '%LCL%'")(
    lambda t: p.search_contains(t["schedules"], "service", "LCL", upper=False).select("schedule_id", "service")
)

query(
    "flt_date_window",
    "select id, source from inbound_files where cast(received_at as date) between date '2024-01-10' - interval '30' day and date '2024-01-10'",
)(lambda t: p.date_window(t["inbound_files"], "received_at", date(2024, 1, 10)).select("id", "source"))

query(
    "flt_lookback",
    "select id, cast(enquiry_date as string) as enquiry_date from enquiries where enquiry_date >= date '2001-08-01' - 400",
)(
    lambda t: p.lookback(t["enquiries"], "enquiry_date", 400, AS_OF).select(
        "id", F.col("enquiry_date").cast("string").alias("enquiry_date")
    )
)

query(
    "flt_optional",
    "select service_id, service_type, cast(count(*) as bigint) as n from shipment_services where service_id = 2 group by all",
)(
    lambda t: p.optional_eq(p.optional_eq(t["shipment_services"], "service_id", 2), "service_type", None)
    .groupBy("service_id", "service_type")
    .agg(F.count(F.lit(1)).alias("n"))
)

query("flt_open_range", "select id, shipment_uid from shipments where cast(shipment_date as date) <= date '1997-06-30'")(
    lambda t: p.open_range(t["shipments"], "shipment_date", None, date(1997, 6, 30)).select("id", "shipment_uid")
)

query(
    "flt_pair_or_all",
    "select schedule_id, origin_name, destination_name from schedules where origin_name = 'ORIGIN 3' and destination_name = 'DEST 7'",
)(
    lambda t: p.pair_or_all(t["schedules"], "origin_name", "destination_name", "ORIGIN 3", "DEST 7").select(
        "schedule_id", "origin_name", "destination_name"
    )
)

_BOOKED = """
    select shipment_header_id, cast(sell_amount as double) as provisionRevenue,
           cast(case when cost_amount > 4000 then sell_amount else 1 end as double) as booked
    from shipment_rates"""


@query("flt_booking_state", f"select * from ({_BOOKED}) where provisionRevenue <> booked")
def _(t):
    rates = t["shipment_rates"].select(
        "shipment_header_id",
        F.col("sell_amount").alias("provisionRevenue"),
        F.when(F.col("cost_amount") > 4000, F.col("sell_amount")).otherwise(1).alias("wipRevenue"),
        F.lit(0).alias("pnlIncome"),
        *[F.lit(0).alias(c) for c in ("provisionCost", "wipCost", "pnlCost")],
    )
    out = p.booking_state(rates, p.PARTIAL_REVENUE)
    return out.select("shipment_header_id", dbl("provisionRevenue"), F.col("wipRevenue").cast("double").alias("booked"))


# ---- derived values ------------------------------------------------------

query(
    "prj_code_map",
    """select transport_mode, transport_mode_code, cast(count(*) as bigint) as n from (
         select status as transport_mode, case status when 'O' then 'S' when 'F' then 'A' end as transport_mode_code
         from shipment_list) group by all""",
)(
    lambda t: t["shipment_list"]
    .select(
        F.col("status").alias("transport_mode"),
        p.code_map(F.col("status"), {"O": "S", "F": "A"}).alias("transport_mode_code"),
    )
    .groupBy("transport_mode", "transport_mode_code")
    .agg(F.count(F.lit(1)).alias("n"))
)

query(
    "prj_coalesce",
    "select id, coalesce(strftime(ata, '%Y-%m-%d'), strftime(atd, '%Y-%m-%d'), shipment_uid) as document_no from shipment_list",
)(
    lambda t: t["shipment_list"].select(
        "id",
        F.coalesce(F.date_format("ata", fx.ISO_DATE), F.date_format("atd", fx.ISO_DATE), "shipment_uid").alias("document_no"),
    )
)

query(
    "prj_branch",
    """select id, trade, case when substr(trade, 1, 1) = 'T' then 'T9999' else 'D9999' end as consignee from (
         select id, case when other_trade = 'Transit' then other_trade else service_trade end as trade
         from shipment_services)""",
)(
    lambda t: t["shipment_services"]
    .withColumn("trade", p.trade_code(F.col("other_trade"), F.col("service_trade")))
    .select("id", "trade", p.default_consignee(F.col("trade")).alias("consignee"))
)

query("prj_list_value", "select id, name || '-(' || code || ')' as list_value from supplier_ports")(
    lambda t: t["supplier_ports"].select("id", p.list_value(F.col("name"), F.col("code")).alias("list_value"))
)

query("prj_flag", "select schedule_id, case when co_loader_id is null then 'N' else 'Y' end as is_coload from schedules")(
    lambda t: t["schedules"].select("schedule_id", p.flag_present(F.col("co_loader_id")).alias("is_coload"))
)


@query(
    "prj_audit",
    """select id, 'loader' as created_user, 'loader' as updated_user, '2001-08-01 00:00:00' as created_date,
       '2001-08-01 00:00:00' as updated_date from shipments""",
)
def _(t):
    out = p.with_audit(t["shipments"].select("id"), "loader", F.lit(AS_OF).cast("timestamp_ntz"))
    return out.select(
        "id",
        "created_user",
        "updated_user",
        *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("created_date", "updated_date")],
    )


# ---- joins ---------------------------------------------------------------

query(
    "join_inner",
    """select l.id, l.shipment_uid, u.user_id, c.company_code from shipment_list l
       join user_customers c on l.customer_id = c.customer_id join users u on u.id = c.registration_no""",
)(
    lambda t: t["shipment_list"]
    .select("id", "shipment_uid", "customer_id")
    .join(t["user_customers"], "customer_id")
    .join(t["users"].select(F.col("id").alias("registration_no"), "user_id"), "registration_no")
    .select("id", "shipment_uid", "user_id", "company_code")
)


@query(
    "join_left_chain",
    """select e.id, s.origin_name, po.code as origin, pd.code as destination, tm.name as tos, c.name as customer
       from enquiries e left join enquiry_services s on s.enquiry_detail_id = e.id
       left join ports po on po.id = s.origin_id left join ports pd on pd.id = s.destination_id
       left join terms tm on tm.id = s.tos_id left join customers c on c.id = e.customer_id""",
)
def _(t):
    rows = t["enquiries"].join(t["enquiry_services"], F.col("id") == F.col("enquiry_detail_id"), "left")
    rows = joins.role_join(rows, t["ports"], {"origin": "origin_id", "destination": "destination_id"}, ["code"], how="left")
    rows = joins.role_join(rows, t["terms"], {"tos": "tos_id"}, ["name"], how="left")
    rows = joins.role_join(rows, t["customers"], {"customer": "customer_id"}, ["name"], how="left")
    return rows.select(
        "id",
        "origin_name",
        F.col("origin_code").alias("origin"),
        F.col("destination_code").alias("destination"),
        F.col("tos_name").alias("tos"),
        F.col("customer_name").alias("customer"),
    )


query(
    "join_role_playing",
    """select s.schedule_id, o.code as origin_code, o.country_code as origin_country_code, d.code as destination_code,
       d.country_code as destination_country_code from schedules s
       join ports o on o.id = s.origin_id join ports d on d.id = s.destination_id""",
)(
    lambda t: joins.role_join(
        t["schedules"], t["ports"], {"origin": "origin_id", "destination": "destination_id"}, ["code", "country_code"]
    ).select("schedule_id", "origin_code", "origin_country_code", "destination_code", "destination_country_code")
)


@query(
    "join_bridge",
    """select distinct s.id, s.shipment_uid, m.container_number from shipment_list s
       join shipment_containers c on c.shipment_id = s.id join master_containers m on m.id = c.master_container_id""",
)
def _(t):
    pairs = joins.bridge_join(
        t["shipment_list"].select(F.col("id").alias("shipment"), "shipment_uid"),
        t["shipment_containers"],
        t["master_containers"],
        ("shipment", "shipment_id"),
        "master_container_id",
    )
    return pairs.select(F.col("shipment").alias("id"), "shipment_uid", "container_number")


query(
    "join_left_to_inner",
    """select c.registration_no, e.enquiry_no from user_customers c left join enquiries e on e.customer_id = c.customer_id
       where e.enquiry_date >= date '2000-01-01'""",
)(
    lambda t: t["user_customers"]
    .join(t["enquiries"], "customer_id", "left")
    .filter(F.col("enquiry_date") >= F.lit(date(2000, 1, 1)))
    .select("registration_no", "enquiry_no")
)

_FLAG_COUNTS = "cast(count(*) as bigint) as n"


@query(
    "join_in_flag",
    f"""select account_id, account_id in (select wip_revenue_account_id from wip_accounts
          where wip_revenue_account_id is not null) as is_wip, {_FLAG_COUNTS} from ledger_types group by all""",
)
def _(t):
    ids = t["wip_accounts"].select("wip_revenue_account_id").filter("wip_revenue_account_id is not null")
    per_account = t["ledger_types"].groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    return joins.membership_flags(per_account, "account_id", {"is_wip": ids})


@query(
    "join_not_in_flag",
    f"""select account_id, coalesce(account_id not in (select wip_cost_account_id from wip_accounts), false) as not_wip_as_written,
          account_id not in (select wip_cost_account_id from wip_accounts
          where wip_cost_account_id is not null) as not_wip, {_FLAG_COUNTS} from ledger_types group by all""",
)
def _(t):
    cost = t["wip_accounts"].select("wip_cost_account_id")
    per_account = t["ledger_types"].groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    lists = {"raw": cost, "own": cost.filter("wip_cost_account_id is not null")}
    flagged = joins.membership_flags(per_account, "account_id", lists)
    return flagged.select(
        "account_id",
        F.coalesce(~F.col("raw"), F.lit(False)).alias("not_wip_as_written"),
        (~F.col("own")).alias("not_wip"),
        "n",
    )


query(
    "join_scalar_subquery",
    """select s.id, coalesce((select cast(count(*) as bigint) from shipment_containers c where c.shipment_id = s.id), 0) as containers
       from shipment_list s""",
)(
    lambda t: joins.left_join_agg(
        t["shipment_list"].select("id"), t["shipment_containers"], {"id": "shipment_id"}, {"containers": F.count(F.lit(1))}
    ).withColumn("containers", F.coalesce("containers", F.lit(0)))
)


@query(
    "join_fanout_sum",
    """select e.id, cast(sum(d.gross_weight_kgs) as double) as weight_as_joined,
         cast(max(w.w) as double) as weight from enquiries e
       left join enquiry_services s on s.enquiry_detail_id = e.id
       left join enquiry_dimensions d on d.enquiry_detail_id = e.id
       left join (select enquiry_detail_id, sum(gross_weight_kgs) as w from enquiry_dimensions group by 1) w
         on w.enquiry_detail_id = e.id group by e.id""",
)
def _(t):
    children = {"services": t["enquiry_services"], "dims": t["enquiry_dimensions"]}
    sums = {"weight_as_joined": ("dims", "gross_weight_kgs")}
    out = joins.child_sums(t["enquiries"].select("id"), children, "id", "enquiry_detail_id", sums)
    plain = {"dims": t["enquiry_dimensions"]}
    out = joins.child_sums(out, plain, "id", "enquiry_detail_id", {"weight": ("dims", "gross_weight_kgs")}, fanout=False)
    return out.select("id", dbl("weight_as_joined"), dbl("weight"))


query(
    "join_preagg",
    """select r.id, cast(v.amount as double) as amount from shipment_rates r
       left join (select shipment_rate_id, sum(local_amount) as amount from vouchers group by 1) v on v.shipment_rate_id = r.id""",
)(
    lambda t: joins.left_join_agg(
        t["shipment_rates"].select("id"), t["vouchers"], {"id": "shipment_rate_id"}, {"amount": F.sum("local_amount")}
    ).select("id", dbl("amount"))
)

PARTNERS = {
    "partners": """
        select 'CO' || s_nationkey as company_code, 'B' || (s_suppkey % 3) as branch_code,
               case when s_acctbal > 0 then 'SND' || s_suppkey end as sender_code, 'RCV' || s_nationkey as receiver_code,
               case when s_suppkey % 4 = 0 then 'OUT' else 'IN' end as sftp_type
        from {supplier}""",
    "finance_documents": """
        select o_orderkey as did, 'CO' || (o_custkey % 30) as company_code, 'B' || (o_orderkey % 3) as branch_code
        from {orders}""",
}


@query(
    "join_lookup_rejects",
    """select d.did, p.s as sender_code, p.r as receiver_code, p.s is null as rejected from finance_documents d
       left join (select company_code, branch_code, min({'a': sender_code, 'b': receiver_code}) as m, m['a'] as s, m['b'] as r
                  from partners where sftp_type = 'IN' and sender_code is not null group by 1, 2) p
         on p.company_code = d.company_code and p.branch_code = d.branch_code""",
    PARTNERS,
)
def _(t):
    found, rejects = joins.partner_lookup(t["finance_documents"], t["partners"], ["company_code", "branch_code"])
    blank = F.lit(None).cast("string")
    missing = rejects.select("did", blank.alias("sender_code"), blank.alias("receiver_code"), F.lit(True).alias("rejected"))
    return found.select("did", "sender_code", "receiver_code", F.lit(False).alias("rejected")).unionByName(missing)


COMPOSITE = {
    "job_containers": """
        select distinct l_orderkey as job_uid, l_linenumber as container_uid, l_returnflag as segment_code,
               l_suppkey as job_no, 'C' || l_suppkey || '-' || l_linenumber as container_no
        from {lineitem}""",
    "subjob_containers": """
        select l_orderkey as job_uid, l_linenumber as container_uid, l_returnflag as segment_code, l_suppkey as job_no,
               l_orderkey as subjob_uid, cast(l_quantity as decimal(18,3)) as gross_weight
        from {lineitem} where l_linestatus = 'O'""",
}

query(
    "join_composite",
    """select s.subjob_uid, c.container_no, cast(s.gross_weight as double) as gross_weight from subjob_containers s
       join job_containers c on c.job_uid = s.job_uid and c.container_uid = s.container_uid
        and c.segment_code = s.segment_code and c.job_no = s.job_no""",
    COMPOSITE,
)(
    lambda t: t["subjob_containers"]
    .join(t["job_containers"], ["job_uid", "container_uid", "segment_code", "job_no"])
    .select("subjob_uid", "container_no", dbl("gross_weight"))
)

CODES = {
    "codes": """
        select 'DOC' as document, case when s_suppkey % 2 = 0 then 'PORT' else 'BOX' end as master,
               s_suppkey as code, 'EDI' || s_nationkey as edi_code
        from {supplier}"""
}

query(
    "join_code_translate",
    """select l.l_returnflag, c.edi_code as port_code, cast(count(*) as bigint) as n from lineitem l
       left join codes c on c.document = 'DOC' and c.master = 'PORT' and c.code = l.l_suppkey group by all""",
    CODES,
)(
    lambda t: joins.translate_code(t["lineitem"], t["codes"], "DOC", "PORT", "l_suppkey", "port_code")
    .groupBy("l_returnflag", "port_code")
    .agg(F.count(F.lit(1)).alias("n"))
)

query("join_semi", "select o_orderkey from orders where o_custkey in (select id from customers)")(
    lambda t: joins.split_existing(
        t["orders"].select("o_orderkey", F.col("o_custkey").alias("id")), t["customers"], ["id"]
    )[0].select("o_orderkey")
)
query("join_anti", "select o_orderkey from orders where o_custkey not in (select id from customers)")(
    lambda t: joins.split_existing(
        t["orders"].select("o_orderkey", F.col("o_custkey").alias("id")), t["customers"], ["id"]
    )[1].select("o_orderkey")
)

CONFIG = {
    "config_headers": """
        select s_suppkey as id, case s_suppkey when 3 then 'LINE_CODE' when 5 then 'AGENT_CODE' else 'KEY' || s_suppkey end as config_key
        from {supplier}""",
    "config_values": """
        select s_suppkey as config_header_id, 'L' || s_nationkey as config_value from {supplier} where s_suppkey <> 5""",
}


@query(
    "join_config",
    """select s.id, (select min(v.config_value) from config_headers h left join config_values v on v.config_header_id = h.id
         where h.config_key = 'LINE_CODE') as line_code,
         (select min(v.config_value) from config_headers h left join config_values v on v.config_header_id = h.id
         where h.config_key = 'AGENT_CODE') as agent_code from shipments s""",
    CONFIG,
)
def _(t):
    row = joins.config_row(t["config_headers"], t["config_values"], ["LINE_CODE", "AGENT_CODE"])
    return t["shipments"].select(
        "id",
        row.select("LINE_CODE").scalar().alias("line_code"),
        row.select("AGENT_CODE").scalar().alias("agent_code"),
    )


ADDRESSES = {
    "customer_addresses": """
        select c_custkey as customer_code, case when c_custkey % 3 = 0 then 'BILLING' else 'PRIMARY' end as address_type,
               'CITY ' || c_nationkey as city, 'C' || c_nationkey as country_code
        from {customer}""",
    "houses": "select o_orderkey as id, o_custkey as consignee_code, o_custkey + 1 as shipper_code from {orders}",
}


@query(
    "join_address_role",
    """select h.id, a.city as consignee_city, b.city as shipper_city from houses h
       left join customer_addresses a on a.customer_code = h.consignee_code and a.address_type = 'PRIMARY'
       left join customer_addresses b on b.customer_code = h.shipper_code and b.address_type = 'PRIMARY'""",
    ADDRESSES,
)
def _(t):
    primary = t["customer_addresses"].filter("address_type = 'PRIMARY'")
    roles = {"consignee": "consignee_code", "shipper": "shipper_code"}
    return joins.role_join(t["houses"], primary, roles, ["city"], key="customer_code", how="left").select(
        "id", "consignee_city", "shipper_city"
    )


# ---- aggregates ----------------------------------------------------------

query(
    "agg_count_left",
    """select m.id, cast(count(s.id) as bigint) as house_count from inbound_masters m
       left join inbound_shipments s on s.inbound_master_id = m.id group by m.id""",
)(
    lambda t: joins.left_join_agg(
        t["inbound_masters"].select("id"), t["inbound_shipments"], {"id": "inbound_master_id"}, {"house_count": F.count("id")}
    ).withColumn("house_count", F.coalesce("house_count", F.lit(0)))
)

query(
    "agg_status_counts",
    """select cast(count(*) as bigint) as total, cast(count(*) filter (status = 'Completed') as bigint) as completed,
       cast(count(*) filter (status = 'Error') as bigint) as failed from inbound_files""",
)(lambda t: agg.status_counts(t["inbound_files"], "status", {"completed": "Completed", "failed": "Error"}, "total"))


@query(
    "agg_group_sum",
    """select enquiry_detail_id, cast(sum(gross_weight_kgs) as double) as weight, cast(sum(volume_in_weight) as double) as volume
       from enquiry_dimensions group by 1""",
)
def _(t):
    sums = {"weight": F.col("gross_weight_kgs"), "volume": F.col("volume_in_weight")}
    out = agg.group_sums(t["enquiry_dimensions"], ["enquiry_detail_id"], sums)
    return out.select("enquiry_detail_id", dbl("weight"), dbl("volume"))


query(
    "agg_sum_product",
    """select shipment_header_id, cast(sum(sell_amount * currency_rate_of_exchange) as double) as revenue
       from shipment_rates group by 1""",
)(
    lambda t: agg.group_sums(
        t["shipment_rates"], ["shipment_header_id"], {"revenue": F.col("sell_amount") * F.col("currency_rate_of_exchange")}
    ).select("shipment_header_id", dbl("revenue"))
)


@query(
    "agg_signed_ledger",
    """select v.shipment_rate_id,
       cast(sum(case when l.rcn_type in ('C_REVENUE', 'S_REVENUE') then case v.dr_cr when 'CR' then v.local_amount else -v.local_amount end
                else 0 end) as double) as revenue,
       cast(sum(case when l.rcn_type = 'C_COST' then case v.dr_cr when 'DR' then v.local_amount else -v.local_amount end
                else 0 end) as double) as cost
       from vouchers v join ledger_types l on l.record_id = v.id group by 1""",
)
def _(t):
    rows = t["vouchers"].join(t["ledger_types"], F.col("id") == F.col("record_id"))
    amount, side, kind = F.col("local_amount"), F.col("dr_cr"), F.col("rcn_type")
    return (
        rows.groupBy("shipment_rate_id")
        .agg(
            agg.signed_ledger(amount, side, "CR", kind.isin("C_REVENUE", "S_REVENUE")).alias("revenue"),
            agg.signed_ledger(amount, side, "DR", kind == "C_COST").alias("cost"),
        )
        .select("shipment_rate_id", dbl("revenue"), dbl("cost"))
    )


query(
    "agg_sum_coalesce",
    "select shipment_header_id, cast(sum(coalesce(sell_amount, 0)) as double) as amount from shipment_rates group by 1",
)(
    lambda t: agg.group_sums(
        t["shipment_rates"], ["shipment_header_id"], {"amount": F.coalesce("sell_amount", F.lit(0))}
    ).select("shipment_header_id", dbl("amount"))
)


@query(
    "agg_margin_pct",
    """select shipment_header_id, case when r = 0 then 0.0 else (r - c) / nullif(r, 0) * 100 end as margin from (
         select shipment_header_id, cast(sum(coalesce(sell_amount, 0)) as double) as r, cast(sum(cost_amount) as double) as c
         from shipment_rates group by 1)""",
)
def _(t):
    sums = {"r": F.coalesce("sell_amount", F.lit(0)), "c": F.col("cost_amount")}
    out = agg.group_sums(t["shipment_rates"], ["shipment_header_id"], sums)
    return out.select("shipment_header_id", agg.margin_pct(F.col("r"), F.col("c")).alias("margin"))


@query(
    "agg_string",
    """select c.shipment_id, string_agg(m.container_number, ',' order by m.container_number) as containers
       from shipment_containers c join master_containers m on m.id = c.master_container_id group by 1""",
)
def _(t):
    boxes = t["shipment_containers"].select("shipment_id", F.col("master_container_id").alias("id"))
    boxes = boxes.join(t["master_containers"], "id").select("shipment_id", "container_number")
    return lists.string_list(boxes, ["shipment_id"], "container_number", "containers")


@query(
    "agg_count_by_code",
    """select shipment_id, string_agg(n || '*' || code, ',' order by code) as containers from (
         select c.shipment_id, k.code, count(*) as n from shipment_containers c
         join master_containers m on m.id = c.master_container_id join container_types k on k.id = m.container_id
         group by 1, 2) group by 1""",
)
def _(t):
    boxes = t["shipment_containers"].join(
        t["master_containers"].select(F.col("id").alias("master_container_id"), "container_id"), "master_container_id"
    )
    coded = boxes.join(t["container_types"].select(F.col("id").alias("container_id"), "code"), "container_id")
    return lists.count_by_code(coded, ["shipment_id"], "code", "containers")


def _as_json(df, name):
    return df.withColumn(name, fx.json_text(F.col(name)))


def _array_sql(key: str, rows: str, where: str = "true") -> str:
    """The JSON array of each key as rows: bracket, items with their commas, bracket."""
    return f"""
        with r as ({rows}), i as (select {key}, row_number() over (partition by {key} order by ord) as pos, item from r where {where})
        select {key}, cast(0 as bigint) as pos, '[' as text from (select distinct {key} from r)
        union all select {key}, pos, case when pos > 1 then ',' else '' end || cast(to_json(item) as string) from i
        union all select {key}, count(*) filter ({where}) + 1, ']' from r group by {key}"""


query(
    "agg_array_struct",
    _array_sql("country_code", "select country_code, id as ord, {'portCode': code, 'portName': name} as item from supplier_ports"),
)(lambda t: lists.array_rows(t["supplier_ports"], ["country_code"], ["id"], {"portCode": "code", "portName": "name"}))

query(
    "agg_array_ordered",
    _array_sql("customer_id", "select customer_id, (enquiry_date, id) as ord, {'no': enquiry_no, 'id': id} as item from enquiries"),
)(lambda t: lists.array_rows(t["enquiries"], ["customer_id"], ["enquiry_date", "id"], {"no": "enquiry_no", "id": "id"}))


@query(
    "agg_array_filtered",
    _array_sql(
        "registration_no",
        """select u.registration_no, u.customer_id as ord, c.id as cid, {'customerCode': c.customer_uid} as item
           from user_customers u left join customers c on c.id = u.customer_id""",
        "cid is not null",
    ),
)
def _(t):
    rows = t["user_customers"].join(t["customers"], F.col("customer_id") == F.col("id"), "left")
    fields = {"customerCode": "customer_uid"}
    return lists.array_rows(rows, ["registration_no"], ["customer_id"], fields, F.col("id").isNotNull())


query(
    "agg_array_nested",
    """select shipment_id, cast(to_json(list({'container': master_container_id} order by master_container_id)) as string) as containers
       from shipment_containers group by 1""",
)(
    lambda t: _as_json(
        lists.nest(t["shipment_containers"], ["shipment_id"], ["master_container_id"], {"container": "master_container_id"}, "containers"),
        "containers",
    )
)


@query(
    "agg_teu_tare",
    """select c.shipment_id, cast(sum(cast(k.teu as decimal(18,3))) as bigint) as teu,
         (cast(sum(coalesce(cast(nullif(trim(k.empty_tare_weight), '') as decimal(18,3)), 0)) * 1000 as bigint) + 50000) // 100000 / 10.0 as tare_mt
       from shipment_containers c join master_containers m on m.id = c.master_container_id
       join container_types k on k.id = m.container_id group by 1""",
)
def _(t):
    boxes = t["shipment_containers"].join(
        t["master_containers"].select(F.col("id").alias("master_container_id"), "container_id"), "master_container_id"
    )
    typed = boxes.join(
        t["container_types"].select(F.col("id").alias("container_id"), "teu", "empty_tare_weight"), "container_id"
    )
    out = agg.container_rollup(typed, ["shipment_id"], "teu", "empty_tare_weight")
    return out.select("shipment_id", F.col("teu").cast("long").alias("teu"), dbl("tare_mt"))


query(
    "agg_doc_split",
    """select company_id, cast(count(*) filter (has) as bigint) as with_children, cast(count(*) filter (not has) as bigint) as without_children
       from (select company_id, exists (select 1 from shipment_containers c where c.shipment_id = s.id) as has from shipments s) group by 1""",
)(lambda t: agg.presence_split(t["shipments"], t["shipment_containers"], "id", "shipment_id", ["company_id"]))

query("agg_distinct", "select distinct shipment_header_id, service_type from shipment_services")(
    lambda t: t["shipment_services"].select("shipment_header_id", "service_type").distinct()
)

query("agg_next_id", "select cast(coalesce(max(id), 0) + 1 as bigint) as file_uid from inbound_files")(
    lambda t: t["inbound_files"].agg((F.coalesce(F.max("id"), F.lit(0)) + 1).cast("long").alias("file_uid"))
)

query(
    "agg_group_expr",
    """select regexp_replace(commodity_description, '\\s+', ' ', 'g') as goods, nullif(trim(cargo_type), '') as cargo,
       cast(count(*) as bigint) as n from shipment_list group by 1, 2""",
)(
    lambda t: t["shipment_list"]
    .groupBy(fx.squeeze(F.col("commodity_description")).alias("goods"), fx.blank_to_null(F.col("cargo_type")).alias("cargo"))
    .agg(F.count(F.lit(1)).alias("n"))
)

query(
    "agg_house_weight",
    "select l_orderkey, cast(sum(coalesce(cast(nullif(l_quantity, 1) as decimal(18,3)), 0)) as double) as gross_weight from lineitem group by 1",
)(
    lambda t: agg.group_sums(
        t["lineitem"],
        ["l_orderkey"],
        {"gross_weight": F.coalesce(F.nullif(F.col("l_quantity"), F.lit(1.0)).cast("decimal(18,3)"), F.lit(0))},
    ).select("l_orderkey", dbl("gross_weight"))
)

# ---- windows, order ------------------------------------------------------

query(
    "win_serial",
    "select id, source, row_number() over (partition by source order by received_at, id) as serial_no from inbound_files",
)(
    lambda t: ordered.serial(
        t["inbound_files"].select("id", "source", "received_at"), ["source"], ["received_at", "id"], "serial_no"
    ).select("id", "source", "serial_no")
)

query(
    "win_serial_per_key",
    """select c.registration_no as login, l.shipment_uid, row_number() over (partition by c.registration_no order by l.shipment_uid) as id
       from shipment_list l join user_customers c on c.customer_id = l.customer_id""",
)(
    lambda t: ordered.serial(
        t["shipment_list"]
        .join(t["user_customers"], "customer_id")
        .select(F.col("registration_no").alias("login"), "shipment_uid"),
        ["login"],
        ["shipment_uid"],
        "id",
    )
)

query(
    "win_serial_expr",
    """select shipment_id, id, row_number() over (partition by shipment_id order by right(cast(master_container_id as string), 1), id) as sr_no
       from (select distinct shipment_id, id, master_container_id from shipment_containers)""",
)(
    lambda t: ordered.serial(
        t["shipment_containers"].distinct(),
        ["shipment_id"],
        [F.right(F.col("master_container_id").cast("string"), F.lit(1)), "id"],
        "sr_no",
    ).select("shipment_id", "id", "sr_no")
)

query(
    "win_item_number",
    """select subjob_uid, container_uid, row_number() over (partition by subjob_uid order by container_uid, segment_code, job_no, gross_weight) as item_no
       from subjob_containers""",
    COMPOSITE,
)(
    lambda t: ordered.serial(
        t["subjob_containers"], ["subjob_uid"], ["container_uid", "segment_code", "job_no", "gross_weight"], "item_no"
    ).select("subjob_uid", "container_uid", "item_no")
)


@query(
    "win_carry_forward",
    """select id, customer_id, case when cargo_type = 'DG' then commodity_description end as clean,
         last_value(case when cargo_type = 'DG' then commodity_description end ignore nulls)
           over (partition by customer_id order by id rows between unbounded preceding and current row) as carried
       from shipment_list""",
)
def _(t):
    rows = t["shipment_list"].select("id", "customer_id", "cargo_type", "commodity_description")
    block = F.when(F.col("cargo_type") == "DG", F.struct("commodity_description"))
    out = ordered.carry_forward(rows, ["customer_id"], ["id"], block, "block")
    return out.select(
        "id",
        "customer_id",
        F.when(F.col("cargo_type") == "DG", F.col("commodity_description")).alias("clean"),
        F.col("block.commodity_description").alias("carried"),
    )


query(
    "win_first_per_key",
    "select shipment_id, min(id) as id from shipment_containers group by 1",
)(
    lambda t: ordered.first_per_key(t["shipment_containers"], ["shipment_id"], ["id"]).select("shipment_id", "id")
)

query("sort_expr", "select id, right(shipment_uid, 1) as digit from shipments order by right(shipment_uid, 1), id")(
    lambda t: t["shipments"]
    .select("id", F.right("shipment_uid", F.lit(1)).alias("digit"))
    .orderBy("digit", "id")
)

query("sort_limit", "select id, shipment_uid from shipments order by shipment_uid limit 1")(
    lambda t: t["shipments"].select("id", "shipment_uid").orderBy("shipment_uid").limit(1)
)

# ---- scalar functions ----------------------------------------------------


@query(
    "fn_string",
    """select id, upper(commodity_description) as up, shipment_uid || '/' || hbl_no as joined, substr(shipment_uid, 1, 3) || '-' || substr(shipment_uid, 4) as split,
         left(hbl_no, 5) as l, right(hbl_no, 2) as r, substr(hbl_no, 1, length(hbl_no) - 1) as body, nullif(trim(' ' || nullif(status, 'F') || ' '), '') as trimmed,
         lpad(cast(id as string), 5, '0') as padded, replace(order_no, 'O', '0') as replaced, shipper_name || chr(10) || status as two_lines
       from shipment_list""",
)
def _(t):
    c = F.col
    return t["shipment_list"].select(
        "id",
        F.upper("commodity_description").alias("up"),
        F.concat("shipment_uid", F.lit("/"), "hbl_no").alias("joined"),
        fx.split_number(c("shipment_uid")).alias("split"),
        F.left("hbl_no", F.lit(5)).alias("l"),
        F.right("hbl_no", F.lit(2)).alias("r"),
        fx.without_last(c("hbl_no")).alias("body"),
        fx.blank_to_null(F.concat(F.lit(" "), F.nullif(c("status"), F.lit("F")), F.lit(" "))).alias("trimmed"),
        F.lpad(c("id").cast("string"), 5, "0").alias("padded"),
        F.replace(c("order_no"), F.lit("O"), F.lit("0")).alias("replaced"),
        F.concat("shipper_name", F.lit("\n"), "status").alias("two_lines"),
    )


query(
    "fn_regexp",
    """select id, nullif(regexp_extract('Sea (' || nullif(status, 'F') || '/FCL)', '\\(([^)]+)\\)', 1), '') as inside,
       nullif(regexp_extract(tos_name, '\\(([^)]+)\\)', 1), '') as none_found,
       regexp_replace(shipper_name || '   ' || chr(10) || status, '\\s+', ' ', 'g') as squeezed from shipment_list""",
)(
    lambda t: t["shipment_list"].select(
        "id",
        fx.in_parentheses(F.concat(F.lit("Sea ("), F.nullif(F.col("status"), F.lit("F")), F.lit("/FCL)"))).alias("inside"),
        fx.in_parentheses(F.col("tos_name")).alias("none_found"),
        fx.squeeze(F.concat("shipper_name", F.lit("   \n"), "status")).alias("squeezed"),
    )
)


@query(
    "fn_date_format",
    """select id, strftime(received_at, '%Y-%m-%d') as log_date, strftime(received_at, '%H:%M:%S') as log_time,
         upper(strftime(received_at, '%d-%b-%y')) as short_date, strftime(received_at, '%d-%b-%Y') as eta,
         strftime(received_at, '%y%m%d') as compact_date, strftime(received_at, '%H%M') as compact_time,
         strftime(received_at, '%Y-%m-%dT%H:%M:%S.%f') || '0Z' as issued, strftime(received_at, '%Y-%m-%dT%H:%M:%S.%g') || '+05:30' as replied
       from inbound_files""",
)
def _(t):
    ts = F.col("received_at")
    return t["inbound_files"].select(
        "id",
        F.date_format(ts, fx.ISO_DATE).alias("log_date"),
        F.date_format(ts, fx.CLOCK).alias("log_time"),
        fx.short_upper_date(ts).alias("short_date"),
        F.date_format(ts, fx.DAY_MONTH_YEAR).alias("eta"),
        F.date_format(ts, fx.COMPACT_DATE).alias("compact_date"),
        F.date_format(ts, fx.COMPACT_TIME).alias("compact_time"),
        F.date_format(ts, fx.ISSUE_STAMP).alias("issued"),
        F.date_format(ts, fx.REPLY_STAMP).alias("replied"),
    )


_DAYS = "cast(trunc((epoch_us({}) - epoch_us({})) / 86400000000.0) as bigint) || ' Days'"

query(
    "fn_interval_days",
    f"""select schedule_id, {_DAYS.format('eta', 'load_port_cutoff_date')} as cutoff_to_arrival,
        {_DAYS.format('load_port_cutoff_date', 'eta')} as backwards from schedules""",
)(
    lambda t: t["schedules"].select(
        "schedule_id",
        fx.whole_days(F.col("eta"), F.col("load_port_cutoff_date")).alias("cutoff_to_arrival"),
        fx.whole_days(F.col("load_port_cutoff_date"), F.col("eta")).alias("backwards"),
    )
)

query(
    "fn_math",
    """select id, cast(round(cost_amount / 300, 0) as bigint) as rounded, cast(cast(cost_amount / 300 as decimal(18,1)) as double) as one_place,
       cast(cast(cost_amount / 1000 as decimal(9,3)) as double) as tonnes from (select id, cast(cost_amount as decimal(18,2)) as cost_amount from shipment_rates)""",
)(
    lambda t: t["shipment_rates"]
    .withColumn("cost_amount", F.col("cost_amount").cast("decimal(18,2)"))
    .select(
        "id",
        F.round(F.col("cost_amount") / 300).cast("long").alias("rounded"),
        (F.col("cost_amount") / 300).cast("decimal(18,1)").cast("double").alias("one_place"),
        fx.tonnes(F.col("cost_amount")).cast("double").alias("tonnes"),
    )
)

query(
    "fn_number_format",
    """select l_orderkey, l_linenumber, l_partkey, case when left(d, 2) = '0.' then substr(d, 2) else d end as mass
       from (select *, cast(cast(l_extendedprice as decimal(18,3)) as string) as d from lineitem)
       union all select l_orderkey, l_linenumber, l_partkey, case when left(d, 2) = '0.' then substr(d, 2) else d end as mass
       from (select *, cast(cast(l_discount as decimal(18,3)) as string) as d from lineitem)""",
)(
    lambda t: t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.explode(F.array("l_extendedprice", "l_discount")).alias("v"),
    ).select("l_orderkey", "l_linenumber", "l_partkey", fx.fixed_three(F.col("v")).alias("mass"))
)

query(
    "fn_null",
    """select id, coalesce(nullif(status, 'F'), 'none') as status, nullif(cargo_type, 'General') as cargo,
       coalesce(nullif(cargo_type, 'General'), '') || '/' as blank from shipment_list""",
)(
    lambda t: t["shipment_list"].select(
        "id",
        F.coalesce(F.nullif(F.col("status"), F.lit("F")), F.lit("none")).alias("status"),
        F.nullif(F.col("cargo_type"), F.lit("General")).alias("cargo"),
        fx.oracle_concat(F.nullif(F.col("cargo_type"), F.lit("General")), "/").alias("blank"),
    )
)


@query(
    "fn_cast",
    """select id, try_cast(split_part(file_name, '_', 1) as bigint) as bad_number, try_cast(file_id as bigint) as good_number,
         cast(try_cast(file_id || '.25' as decimal(18,3)) as double) as dec, strftime(try_cast('2024-01-0' || (id % 12) as timestamp), '%Y-%m-%d') as day,
         case when word in ('true', 'on', 'y', '1') then true when word in ('false', 'off', 'n', '0') then false end as flag
       from (select *, split_part(replace(file_name, '.XML', ''), '_', 2) as file_id,
               case id % 6 when 0 then 'on' when 1 then 'y' when 2 then 'off' when 3 then '0' when 4 then 'true' else 'maybe' end as word
             from inbound_files)""",
)
def _(t):
    file_id = F.split_part(F.replace("file_name", F.lit(".XML"), F.lit("")), F.lit("_"), F.lit(2))
    word = F.element_at(F.array(*[F.lit(w) for w in ("on", "y", "off", "0", "true", "maybe")]), (F.col("id") % 6 + 1).cast("int"))
    day = F.concat(F.lit("2024-01-0"), (F.col("id") % 12).cast("string"))
    return t["inbound_files"].select(
        "id",
        F.split_part("file_name", F.lit("_"), F.lit(1)).try_cast("long").alias("bad_number"),
        file_id.try_cast("long").alias("good_number"),
        F.concat(file_id, F.lit(".25")).try_cast("decimal(18,3)").cast("double").alias("dec"),
        F.date_format(day.try_cast("timestamp_ntz"), fx.ISO_DATE).alias("day"),
        fx.to_boolean(word).alias("flag"),
    )


query(
    "json_field",
    "select event_id, cast(props->>'$.k' as bigint) as k, props->>'$.missing' as missing from events",
)(
    lambda t: t["events"].select(
        "event_id",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.get_json_object("props", "$.missing").alias("missing"),
    )
)

query(
    "json_array",
    "select id, status || '|' || tos_name as words, cast(2 as bigint) as n from shipment_list",
)(
    lambda t: t["shipment_list"]
    .select("id", F.concat(F.lit('["'), "status", F.lit('","'), "tos_name", F.lit('"]')).alias("doc"))
    .select("id", fx.json_list(F.col("doc")).alias("l"))
    .select("id", F.array_join("l", "|").alias("words"), F.size("l").cast("long").alias("n"))
)

query(
    "json_build",
    """select id, cast(to_json({'serialNo': id, 'date': strftime(received_at, '%Y-%m-%d'), 'fileName': file_name, 'payload': other_data}) as string) as doc
       from inbound_files""",
)(
    lambda t: t["inbound_files"].select(
        "id",
        fx.json_text(
            F.struct(
                F.col("id").alias("serialNo"),
                F.date_format("received_at", fx.ISO_DATE).alias("date"),
                F.col("file_name").alias("fileName"),
                F.col("other_data").alias("payload"),
            )
        ).alias("doc"),
    )
)

query("fn_base64", "select c_custkey, to_base64(encode(c_name)) as logo from customer")(
    lambda t: t["customer"].select("c_custkey", F.base64(F.encode("c_name", "utf-8")).alias("logo"))
)

query(
    "fn_address_line",
    "select c_custkey, c_custkey || ' ' || c_mktsegment || ' ' || coalesce(case when c_acctbal > 0 then c_name end, '') || ' ' as line from customer",
)(
    lambda t: t["customer"].select(
        "c_custkey",
        fx.address_line(
            F.col("c_custkey"), F.col("c_mktsegment"), F.when(F.col("c_acctbal") > 0, F.col("c_name")), F.lit(None)
        ).alias("line"),
    )
)

query(
    "fn_address_full",
    "select c.c_custkey, c.c_custkey || ',' || c.c_mktsegment || ',' || coalesce(k.name, '') || ',' as line from customer c left join countries k on k.id = c.c_nationkey",
)(
    lambda t: t["customer"]
    .join(t["countries"], F.col("c_nationkey") == F.col("id"), "left")
    .select("c_custkey", fx.full_address(F.col("c_custkey"), F.col("c_mktsegment"), F.col("name"), F.lit(None)).alias("line"))
)
