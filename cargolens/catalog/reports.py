"""Composed reports."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.catalog.registry import TEXTS as ORACLE_TEXTS
from cargolens.catalog.registry import query
from cargolens.operators import predicates as p
from cargolens.plans import reports
from cargolens.standins import AS_OF


def plain(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as doubles, for comparing engines."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


DAYS = 400


def _status_sql(stamp: str) -> str:
    cols = []
    for field, source in reports.STATUS_FIELDS.items():
        value = f"l.{source}"
        if field in reports.SHORT_DATES:
            value = f"upper(strftime({value}, '%d-%b-%y'))"
        elif source.startswith("order_") and source != "order_no":
            value = f"strftime({value}, '{stamp}')"
        elif source == "shipment_date":
            value = f"strftime({value}, '%Y-%m-%d')"
        cols.append(f'{value} as "{field}"')
    return f"""
        select u.registration_no as login,
               row_number() over (partition by u.registration_no order by l.shipment_uid) as id,
               {', '.join(cols)}, '' as "hsCode",
               (select string_agg(n || '*' || code, ',' order by code) from (
                  select k.code, count(*) as n from shipment_containers c
                  join master_containers m on m.id = c.master_container_id
                  join container_types k on k.id = m.container_id
                  where c.shipment_id = l.id group by k.code)) as "noOfContainers",
               (select string_agg(m.container_number, ',' order by m.container_number) from shipment_containers c
                  join master_containers m on m.id = c.master_container_id where c.shipment_id = l.id) as "containerNumber"
        from shipment_list l join user_customers u on u.customer_id = l.customer_id join users w on w.id = u.registration_no
        where l.shipment_date >= date '{AS_OF}' - {DAYS}"""


query("rpt_daily_status", _status_sql("%Y-%m-%d %H:%M:%S"))(lambda t: plain(reports.daily_status(t, DAYS, AS_OF)))

PREFERENCES = {
    "user_preferences": """
        select cast(n_nationkey as bigint) as web_user_master_id, '["id","status"]' as column_preferences
        from {nation} where n_nationkey % 2 = 0""",
    "user_triggers": """
        select cast(n_nationkey as bigint) as web_user_master_id, split('a' || n_nationkey || '@x.org,b@x.org', ',') as mail_id,
               n_nationkey % 4 = 0 as day_status, split('MON,FRI', ',') as days, split('Open', ',') as status_list,
               cast(null as timestamp) as last_trigger_date
        from {nation} where n_nationkey % 3 = 0""",
}
_PACK = ", ".join(f'"{c}" := "{c}"' for c in reports.STATUS_COLUMNS)


query(
    "rpt_daily_status_envelope",
    f"""with s as (select * from ({_status_sql('%Y-%m-%dT%H:%M:%S')}) where login <> 7),
        n as (select login, count(*) as n from s group by 1)
        select u.id as login, cast(0 as bigint) as pos, case when n.n is null then '{{"Status":"Error","Message":"Shipment List not available"}}'
          else '{{"userColumns":' || coalesce(p.column_preferences, 'null') || ',"data":[' end as text
        from users u left join n on n.login = u.id left join user_preferences p on p.web_user_master_id = u.id
        union all select login, id, case when id > 1 then ',' else '' end || cast(to_json(struct_pack({_PACK})) as string) from s
        union all select n.login, n.n + 1, '],"userTrigger":' || case when g.web_user_master_id is null then 'null' else
             cast(to_json([struct_pack("mailId" := g.mail_id, "dayStatus" := g.day_status, "days" := g.days,
             "statusList" := g.status_list, "lastTriggeredDate" := g.last_trigger_date)]) as string) end || '}}'
        from n left join user_triggers g on g.web_user_master_id = n.login""",
    {
        **PREFERENCES,
        # one login has no customers, hence no shipments
        "user_customers": """
            select cast(c_nationkey as bigint) as registration_no, c_custkey as customer_id,
                   'CO' || (c_custkey % 4) as company_code
            from {customer} where c_nationkey <> 7""",
    },
)(lambda t: reports.daily_status_envelope(t, DAYS, AS_OF))

NOW = datetime(2024, 1, 25, 6, 30, 15, 250000)
SEARCH = "e"

_LOG = """
    select f.source, row_number() over (partition by f.source order by f.received_at, f.file_name, m.master_uid, m.obl_number) as "serialNo",
           strftime(f.received_at, '%Y-%m-%d') as "date", strftime(f.received_at, '%H:%M:%S') as "time", f.file_name as "fileName",
           m.master_uid as "jobId", m.obl_number as "mblNo", cast(count(s.id) as bigint) as "houseCount"
    from inbound_files f join inbound_masters m on m.source_reference_id = f.id
    left join inbound_shipments s on s.inbound_master_id = m.id
    where cast(f.received_at as date) between date '2024-01-25' - 30 and date '2024-01-25' and f.file_name like '%' || upper('e') || '%'
    group by f.source, f.received_at, f.file_name, m.master_uid, m.obl_number"""
_KPI = """
    select cast(count(*) as bigint) as "totalFilesRequired", cast(count(*) filter (status = 'Completed') as bigint) as "successfullyProcessed",
           cast(count(*) filter (status = 'Error') as bigint) as "failedErrors" from inbound_files
    where cast(received_at as date) between date '2024-01-25' - 30 and date '2024-01-25' and file_name like '%' || upper('e') || '%'"""

query("rpt_inbound_log", _LOG)(lambda t: reports.inbound_log(t, SEARCH, NOW.date()))
query("rpt_inbound_kpi", _KPI)(lambda t: reports.inbound_kpi(t, SEARCH, NOW.date()))

_LOG_FIELDS = ", ".join(
    f'"{c}" := "{c}"' for c in ("serialNo", "date", "time", "fileName", "jobId", "mblNo", "houseCount")
)
query(
    "rpt_envelope",
    f"""with g as ({_LOG}), k as ({_KPI}),
        h as (select cast(to_json(struct_pack("httpStatus" := 200, "success" := true,
          "timestamp" := '2024-01-25T06:30:15.250+05:30', "result" := struct_pack("totalFilesRequired" := k."totalFilesRequired",
          "successfullyProcessed" := k."successfullyProcessed", "failedErrors" := k."failedErrors",
          "lastSyncTime" := '2024-01-25T06:30:15.250+05:30', "fileProcessingLog" := cast([] as varchar[])), "error" := null)) as string) as r from k),
        n as (select s.source, count(g.source) as n from (select distinct source from inbound_files) s left join g on g.source = s.source group by 1)
        select source, cast(0 as bigint) as pos, split_part(r, '[]', 1) || '[' as text from n, h
        union all select source, "serialNo", case when "serialNo" > 1 then ',' else '' end || cast(to_json(struct_pack({_LOG_FIELDS})) as string) from g
        union all select source, n + 1, ']' || split_part(r, '[]', 2) from n, h""",
)(lambda t: reports.inbound_monitor(t, SEARCH, NOW))

query(
    "rpt_port_list",
    """select name as "portName", country_code as "portCountry", code as "portCode", 'PORT' as type, transport_mode as "transportMode",
       name || '-(' || code || ')' as "listValue" from supplier_ports where name like '%#00000000%'""",
)(lambda t: reports.port_list({"ports": t["supplier_ports"]}, "port", "#00000000"))

_SCHEDULE_DAYS = "cast(trunc((epoch_us(s.eta) - epoch_us(s.{})) / 86400000000.0) as bigint) || ' Days'"
query(
    "rpt_sailing_schedule",
    f"""select o.code as "originCode", o.name as "originName", d.code as "destinationCode",
        case when s.co_loader_id is not null then 'Y' else 'N' end as "isCoload", o.code as pol, s.origin_name as "polName",
        d.code as pod, s.destination_name as "podName", o.country_code as "originCountryCode", d.country_code as "destinationCountryCode",
        s.schedule_id as "scheduleId", s.vessel_name as vessel, s.route_no as voyage,
        strftime(s.etd, '%Y-%m-%d %H:%M:%S') as "departureDate", strftime(s.eta, '%Y-%m-%d %H:%M:%S') as "arrivalDate",
        strftime(s.load_port_cutoff_date, '%Y-%m-%d %H:%M:%S') as "cutoffDate",
        {_SCHEDULE_DAYS.format('load_port_cutoff_date')} as "cutOffToArrival", {_SCHEDULE_DAYS.format('etd')} as "departureToArrival"
        from schedules s join ports o on o.id = s.origin_id join ports d on d.id = s.destination_id where s.service like '%FCL%'""",
)(lambda t: plain(reports.sailing_schedule(t, "", None, "FCL")))

query(
    "rpt_sales_enquiry",
    """select u.registration_no, e.enquiry_no as "enquiryNo", strftime(e.enquiry_date, '%Y-%m-%d') as "enquiryDate", o.code as origin,
       s.origin_name as "originName", o.country_code as "originCountry", d.code as destination, s.destination_name as "destinationName",
       d.country_code as "destinationCountry", strftime(e.quote_by_date, '%Y-%m-%d') as "validUpto", k.name as tos,
       cast(sum(w.gross_weight_kgs) as double) as "grossWeightKgs", cast(sum(w.volume_in_weight) as double) as "volumeInWeight"
       from user_customers u left join enquiries e on e.customer_id = u.customer_id
       left join enquiry_services s on s.enquiry_detail_id = e.id left join terms k on k.id = s.tos_id
       left join ports o on o.id = s.origin_id left join ports d on d.id = s.destination_id
       left join enquiry_dimensions w on w.enquiry_detail_id = e.id
       where e.enquiry_date >= date '2001-08-01' - 900 group by all""",
)(lambda t: plain(reports.sales_enquiry(t, 900, AS_OF)))


def _wip_sql(cost_guard: str, condition: str = "true") -> str:
    rev = "(select wip_revenue_account_id from wip_accounts where wip_revenue_account_id is not null)"
    cost = f"(select wip_cost_account_id from wip_accounts where {cost_guard} is not null)"
    is_rev, is_cost = "l.rcn_type in ('C_REVENUE', 'S_REVENUE')", "l.rcn_type = 'C_COST'"

    def signed(plus, minus, test):
        return (
            f"sum(case when v.dr_cr = '{plus}' and {test} then v.local_amount "
            f"when v.dr_cr = '{minus}' and {test} then -v.local_amount else 0 end)"
        )

    z = "coalesce(r.{}, 0)".format
    rev0 = f"sum({z('sell_amount')} * {z('currency_rate_of_exchange')})"
    cost0 = f"sum({z('cost_amount')} * {z('cost_roe')})"
    return f"""
        with b as (select v.shipment_rate_id, {signed('CR', 'DR', f'{is_rev} and l.account_id not in {rev}')} as ar,
                {signed('DR', 'CR', f'{is_cost} and l.account_id not in {cost}')} as ac,
                {signed('CR', 'DR', f'{is_rev} and l.account_id in {rev}')} as wr,
                {signed('DR', 'CR', f'{is_cost} and l.account_id in {cost}')} as wc
              from vouchers v join ledger_types l on l.record_id = v.id group by 1),
        f as (select s.id as "shipmentId", d.service_type as service, s.shipment_uid as "shipmentUid",
                strftime(s.shipment_date, '%Y-%m-%d %H:%M:%S') as "jobDate",
                cast(sum(r.sell_amount * r.currency_rate_of_exchange) as double) as "provisionRevenue",
                cast(sum(r.cost_amount * r.cost_roe) as double) as "provisionCost",
                case when {rev0} = 0 then 0.0 else (cast({rev0} as double) - cast({cost0} as double)) / cast({rev0} as double) * 100 end as "netGpPercentage",
                cast(sum(coalesce(b.ar, 0)) as double) as "pnlIncome", cast(sum(coalesce(b.ac, 0)) as double) as "pnlCost",
                cast(sum(coalesce(b.wr, 0)) as double) as "wipRevenue", cast(sum(coalesce(b.wc, 0)) as double) as "wipCost"
              from shipments s left join shipment_services d on d.shipment_header_id = s.id
              left join shipment_rates r on r.shipment_header_id = s.id left join b on b.shipment_rate_id = r.id
              where {condition} group by s.id, d.service_type, s.shipment_uid, s.shipment_date)
        select * from f"""


query("rpt_wip", _wip_sql("wip_cost_account_id"))(lambda t: plain(reports.wip_finance(t, AS_OF)))
query(
    "rpt_wip_as_written",
    _wip_sql(
        "wip_revenue_account_id",
        """s.group_company_id = 1 and s.company_id = 1 and s.branch_id = 2 and d.service_id = 1
           and cast(s.shipment_date as date) between date '1996-01-01' and date '2000-12-31'""",
    )
    + """ where "provisionCost" <> "wipCost" + "pnlCost" """,
)(
    lambda t: plain(
        reports.wip_finance(
            t,
            date(2000, 12, 31),
            date(1996, 1, 1),
            group_company_id=1,
            company_id=1,
            branch_id=2,
            service_id=1,
            mode=p.PARTIAL_COST,
            null_guard="reference",
        )
    )
)

query(
    "rpt_user_bundle",
    """select w.user_id as "userName", w.email, to_base64(w.company_logo) as "companyLogo",
       cast(coalesce((select to_json(list(struct_pack("customerCode" := c.customer_uid, "customerName" := c.name, "companyCode" := u.company_code)
         order by u.customer_id)) from user_customers u join customers c on c.id = u.customer_id where u.registration_no = w.id), '[]') as string) as customers,
       cast(coalesce((select to_json(list(struct_pack("label" := m.label, "path" := m.path) order by m.id))
         from user_modules x join modules m on m.id = x.module_id where x.master_id = w.id), '[]') as string) as modules
       from users w where w.lov_status = 'Active'""",
)(lambda t: reports.user_bundle(t))


# ---- replies -------------------------------------------------------------


def _array_sql(rows: str, order: str, fields: str) -> str:
    """Head, items and tail of one JSON array."""
    return f"""with r as ({rows}), n as (select *, row_number() over (order by {order}) as pos from r)
        select cast(0 as bigint) as pos, case when count(*) = 0 then '[]' else '[' end as text from r
        union all select pos, case when pos > 1 then ',' else '' end || cast(to_json(struct_pack({fields})) as varchar) from n
        union all select cast(count(*) + 1 as bigint), ']' from r having count(*) > 0"""


def _packed(*names: str) -> str:
    return ", ".join(f'"{n}" := "{n}"' for n in names)


_PORT_FIELDS = ("portName", "portCountry", "portCode", "type", "transportMode", "listValue")
for _name, _search in {"rpt_port_reply": "#0000000", "rpt_port_reply_empty": "no such port"}.items():
    query(
        _name,
        _array_sql(
            f"""select name as "portName", country_code as "portCountry", code as "portCode", 'PORT' as type,
            transport_mode as "transportMode", name || '-(' || code || ')' as "listValue" from supplier_ports
            where name like '%{_search.upper()}%'""",
            '"portName", "portCode", "portCountry", "transportMode"',
            _packed(*_PORT_FIELDS),
        ),
    )(lambda t, search=_search: reports.port_reply({"ports": t["supplier_ports"]}, "port", search))

_SCHEDULE_FIELDS = (
    "originCode", "originName", "destinationCode", "isCoload", "pol", "polName", "pod", "podName", "originCountryCode",
    "destinationCountryCode", "scheduleId", "vessel", "voyage", "departureDate", "arrivalDate", "cutoffDate", "cutOffToArrival",
    "departureToArrival",
)
query(
    "rpt_sailing_reply",
    _array_sql(
        ORACLE_TEXTS["rpt_sailing_schedule"].replace("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S"),
        ", ".join(f'"{c}"' for c in ("scheduleId", *[c for c in _SCHEDULE_FIELDS if c != "scheduleId"])),
        _packed(*_SCHEDULE_FIELDS),
    ),
)(lambda t: reports.schedule_reply(t, "", None, "FCL"))


def _read_back(reply: DataFrame, fields: str) -> DataFrame:
    """Replies with amounts are compared as numbers: each item's fields become columns, other rows keep their text."""
    item = F.from_json(F.ltrim("text", F.lit(",")), fields)
    is_item = F.col("text").startswith("{") & ~F.col("text").startswith('{"status"') | F.col("text").startswith(",")
    rows = reply.withColumn("_i", F.when(is_item, item))
    rest = [c for c in reply.columns if c != "text"]
    return rows.select(*rest, F.when(~F.coalesce(is_item, F.lit(False)), F.col("text")).alias("text"), "_i.*")


_MONEY = ("provisionRevenue", "provisionCost", "netGpPercentage", "pnlIncome", "pnlCost", "wipRevenue", "wipCost")
_WIP_FIELDS = ("shipmentId", "service", "shipmentUid", "jobDate", *_MONEY)


def _wip_reply_sql(condition: str) -> str:
    none = ", ".join(f'null as "{c}"' for c in _WIP_FIELDS)
    shown = ", ".join(f"replace(\"{c}\", ' ', 'T') as \"{c}\"" if c == "jobDate" else f'"{c}"' for c in _WIP_FIELDS)
    return f"""with r as ({_wip_sql("wip_cost_account_id", condition)})
        select cast(0 as bigint) as pos, case when count(*) = 0 then '{reports.NO_FINANCE}' else '[' end as text, {none} from r
        union all select row_number() over (order by "shipmentId", service nulls first), null, {shown} from r
        union all select cast(count(*) + 1 as bigint), ']', {none} from r having count(*) > 0"""


_WIP_DDL = "shipmentId long, service string, shipmentUid string, jobDate string, " + ", ".join(f"{c} double" for c in _MONEY)
for _name, _to in {"rpt_wip_reply": AS_OF, "rpt_wip_reply_empty": date(1900, 1, 1)}.items():
    query(_name, _wip_reply_sql(f"cast(s.shipment_date as date) <= date '{_to}'"))(
        lambda t, to=_to: _read_back(reports.wip_reply(t, to), _WIP_DDL)
    )

_ENQUIRY_TEXTS = (
    "enquiryNo", "enquiryDate", "origin", "originName", "originCountry", "destination", "destinationName", "destinationCountry",
    "validUpto", "tos",
)
_ENQUIRY_SUMS = ("grossWeightKgs", "volumeInWeight")
_ENQUIRY_ORDER = ", ".join(
    f'"{c}" nulls first' for c in ("enquiryDate", "enquiryNo", *[c for c in (*_ENQUIRY_TEXTS, *_ENQUIRY_SUMS) if c not in ("enquiryDate", "enquiryNo")])
)
_ENQUIRY_NONE = ", ".join(f'null as "{c}"' for c in (*_ENQUIRY_TEXTS, *_ENQUIRY_SUMS))
query(
    "rpt_enquiry_reply",
    f"""with r as ({ORACLE_TEXTS["rpt_sales_enquiry"]}),
        n as (select u.registration_no, count(r.registration_no) as n from (select distinct registration_no from user_customers) u
              left join r on r.registration_no = u.registration_no group by 1)
        select registration_no, cast(0 as bigint) as pos, case when n > 0 then '[' end as text, {_ENQUIRY_NONE} from n
        union all select registration_no, row_number() over (partition by registration_no order by {_ENQUIRY_ORDER}), null,
          {", ".join(f'"{c}"' for c in (*_ENQUIRY_TEXTS, *_ENQUIRY_SUMS))} from r
        union all select registration_no, n + 1, ']', {_ENQUIRY_NONE} from n where n > 0""",
)(
    lambda t: _read_back(
        reports.enquiry_reply(t, 900, AS_OF),
        ", ".join([f"{c} string" for c in _ENQUIRY_TEXTS] + [f"{c} double" for c in _ENQUIRY_SUMS]),
    )
)

query(
    "rpt_user_reply",
    f"""with a as (select * from users where lov_status = 'Active')
        select id as login, cast(0 as bigint) as section, cast(0 as bigint) as pos, case when lov_status = 'Active' then
          '{{"status":"SUCCESS","data":' || rtrim(cast(to_json(struct_pack("userName" := user_id, "email" := email,
          "companyLogo" := to_base64(company_logo))) as varchar), '}}') || ',"customers":['
          else '{reports.INACTIVE}' end as text from users
        union all select id, s, 0, x from a, (values (2, '],"modules":['), (4, ']}}}}')) v(s, x)
        union all select login, 1, pos, case when pos > 1 then ',' else '' end || cast(to_json(struct_pack("customerCode" := customer_uid,
          "customerName" := name, "companyCode" := company_code)) as varchar) from (
            select u.registration_no as login, c.customer_uid, c.name, u.company_code,
              row_number() over (partition by u.registration_no order by u.customer_id, u.company_code) as pos
            from user_customers u join customers c on c.id = u.customer_id join a on a.id = u.registration_no)
        union all select login, 3, pos, case when pos > 1 then ',' else '' end || cast(to_json(struct_pack("label" := label, "path" := path)) as varchar)
          from (select x.master_id as login, m.label, m.path, row_number() over (partition by x.master_id order by m.id) as pos
            from user_modules x join modules m on m.id = x.module_id join a on a.id = x.master_id)""",
)(lambda t: plain(reports.user_reply(t)))
