"""Inbound table, XML shredding, outbound queue and the streamed shred."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.catalog.registry import query
from cargolens.catalog.reports import plain
from cargolens.operators import xml_shred as xs
from cargolens.operators.lists import nest
from cargolens.session import scratch_path, staged
from cargolens.sources import inbox
from cargolens.standins import AS_OF, StandIns
from cargolens.sources.commits import committed
from cargolens.streaming.shred import shred_stream

NOW = datetime(2001, 8, 1, 6, 0, 0)

# ---- inbound -------------------------------------------------------------


@query(
    "src_inbox",
    """select id, source, strftime(received_at, '%Y-%m-%d %H:%M:%S') as received_at, status, file_name, json_data, xml_data, other_data,
       cast(null as string) as processed_at from inbound_files""",
)
def _(t):
    path = scratch_path(t.spark, "inbox")
    t["inbound_files"].write.parquet(path)
    return plain(inbox.read_inbox(t.spark, path))


query(
    "src_payload_kind",
    """select source, case when json_data is not null then 'json' when xml_data is not null then 'xml' when other_data is not null then 'other' end as kind,
       cast(count(*) as bigint) as n from inbound_files group by 1, 2""",
)(lambda t: t["inbound_files"].groupBy("source", inbox.payload_kind().alias("kind")).agg(F.count(F.lit(1)).alias("n")))

query(
    "src_processing_log",
    "select '2001-08-01' as process_date, cast(count(*) as bigint) as records_processed, 'ETI_MANIFEST' as process_type from inbound_files where xml_data is not null",
)(
    lambda t: plain(
        inbox.processing_log(t["inbound_files"].filter("xml_data is not null"), AS_OF, "ETI_MANIFEST")
    )
)

def _order_documents(t: StandIns) -> DataFrame:
    content = F.concat(F.lit("ORDER "), F.col("o_orderkey").cast("string")).alias("content")
    codes = [F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("company_code"), F.lit("B").alias("branch_code")]
    return t["orders"].select(F.col("o_orderkey").alias("doc_key"), content, *codes)


def _rendered(t: StandIns, preview: str | None) -> DataFrame:
    return inbox.render(_order_documents(t), preview, t["part"].select(F.col("p_partkey").alias("file_uid")), NOW, "EDI_")


query(
    "outbox_queue",
    """select 'system' as create_user, '2001-08-01 06:00:00' as create_date, 'system' as run_user, '2001-08-01 06:00:00' as run_date,
       'C' || o_custkey as company_code, 'B' as branch_code, cast(null as varchar) as location_code,
       u.m + row_number() over (order by o_orderkey) as file_uid, 'EDI_' || o_orderkey || '.txt' as file_name,
       to_base64(encode('ORDER ' || o_orderkey)) as file_content, 'NEW' as status, cast(0 as bigint) as attempt
       from orders, (select max(p_partkey) as m from part) u""",
)(lambda t: plain(_rendered(t, "N").withColumn("file_content", F.base64("file_content"))))

@query(
    "outbox_reserved",
    """select batch, doc_key, 999 + row_number() over (order by batch, doc_key) as file_uid
       from (select o_orderkey % 2 as batch, o_orderkey as doc_key from orders)""",
)
def _(t):
    """Two batches whose writers take their ids from one counter."""
    out = scratch_path(t.spark, "outbox")
    docs = _order_documents(t)
    for batch in (0, 1):
        inbox.queue_batch(docs.filter(F.col("doc_key") % 2 == batch), batch, out, NOW, "EDI_", first=1000)
    key = F.regexp_extract("file_name", r"(\d+)", 1).cast("long").alias("doc_key")
    return committed(t.spark, out, "outbox").select(F.col("batch_id").cast("long").alias("batch"), key, "file_uid")


query(
    "outbox_preview",
    "select o_orderkey as doc_key, 'ORDER ' || o_orderkey as content, 'C' || o_custkey as company_code, 'B' as branch_code from orders",
)(lambda t: _rendered(t, "Y"))

# ---- manifest messages ---------------------------------------------------
# Messages are written from orders and their lines, one message per order.
# Each value is an expression both engines read; the shredded tables must give
# the same rows as selecting the expressions.


def _values(spec, key: str, **special: str) -> dict[str, str]:
    out = {}
    for c, (_, ty) in spec.items():
        if c in special:
            out[c] = special[c]
        elif ty == xs.TEXT:
            out[c] = f"'{c}-' || {key}"
        elif ty == xs.INT:
            out[c] = f"{key} % 90"
        elif ty == xs.DEC:
            out[c] = "cast(amount as decimal(18,3))"
        elif ty == xs.TIME:
            out[c] = "o_orderdate"
        else:
            out[c] = f"({key} % 2 = 0)"
    return out


# Columns whose values hold characters that XML must escape.
SPECIAL = {"receiver_code"}
VALUES = {
    "manifest_headers": _values(
        xs.HEADER,
        "o_orderkey",
        message_id="'M' || o_orderkey",
        receiver_code="'R&D <' || o_custkey || '>'",
        version="case when o_orderkey % 5 <> 0 then '1.0' end",
    ),
    "master_shipments": _values(xs.MASTER, "o_orderkey"),
    "routing_info": _values(xs.ROUTING, "o_custkey", atd="case when o_orderstatus = 'F' then o_orderdate end"),
    "containers": _values(
        xs.CONTAINER, "l_partkey", manifest_no="case when l_linenumber % 3 <> 0 then 'MF' || l_linenumber end"
    ),
    "house_bills": _values(
        xs.HOUSE, "l_suppkey", hbl_number="'H' || l_orderkey || '-' || l_linenumber || '-' || l_partkey"
    ),
    "house_containers": _values(
        xs.HOUSE_CONTAINER, "l_partkey", master_container_number="'CN' || l_partkey || '-' || k", package="l_linenumber + k"
    ),
    "shipping_parties": _values(xs.PARTY, "l_suppkey", fax="case when l_suppkey % 2 = 0 then 'fax' end"),
}

LINES = """
    select *, l_extendedprice as amount, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as pos
    from lineitem join orders on o_orderkey = l_orderkey"""
IS_HOUSE, IS_PARTY = "l_returnflag <> 'A'", "l_linenumber = 1"


def _element(spec, values) -> str:
    """SQL text giving the XML of one element's children; NULL leaves a tag out.

    Tags in a row that show the same value, each behind a fixed text, are one
    list of fixed texts joined by that value.
    """
    parts, open_group, shown, fixed = [], "", None, []

    def close() -> None:
        if shown is not None:
            parts.append(f"coalesce(array_join(array({', '.join(map(_quoted, fixed))}), {shown}), '')")

    for c, (path, ty) in spec.items():
        group, _, tag = path.rpartition("/")
        if group != open_group:
            close()
            shown, fixed = None, []
            parts.append(_quoted((f"</{open_group}>" if open_group else "") + (f"<{group}>" if group else "")))
            open_group = group
        behind = re.fullmatch(r"'([^']*)' \|\| (\w+)", values[c])
        ahead, value = behind.groups() if behind else ("", values[c])
        text = f"cast({value} as string)"
        if ty == xs.BOOL:
            text = f"case when {value} then 'on' else 'N' end"
        elif ty == xs.TIME:
            text = f"date_format({value}, \"yyyy-MM-dd'T'HH:mm:ss\")"
        elif c in SPECIAL:
            text = f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
        opening, closing = f"<{tag}>{ahead}", f"</{tag}>"
        if text == shown:
            fixed[-1] += opening
            fixed.append(closing)
        else:
            close()
            shown, fixed = text, [opening, closing]
    close()
    if open_group:
        parts.append(_quoted(f"</{open_group}>"))
    return f"concat({', '.join(parts)})"


def _quoted(text: str) -> str:
    return f"'{text}'"


def _wrap(tag: str, body: str) -> str:
    return f"concat('<{tag}>', {body}, '</{tag}>')"


def manifest_messages(t: StandIns) -> DataFrame:
    """``(id, xml_data)``: one message per order.

    Only the columns of orders and lines travel; texts are made where they are
    read, so none is shuffled or written.
    """
    orders = t["orders"].withColumn("amount", F.col("o_totalprice"))
    known = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"))
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    listed = t["lineitem"].join(known, "l_orderkey").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("items"))
    rows = orders.join(listed, F.col("o_orderkey") == F.col("l_orderkey"), "left")

    def joined(text: str) -> str:
        return f"coalesce(array_join(transform(items, x -> {_of_line(text)}), ''), '')"

    boxes = []
    for k in (1, 2):
        values = {c: v.replace("|| k", f"|| {k}").replace("+ k", f"+ {k}") for c, v in VALUES["house_containers"].items()}
        box = _wrap("HouseContainer", _element(xs.HOUSE_CONTAINER, values))
        boxes.append(f"case when l_linenumber % 3 >= {k} then {box} else '' end")
    house = f"concat({_element(xs.HOUSE, VALUES['house_bills'])}, {_wrap('HouseContainers', ', '.join(boxes))})"
    container = _wrap("Container", _element(xs.CONTAINER, VALUES["containers"]))
    party = _wrap("ShippingParty", _element(xs.PARTY, VALUES["shipping_parties"]))
    master = ", ".join(
        [
            _element(xs.MASTER, VALUES["master_shipments"]),
            _wrap("Routing", _element(xs.ROUTING, VALUES["routing_info"])),
            _wrap("Containers", joined(container)),
            _wrap("Houses", joined(f"case when {IS_HOUSE} then {_wrap('House', house)} else '' end")),
        ]
    )
    parties = _wrap("ShippingParties", joined(f"case when {IS_PARTY} then {party} else '' end"))
    header = _wrap("Header", _element(xs.HEADER, VALUES["manifest_headers"]))
    text = _wrap("Manifest", f"{header}, {_wrap('Master', master)}, {parties}")
    return rows.select(F.col("o_orderkey").alias("id"), F.expr(text).alias("xml_data"))


def _of_line(text: str) -> str:
    """SQL text over the columns of a line, read from ``x``; the key is that of the order."""
    text = re.sub(r"\bl_orderkey\b", "o_orderkey", re.sub(r"\bamount\b", "l_extendedprice", text))
    return re.sub(r"\b(l_[a-z]+)\b", r"x.\1", text)


def _oracle_columns(name: str, spec, decimals: str = "cast({} as double)") -> str:
    cols = []
    for c, (_, ty) in spec.items():
        v = VALUES[name][c]
        if ty == xs.TIME:
            v = f"strftime({v}, '%Y-%m-%d %H:%M:%S')"
        elif ty == xs.DEC:
            v = decimals.format(v)
        elif ty == xs.INT:
            v = f"cast({v} as bigint)"
        cols.append(f"{v} as {c}")
    return ", ".join([*cols, "'2001-08-01 06:00:00' as processed_at"])


_ORDERS = "(select *, o_totalprice as amount from orders)"
_MID = "'M' || o_orderkey as message_id"


def _table_sql(decimals: str) -> dict[str, str]:
    def columns(name: str) -> str:
        return _oracle_columns(name, xs.HOUSE_CONTAINER if name == "house_containers" else xs.TABLES[name], decimals)

    return {
        "manifest_headers": f"select {columns('manifest_headers')} from {_ORDERS}",
        "master_shipments": f"select {_MID}, {columns('master_shipments')} from {_ORDERS}",
        "routing_info": f"select {_MID}, {columns('routing_info')} from {_ORDERS}",
        "containers": f"select {_MID}, {columns('containers')} from ({LINES})",
        "house_bills": f"select {_MID}, {columns('house_bills')} from ({LINES}) where {IS_HOUSE}",
        "house_containers": f"""select {_MID}, {VALUES['house_bills']['hbl_number']} as hbl_number,
            {columns('house_containers')}
            from ({LINES}), (select unnest([1, 2]) as k) where {IS_HOUSE} and k <= l_linenumber % 3""",
        "shipping_parties": f"select {_MID}, {columns('shipping_parties')} from ({LINES}) where {IS_PARTY}",
    }


TABLE_SQL = _table_sql("cast({} as double)")
KEYS = {
    "manifest_headers": "xml_header",
    "master_shipments": "xml_master",
    "routing_info": "xml_routing",
    "containers": "xml_containers",
    "house_bills": "xml_house_bills",
    "house_containers": "xml_house_containers",
    "shipping_parties": "xml_parties",
}


def _parsed(t: StandIns, *tables: str) -> DataFrame:
    return xs.split_malformed(xs.parse_messages(manifest_messages(t), tables=tables))[0]


def _shredded(t: StandIns, name: str) -> DataFrame:
    return plain(xs.shred_table(_parsed(t, name), name, NOW))


for _name, _key in KEYS.items():
    query(_key, TABLE_SQL[_name])(lambda t, name=_name: _shredded(t, name))


@query("xml_quarantine", "select o_orderkey as id, o_orderkey % 10 = 0 as malformed from orders")
def _(t):
    messages = manifest_messages(t)
    cut = F.when(F.col("id") % 10 == 0, F.left("xml_data", F.length("xml_data") - 5)).otherwise(F.col("xml_data"))
    parsed = xs.marks(xs.parse_messages(messages.withColumn("xml_data", cut))).drop("xml_data")
    good, bad = xs.split_malformed(staged(parsed, "marks"))
    return good.select("id", F.lit(False).alias("malformed")).unionByName(bad.select("id", F.lit(True).alias("malformed")))


@query(
    "xml_nested_aligned",
    f"""select 'M' || o_orderkey as message_id, cast(count(*) as bigint) as houses, cast(sum(l_linenumber % 3) as bigint) as boxes
        from ({LINES}) where {IS_HOUSE} group by 1""",
)
def _(t):
    # both tables come of one parse
    good = staged(_parsed(t, "house_bills", "house_containers").select("msg"), "nested")
    houses = xs.shred_table(good, "house_bills", NOW).groupBy("message_id").agg(F.count(F.lit(1)).alias("houses"))
    boxes = xs.shred_table(good, "house_containers", NOW).groupBy("message_id").agg(F.count(F.lit(1)).alias("boxes"))
    return houses.join(boxes, "message_id", "left").withColumn("boxes", F.coalesce("boxes", F.lit(0)))


# All nine paths of the header at once.
query("xml_scalar_paths", TABLE_SQL["manifest_headers"].replace(", '2001-08-01 06:00:00' as processed_at", ""))(
    lambda t: plain(
        xs.shred_scalar(
            _parsed(t, "manifest_headers"), {c: (f"Header/{path}", ty) for c, (path, ty) in xs.HEADER.items()}
        )
    )
)


def _lockstep_sql(name: str) -> str:
    """The n-th present value of each column of a message stands in its n-th row."""
    spec, counted = xs.TABLES[name], []
    where = {"house_bills": IS_HOUSE, "house_containers": f"{IS_HOUSE} and k <= l_linenumber % 3", "shipping_parties": IS_PARTY}
    for c, (_, ty) in spec.items():
        boxes = name == "house_containers" and c != "hbl_number"
        rows = "b" if boxes else "l"
        value = VALUES["house_bills" if name == "house_containers" and not boxes else name][c]
        kept = where.get(name if boxes or name != "house_containers" else "house_bills", "true")
        order = "pos, k" if boxes else "pos"
        if ty == xs.DEC:
            value = f"cast({value} as double)"
        elif ty == xs.INT:
            value = f"cast({value} as bigint)"
        counted.append(
            f"c_{c} as (select o_orderkey, row_number() over (partition by o_orderkey order by {order}) as n, v from "
            f"(select *, {value} as v from {rows} where {kept}) where v is not null)"
        )
    every = " union ".join(f"select o_orderkey, n from c_{c}" for c in spec)
    shown = ", ".join(f"c_{c}.v as {c}" for c in spec)
    joins = " ".join(f"left join c_{c} on c_{c}.o_orderkey = a.o_orderkey and c_{c}.n = a.n" for c in spec)
    return f"""with l as ({LINES}), b as (select * from l, (select unnest([1, 2]) as k)), {', '.join(counted)}, a as ({every})
        select 'M' || a.o_orderkey as message_id, {shown}, '2001-08-01 06:00:00' as processed_at from a {joins}"""


for _name, _key in {
    "containers": "xml_containers_lockstep",
    "house_bills": "xml_house_bills_lockstep",
    "house_containers": "xml_house_containers_lockstep",
    "shipping_parties": "xml_parties_lockstep",
}.items():
    query(_key, _lockstep_sql(_name))(lambda t, name=_name: plain(xs.shred_lockstep(_parsed(t, name), name, NOW)))


# Rows of all seven tables, with what was quarantined, rejected and logged.
@query(
    "stream_xml_shred",
    " union all ".join(
        f"select '{_name}' as table_name, message_id, cast(to_json({_name}) as varchar) as content from ({_sql}) as {_name}"
        for _name, _sql in _table_sql("cast({} as varchar)").items()
    )
    + """ union all select 'processing_log', null, cast(to_json(l) as varchar) from (select '2001-08-01' as process_date,
          cast(count(*) as bigint) as records_processed, 'ETI_MANIFEST' as process_type from orders) as l""",
)
def _(t):
    base = scratch_path(t.spark, "shred-stream")
    manifest_messages(t).withColumn("processed", F.lit(False)).write.option("compression", "zstd").parquet(f"{base}/in")
    shred_stream(t.spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", NOW).awaitTermination()
    out = None
    for name in [*xs.TABLES, "quarantine", "cast_rejects", "processing_log"]:
        rows = committed(t.spark, f"{base}/out", name).drop("batch_id")
        decimals = {f.name: F.col(f.name).cast("string") for f in rows.schema.fields if f.dataType.typeName() == "decimal"}
        rows = plain(rows.withColumns(decimals))
        key = F.col("message_id") if "message_id" in rows.columns else F.lit(None).cast("string")
        content = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("content")
        rows = rows.select(F.lit(name).alias("table_name"), key.alias("message_id"), content)
        out = rows if out is None else out.unionByName(rows)
    return out
