"""Numbering and keyed state."""

from __future__ import annotations

from pyspark.sql import functions as F

from cargolens.catalog.registry import query
from cargolens.catalog.reports import plain
from cargolens.operators import commands as cmd
from cargolens.operators import numbering, state_store
from cargolens.session import scratch_path
from cargolens.streaming.commands import latest_state, upsert_stream

query("num_sequence", "select o_orderkey, 500 + row_number() over (order by o_orderdate, o_orderkey) as sequence_no from orders")(
    lambda t: numbering.assign_sequence(t["orders"].select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], base=500)
    .select("o_orderkey", "sequence_no")
)

SENDS = {
    "sends": """
        select o_orderkey as seq, 'MAS' || o_custkey as master_uid,
               case when o_orderstatus = 'F' then null else 'ROT' || (o_custkey % 7) end as rotation_no
        from {orders}""",
    "counters": """
        select 'MAS' || c_custkey as master_uid, 'ROT' || (c_custkey % 7) as rotation_no, c_custkey % 5 + 1 as instalment_no
        from {customer} where c_custkey % 4 = 0""",
}

_NUMBERED = """
    select s.seq, case when s.rotation_no is null then 1
             when p.instalment_no is not null then p.instalment_no + row_number() over (partition by s.master_uid, s.rotation_no order by s.seq) - 1
             else greatest(row_number() over (partition by s.master_uid, s.rotation_no order by s.seq) - 1, 1) end as instalment_no
    from sends s left join counters p on p.master_uid = s.master_uid and p.rotation_no = s.rotation_no"""

query("num_instalment", _NUMBERED, SENDS)(
    lambda t: numbering.instalments(t["sends"], t["counters"], ["master_uid", "rotation_no"], "seq")[0].select(
        "seq", "instalment_no"
    )
)
query(
    "num_instalment_state",
    """with n as (select master_uid, rotation_no, count(*) as sent from sends where rotation_no is not null group by 1, 2)
       select coalesce(p.master_uid, n.master_uid) as master_uid, coalesce(p.rotation_no, n.rotation_no) as rotation_no,
              cast(coalesce(p.instalment_no, 0) + coalesce(n.sent, 0) as bigint) as instalment_no
       from counters p full join n on n.master_uid = p.master_uid and n.rotation_no = p.rotation_no
       union all select master_uid, rotation_no, cast(1 as bigint) as instalment_no from sends where rotation_no is null""",
    SENDS,
)(lambda t: numbering.instalments(t["sends"], t["counters"], ["master_uid", "rotation_no"], "seq")[1])

# chr(123) and chr(125) are the braces, which stand for table names in this text.
_USER = "case when event_id % 97 = 0 then 'x' else '' end || user_id"
_DATE = "case when event_id % 2 = 0 then '2024-01-0' || (event_id % 9 + 1) || ' 00:00:00' else '' end"
FEEDS = {
    "preference_commands": f"""
        select event_id as seq, case event_type when 'signup' then 'U' when 'purchase' then 'U' when 'view' then 'S' else 'X' end as method,
               chr(123) || '"webUserMasterId":"' || {_USER} || '","columnPreferences":["c' || event_id || '","d"],"createUser":"u' || event_id
               || '","createDate":"' || {_DATE} || '","updateUser":"w' || event_id || '","updateDate":"","registrationNo":"R' || user_id
               || '","version":' || (event_id % 10) || ',"nxtCustomerId":""' || chr(125) as payload
        from {{events}}""",
    "preferences": """
        select c_custkey as web_user_master_id, '["base"]' as column_preferences, 'creator' as create_user,
               cast('2023-01-01 00:00:00' as timestamp) as create_date, 'updater' as update_user,
               cast(null as timestamp) as update_date, 'R' || c_custkey as registration_no, cast(1 as int) as version,
               c_custkey as customer_id
        from {customer} where c_custkey % 3 = 0""",
    "trigger_commands": f"""
        select event_id as seq, case event_type when 'signup' then 'U' when 'purchase' then 'U' when 'error' then 'D' else 'X' end as method,
               chr(123) || '"webUserMasterId":"' || {_USER} || '","createUser":"u' || event_id || '","createDate":"' || {_DATE}
               || '","updateUser":"w' || event_id || '","updateDate":"","mailId":["m' || event_id || '@x.org","n@x.org"],"dayStatus":"'
               || case when event_id % 2 = 0 then 'on' else 'false' end || '","days":[' || case when event_id % 5 = 0 then '' else '"MON"' end
               || '],"lastTriggeredDate":""' || chr(125) as payload
        from {{events}}""",
    "triggers": """
        select c_custkey as web_user_master_id, 'creator' as created_user, cast('2023-01-01 00:00:00' as timestamp) as created_date,
               'updater' as updated_user, cast(null as timestamp) as updated_date, split('base@x.org', ',') as mail_id,
               c_custkey % 2 = 0 as day_status, split('TUE,WED', ',') as days, split('Open', ',') as status_list,
               cast(null as timestamp) as last_trigger_date
        from {customer} where c_custkey % 3 = 0""",
}


def _base(df, feed):
    """Stand-in state with the column types of the feed."""
    times = [c for c, (_, ty) in feed.fields.items() if ty == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def _ok(t, kind: str, feed):
    return cmd.parse_commands(t[f"{kind}_commands"], feed)[0]


_GOOD = "event_id % 97 <> 0"
_STAMP = f"nullif({_DATE}, '')"

@query(
    "state_parse_command",
    f"""select event_id as seq, cast(user_id as bigint) as web_user_master_id, '["c' || event_id || '","d"]' as column_preferences,
        'u' || event_id as create_user, {_STAMP} as create_date, 'w' || event_id as update_user, 'R' || user_id as registration_no,
        cast(event_id % 10 as bigint) as version, cast(null as varchar) as update_date, cast(null as bigint) as customer_id,
        case event_type when 'signup' then 'U' when 'purchase' then 'U' when 'view' then 'S' else 'X' end as method
        from events where {_GOOD}""",
    FEEDS,
)
def _(t):
    return plain(_ok(t, "preference", cmd.PREFERENCES))


_UPSERTS = f"select event_id as seq, user_id as k, 'u' || event_id as cu, {_STAMP} as cd from events where event_type in ('signup', 'purchase') and {_GOOD}"

query(
    "state_upsert",
    f"""with u as ({_UPSERTS}),
        n as (select k, max(seq) as last, min(seq) as first from u group by 1)
        select coalesce(p.web_user_master_id, n.k) as web_user_master_id,
          case when n.k is null then p.column_preferences else '["c' || n.last || '","d"]' end as column_preferences,
          coalesce(p.create_user, 'u' || n.first) as create_user,
          case when p.web_user_master_id is not null then strftime(p.create_date, '%Y-%m-%d %H:%M:%S')
               else (select cd from u where u.seq = n.first) end as create_date,
          case when n.k is null then p.update_user else 'w' || n.last end as update_user, cast(null as varchar) as update_date,
          case when n.k is null then p.registration_no else 'R' || n.k end as registration_no,
          case when n.k is null then cast(p.version as bigint) else cast(n.last % 10 as bigint) end as version,
          case when n.k is null then p.customer_id end as customer_id
        from preferences p full join n on n.k = p.web_user_master_id""",
    FEEDS,
)(
    lambda t: plain(
        cmd.apply_commands(_base(t["preferences"], cmd.PREFERENCES), _ok(t, "preference", cmd.PREFERENCES), cmd.PREFERENCES)[0]
    )
)

_CHANGES = f"""
    select event_id as seq, user_id as k, case when event_type = 'error' then 'D' else 'U' end as op, 'u' || event_id as cu, {_STAMP} as cd,
      case when event_id % 5 = 0 then '' else 'MON' end as days, event_id % 2 = 0 as ds
    from events where event_type in ('signup', 'purchase', 'error') and {_GOOD}"""
_STEPS = f"""
    select c.*, coalesce(lag(op) over (partition by k order by seq), case when p.web_user_master_id is null then 'D' else 'U' end) as before
    from ({_CHANGES}) c left join triggers p on p.web_user_master_id = c.k"""
_TRIGGER_STATE = f"""
    with s as ({_STEPS}),
    n as (select k, max(seq) as last, arg_max(op, seq) as op, arg_max(days, seq) as days, arg_max(ds, seq) as ds,
            max(seq) filter (op = 'U' and before = 'D') as made from s group by 1)
    select coalesce(p.web_user_master_id, n.k) as web_user_master_id,
      case when n.k is null then 'base@x.org' else 'm' || n.last || '@x.org|n@x.org' end as mail_id,
      case when n.k is null then 'TUE|WED' else n.days end as days,
      case when n.k is null then 'Open' else '' end as status_list,
      case when n.k is null then p.day_status else n.ds end as day_status,
      case when n.made is not null then 'u' || n.made else p.created_user end as created_user,
      case when n.made is not null then (select s.cd from s where s.seq = n.made) else strftime(p.created_date, '%Y-%m-%d %H:%M:%S') end as created_date,
      case when n.k is null then p.updated_user else 'w' || n.last end as updated_user, cast(null as varchar) as updated_date,
      cast(null as varchar) as last_trigger_date
    from triggers p full join n on n.k = p.web_user_master_id where n.k is null or n.op = 'U'"""


def _trigger_state(t):
    base = _base(t["triggers"], cmd.TRIGGERS)
    return cmd.apply_commands(base, _ok(t, "trigger", cmd.TRIGGERS), cmd.TRIGGERS)[0]


def _trigger_rows(state):
    lists = {c: F.array_join(c, "|") for c in ("mail_id", "days", "status_list")}
    return plain(state.withColumns(lists))


query("state_upsert_arrays", _TRIGGER_STATE, FEEDS)(lambda t: _trigger_rows(_trigger_state(t)))

query(
    "state_delete",
    f"""select * from ({_TRIGGER_STATE})""",
    FEEDS,
)(lambda t: _trigger_rows(_trigger_state(t)))

# what a store keeps of deletes: the last one of each key, and whether the key has come back since
query(
    "state_kept_deletes",
    f"""select k as web_user_master_id, max(seq) filter (op = 'D') as deleted_seq, arg_max(op, seq) = 'D' as gone
        from ({_CHANGES}) group by k having max(seq) filter (op = 'D') is not null""",
    FEEDS,
)(
    lambda t: state_store.still_matters(_ok(t, "trigger", cmd.TRIGGERS), cmd.TRIGGERS)
    .groupBy("web_user_master_id")
    .agg(F.max(F.when(F.col("method") == "D", F.col("seq"))).alias("deleted_seq"), (~F.bool_or(F.col("method") == "U")).alias("gone"))
    .filter("deleted_seq is not null")
)

query(
    "state_command_status",
    f"""select event_id as seq, coalesce(x.status, 'ERROR - INVALID METHOD') as status from events e left join (
          select seq, case when op = 'D' then 'SUCCESS - DELETED' when before = 'U' then 'SUCCESS - UPDATED' else 'SUCCESS - INSERTED' end as status
          from ({_STEPS})) x on x.seq = e.event_id where {_GOOD}""",
    FEEDS,
)(
    lambda t: cmd.command_statuses(_base(t["triggers"], cmd.TRIGGERS), _ok(t, "trigger", cmd.TRIGGERS), cmd.TRIGGERS).select(
        "seq", "status"
    )
)

query(
    "state_read",
    f"""select e.event_id as seq, coalesce(
          (select '["c' || max(u.seq) || '","d"]' from ({_UPSERTS}) u where u.k = e.user_id and u.seq < e.event_id),
          (select p.column_preferences from preferences p where p.web_user_master_id = e.user_id)) as status
        from events e where e.event_type = 'view' and e.event_id % 97 <> 0""",
    FEEDS,
)(
    lambda t: cmd.command_statuses(
        _base(t["preferences"], cmd.PREFERENCES), _ok(t, "preference", cmd.PREFERENCES), cmd.PREFERENCES
    )
    .filter("method = 'S'")
    .select("seq", "status")
)

query(
    "state_rejects",
    """select seq, method, payload, 'FAILED - bad value for web_user_master_id' as status from preference_commands where seq % 97 = 0""",
    FEEDS,
)(lambda t: cmd.parse_commands(t["preference_commands"], cmd.PREFERENCES)[1])


@query("stream_command_upsert", _TRIGGER_STATE, FEEDS)
def _(t):
    base = scratch_path(t.spark, "command-stream")
    # Two runs in time order, the second from the first one's checkpoint.
    commands = t["trigger_commands"]
    middle = commands.agg((F.max("seq") / 2).cast("long").alias("m"))
    state = _base(t["triggers"], cmd.TRIGGERS).select(*cmd.TRIGGERS.fields)
    for half in (F.col("seq") <= F.col("m"), F.col("seq") > F.col("m")):
        commands.join(F.broadcast(middle), half).drop("m").write.mode("append").parquet(f"{base}/in")
        upsert_stream(t.spark, f"{base}/in", state, f"{base}/out", f"{base}/checkpoint", cmd.TRIGGERS).awaitTermination()
    return _trigger_rows(latest_state(t.spark, f"{base}/out"))
