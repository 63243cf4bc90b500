"""Keyed state: batches of commands against one-by-one application."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cargolens.operators import commands as cmd
from cargolens.operators import state_store
from cargolens.session import names_under, scratch_root
from cargolens.sources.commits import content_of
from cargolens.streaming.commands import latest_state, upsert_stream, versions

TRIGGER_DDL = (
    "web_user_master_id long, created_user string, created_date timestamp_ntz, updated_user string, updated_date timestamp_ntz, "
    "mail_id array<string>, day_status boolean, days array<string>, status_list array<string>, last_trigger_date timestamp_ntz"
)
PREFERENCE_DDL = (
    "web_user_master_id long, column_preferences string, create_user string, create_date timestamp_ntz, update_user string, "
    "update_date timestamp_ntz, registration_no string, version int, customer_id long"
)


def trigger(key, user, **extra):
    return json.dumps({"webUserMasterId": key, "createUser": user, "updateUser": user, "mailId": [user], **extra})


def base_row(key):
    return (key, "base", datetime(2020, 1, 1), "base", None, ["base"], True, ["MON"], [], None)


def replay(base, rows):
    """Apply the commands one after another."""
    state, replies = {k: ("base", "base") for k in base}, {}
    for seq, method, key, user in sorted(rows):
        if method == "U":
            replies[seq] = cmd.UPDATED if key in state else cmd.INSERTED
            state[key] = (state[key][0] if key in state else user, user)
        elif method == "D":
            state.pop(key, None)
            replies[seq] = cmd.DELETED
        else:
            replies[seq] = cmd.INVALID
    return state, replies


def test_batch_equals_one_by_one(spark):
    rnd = random.Random(3)
    rows = []
    for seq in range(300):
        key = 1 if seq % 3 == 0 else rnd.randrange(12)
        rows.append((seq, rnd.choice("UUUDX"), key, f"u{seq}"))
    want_state, want_replies = replay([1, 2, 50], rows)
    base = spark.createDataFrame([base_row(k) for k in (1, 2, 50)], TRIGGER_DDL)
    feed = spark.createDataFrame([(s, m, trigger(k, u)) for s, m, k, u in rows], "seq long, method string, payload string")
    ok, rejects = cmd.parse_commands(feed.repartition(5), cmd.TRIGGERS)
    state, statuses = cmd.apply_commands(base, ok, cmd.TRIGGERS)
    assert rejects.count() == 0
    assert {r.web_user_master_id: (r.created_user, r.mail_id[0]) for r in state.collect()} == want_state
    assert {r.seq: r.status for r in statuses.collect()} == want_replies


def test_parse_and_reject(spark):
    payloads = [
        json.dumps({"webUserMasterId": "7", "columnPreferences": ["a", {"b": 1}], "createDate": "", "version": 3, "nxtCustomerId": ""}),
        json.dumps({"webUserMasterId": "x"}),
        json.dumps({"webUserMasterId": 7, "updateDate": "soon"}),
        "{broken",
        json.dumps({"webUserMasterId": 8, "columnPreferences": "text", "createDate": "2024-05-06 07:08:09"}),
    ]
    feed = spark.createDataFrame([(i, "U", x) for i, x in enumerate(payloads)], "seq long, method string, payload string")
    ok, rejects = cmd.parse_commands(feed, cmd.PREFERENCES)
    rows = {r.seq: r for r in ok.collect()}
    assert set(rows) == {0, 4}
    assert (rows[0].web_user_master_id, rows[0].version, rows[0].create_date, rows[0].customer_id) == (7, 3, None, None)
    assert json.loads(rows[0].column_preferences) == ["a", {"b": 1}]
    assert rows[4].column_preferences == '"text"' and rows[4].create_date == datetime(2024, 5, 6, 7, 8, 9)
    assert {r.seq: r.status for r in rejects.collect()} == {
        1: "FAILED - bad value for web_user_master_id",
        2: "FAILED - bad value for update_date",
        3: "FAILED - malformed payload",
    }
    assert all(r.payload for r in rejects.collect())


def test_arrays(spark):
    payload = json.dumps({"webUserMasterId": 1, "mailId": ["a@example.com", None], "dayStatus": True})
    bad = json.dumps({"webUserMasterId": 1, "mailId": "a@example.com"})
    feed = spark.createDataFrame([(1, "U", payload), (2, "U", bad)], "seq long, method string, payload string")
    ok, rejects = cmd.parse_commands(feed, cmd.TRIGGERS)
    [row] = ok.collect()
    assert row.mail_id == ["a@example.com", None] and row.days == [] and row.day_status is True
    assert [r.status for r in rejects.collect()] == ["FAILED - bad value for mail_id"]


def test_read_method_and_missing_key(spark):
    base = spark.createDataFrame([(1, '["old"]', "c", None, None, None, None, 1, None)], PREFERENCE_DDL)

    def pref(key, name):
        return json.dumps({"webUserMasterId": key, "columnPreferences": [name]})

    rows = [(1, "S", pref(1, "-")), (2, "U", pref(1, "new")), (3, "S", pref(1, "-")), (4, "S", pref(2, "-")), (5, "U", pref(None, "n")), (6, "D", pref(1, "-"))]
    ok, _ = cmd.parse_commands(spark.createDataFrame(rows, "seq long, method string, payload string"), cmd.PREFERENCES)
    state, statuses = cmd.apply_commands(base, ok, cmd.PREFERENCES)
    assert {r.seq: r.status for r in statuses.collect()} == {
        1: '["old"]', 2: cmd.UPDATED, 3: '["new"]', 4: None, 5: cmd.INSERTED, 6: cmd.INVALID,
    }
    assert sorted((r.web_user_master_id or 0, r.column_preferences, r.create_user or "") for r in state.collect()) == [
        (0, '["n"]', ""), (1, '["new"]', "c"),
    ]


def test_stream_applies_each_file_once(spark, tmp_path):
    source, out, check = (str(tmp_path / d) for d in ("in", "out", "check"))
    base = spark.createDataFrame([base_row(5)], TRIGGER_DDL)
    scratch = f"{scratch_root(spark)}/cargolens"
    before = set(names_under(spark, scratch))

    def send(*rows):
        df = spark.createDataFrame(rows, "seq long, method string, payload string")
        df.coalesce(1).write.mode("append").parquet(source)
        upsert_stream(spark, source, base, out, check, cmd.TRIGGERS).awaitTermination()
        return {r.web_user_master_id: r.created_user for r in latest_state(spark, out).collect()}

    assert send((1, "U", trigger(1, "a")), (2, "U", trigger(2, "b"))) == {5: "base", 1: "a", 2: "b"}
    assert send((3, "U", trigger(1, "c")), (4, "D", trigger(2, "c")), (5, "D", trigger(5, "c"))) == {1: "a"}
    upsert_stream(spark, source, base, out, check, cmd.TRIGGERS).awaitTermination()
    assert latest_state(spark, out).count() == 1
    replies = spark.read.parquet(f"{out}/replies").orderBy(F.col("seq"))
    assert [r.status for r in replies.collect()] == [cmd.INSERTED, cmd.INSERTED, cmd.UPDATED, cmd.DELETED, cmd.DELETED]
    assert sorted(versions(spark, out)) == [1, 2]
    assert set(names_under(spark, scratch)) == before
    with pytest.raises(ValueError, match="another checkpoint"):
        upsert_stream(spark, source, base, out, str(tmp_path / "check2"), cmd.TRIGGERS)


def typed(spark, rows, make):
    feed = spark.createDataFrame([(s, m, make(k, u)) for s, m, k, u in rows], "seq long, method string, payload string")
    return feed


def fill(spark, out, batches, base, feed, make=trigger, buckets=4):
    state_store.start_store(spark, out, base, feed, buckets)
    for n, rows in enumerate(batches):
        ok, _ = cmd.parse_commands(typed(spark, rows, make), feed)
        assert state_store.apply_batch(ok, n, out, feed)
    return state_store.read_state(spark, out)


@pytest.mark.parametrize("seed", range(4))
def test_any_split_and_order_gives_one_state(spark, tmp_path, seed):
    """Late files find their place: state and created fields are those of all commands in order."""
    rnd = random.Random(seed)
    rows = [(seq, rnd.choice("UUUDDX"), 1 if seq % 3 == 0 else rnd.randrange(9), f"u{seq}") for seq in range(70)]
    want, _ = replay([1, 2, 50], rows)
    base = spark.createDataFrame([base_row(k) for k in (1, 2, 50)], TRIGGER_DDL)
    rnd.shuffle(rows)
    cuts = sorted(rnd.sample(range(1, 70), 2))
    batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 70], strict=True)]
    batches.append(batches[0][:5])  # sent again
    state = fill(spark, str(tmp_path), batches, base, cmd.TRIGGERS)
    assert {r.web_user_master_id: (r.created_user, r.mail_id[0]) for r in state.collect()} == want


def test_feed_without_deletes_in_any_order(spark, tmp_path):
    def make(key, user):
        return json.dumps({"webUserMasterId": key, "columnPreferences": [user], "createUser": user})

    base = spark.createDataFrame([(7, '["old"]', "c", None, None, None, None, 1, None), (None, '["x"]', "n", None, None, None, None, 1, None)], PREFERENCE_DDL)
    rows = [(5, "U", 1, "e"), (9, "U", 7, "i"), (2, "U", 1, "b"), (8, "U", 1, "h"), (3, "U", None, "n3"), (3, "U", None, "n3"), (4, "U", 7, "d"), (6, "S", 1, "-")]
    state = fill(spark, str(tmp_path), [rows[:2], rows[2:5], rows[5:]], base, cmd.PREFERENCES, make)
    assert sorted((r.web_user_master_id or 0, r.column_preferences, r.create_user) for r in state.collect()) == [
        (0, '["n3"]', "n3"), (0, '["x"]', "n"), (1, '["h"]', "b"), (7, '["i"]', "c"),
    ]


def test_a_batch_of_one_key_changes_one_bucket(spark, tmp_path):
    out = str(tmp_path)
    base = spark.createDataFrame([base_row(k) for k in range(40)], TRIGGER_DDL)
    fill(spark, out, [[(1, "U", 3, "a"), (2, "D", 3, "b"), (3, "U", 3, "c")]], base, cmd.TRIGGERS, buckets=8)
    first, second = (content_of(spark, state_store.manifests(out), n)["live"] for n in (0, 1))
    assert len(first) == 8 and [b for b in first if first[b] != second[b]] != []
    assert sum(first[b] != second[b] for b in first) == 1
    assert [n for n in names_under(spark, f"{out}/state/batch=0") if n.startswith("bucket=")] == [
        f"bucket={b}" for b in first if first[b] != second[b]
    ]
    assert state_store.read_state(spark, out).count() == 40


def test_a_stopped_batch_leaves_the_state_and_its_retry_counts_once(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    base = spark.createDataFrame([base_row(k) for k in (1, 2)], TRIGGER_DDL)
    fill(spark, out, [], base, cmd.TRIGGERS)
    ok, _ = cmd.parse_commands(typed(spark, [(1, "U", 1, "a"), (2, "D", 2, "b"), (3, "U", None, "c")], trigger), cmd.TRIGGERS)

    def users():
        return sorted((r.web_user_master_id or 0, r.updated_user) for r in state_store.read_state(spark, out).collect())

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(state_store, "publish", stop)
        with pytest.raises(RuntimeError):
            state_store.apply_batch(ok, 0, out, cmd.TRIGGERS)
    assert users() == [(1, "base"), (2, "base")]
    assert state_store.apply_batch(ok, 0, out, cmd.TRIGGERS)
    assert not state_store.apply_batch(ok, 0, out, cmd.TRIGGERS)
    assert users() == [(0, "c"), (1, "a")]


def test_all_keys_deleted(spark, tmp_path):
    base = spark.createDataFrame([base_row(1)], TRIGGER_DDL)
    state = fill(spark, str(tmp_path), [[(1, "D", 1, "a")]], base, cmd.TRIGGERS)
    assert state.collect() == [] and set(state.columns) == set(cmd.TRIGGERS.fields)


def test_scratch_folder_is_shared():
    """A named folder is taken as it is; a warehouse on the local disk only in local mode."""

    class Session:
        def __init__(self, master, named=None, warehouse="file:/w", checkpoint=None):
            self.conf = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": warehouse}
            self.sparkContext = self
            self.master, self.getCheckpointDir = master, lambda: checkpoint

    assert scratch_root(Session("local[4]")) == "file:/w/_scratch"
    assert scratch_root(Session("local-cluster[2,1,1024]")) == "file:/w/_scratch"
    assert scratch_root(Session("yarn", named="file:/shared/")) == "file:/shared"
    assert scratch_root(Session("yarn", checkpoint="hdfs:/c")) == "hdfs:/c"
    assert scratch_root(Session("yarn", warehouse="hdfs:/w")) == "hdfs:/w/_scratch"
    with pytest.raises(ValueError):
        scratch_root(Session("yarn"))


def test_state_delete_returns_the_whole_state(spark, tmp_path):
    from cargolens.catalog import QUERIES

    spark.createDataFrame([(3,), (6,), (9,), (10,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    events = [(1, 3, "error"), (2, 6, "error"), (4, 6, "signup"), (5, 11, "purchase"), (7, 12, "signup"), (8, 12, "error")]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    rows = QUERIES["state_delete"](spark, str(tmp_path)).collect()
    got = {r.web_user_master_id: (r.created_user, r.updated_user, r.mail_id) for r in rows}
    assert got == {
        6: ("u4", "w4", "m4@x.org|n@x.org"),
        9: ("creator", "updater", "base@x.org"),
        11: ("u5", "w5", "m5@x.org|n@x.org"),
    }


@pytest.mark.parametrize("feed", [cmd.TRIGGERS, cmd.PREFERENCES])
def test_state_of_what_matters_is_that_of_all_commands(spark, feed):
    """Worked out from the commands kept, without looking up what stood before each command."""
    rnd = random.Random(7)
    payload = {"webUserMasterId": None, "columnPreferences": [1], "mailId": ["a"]}
    rows = []
    for seq in range(120):
        who = {"webUserMasterId": rnd.choice([*range(12), None]), "createUser": rnd.choice([f"c{seq}", None]), "updateUser": f"u{seq}"}
        rows.append((seq, rnd.choice("UUUDS"), json.dumps(payload | who)))
    ok, _ = cmd.parse_commands(spark.createDataFrame(rows, "seq long, method string, payload string"), feed)
    want, _ = cmd.apply_commands(spark.createDataFrame([], ok.select(*feed.fields).schema), ok, feed)
    state = state_store.state_of(state_store.still_matters(ok, feed).withColumn("bucket", F.lit(0)), feed)
    assert "_range_" not in state._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, state.select(*feed.fields).collect())) == sorted(map(str, want.select(*feed.fields).collect()))
