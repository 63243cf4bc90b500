"""Filters, scalar functions and joins on small rows, with their NULL rules."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cargolens.functions import text as fx
from cargolens.operators import joins
from cargolens.operators import predicates as p
from cargolens.operators.aggregates import container_rollup, margin_pct, next_id, presence_split, status_counts


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.fixture(scope="module")
def files(spark):
    rows = [
        (1, "ABC1.XML", datetime(2024, 1, 1, 0, 0)),
        (2, "abc2.xml", datetime(2024, 1, 31, 23, 59, 59)),
        (3, None, datetime(2024, 2, 1, 0, 0)),
    ]
    return spark.createDataFrame(rows, "id int, name string, ts timestamp_ntz")


def test_search(spark, files):
    assert ids(p.search_contains(files, "name", "abc")) == [1]
    assert ids(p.search_contains(files, "name", "abc", upper=False)) == [2]
    assert ids(p.search_contains(files, "name", "")) == [1, 2]
    assert ids(p.search_contains(files, "name", None)) == []
    odd = spark.createDataFrame([(1, "A_B"), (2, "AXB"), (3, "A%B"), (4, "A\\B"), (5, "A\\_B")], "id long, name string")
    found = {q: ids(p.search_contains(odd, "name", q)) for q in ("a_b", "a%b", r"a\_b", r"a\%b", r"a\\b", r"a\b", "\\")}
    assert found == {"a_b": [1, 2, 3, 4], "a%b": [1, 2, 3, 4, 5], r"a\_b": [1], r"a\%b": [3], r"a\\b": [4], r"a\b": [], "\\": []}


def test_date_filters(files):
    assert ids(p.date_window(files, "ts", date(2024, 1, 31))) == [1, 2]
    assert ids(p.date_window(files, "ts", date(2024, 2, 5), to=date(2024, 1, 30))) == [1]
    assert ids(p.lookback(files, "ts", 1, date(2024, 2, 1))) == [2, 3]
    assert ids(p.lookback(files, "ts", None, date(2024, 2, 1))) == []
    assert ids(p.open_range(files, "ts", None, date(2024, 1, 31))) == [1, 2]
    assert ids(p.open_range(files, "ts", date(2024, 1, 2), date(2024, 2, 1))) == [2, 3]
    assert ids(p.open_range(files, "ts", date(2024, 1, 2), None)) == []


def test_optional_and_pair(spark):
    df = spark.createDataFrame([(1, "A", "B"), (2, "A", "C"), (3, None, "B")], "id int, a string, b string")
    assert ids(p.optional_eq(df, "a", None)) == [1, 2, 3]
    assert ids(p.optional_eq(df, "a", "A")) == [1, 2]
    assert ids(p.pair_or_all(df, "a", "b", "A", "B")) == [1]
    assert ids(p.pair_or_all(df, "a", "b", "", None)) == [1, 2, 3]
    assert ids(p.pair_or_all(df, "a", "b", "A", None)) == []
    assert ids(p.pair_or_all(df, "a", "b", "A", "")) == []


def test_booking_states(spark):
    rows = [(1, 10, 4, 6, 5, 5, 0), (2, 10, 0, 6, 5, 1, 1), (3, None, 0, 0, None, 0, 0)]
    df = spark.createDataFrame(
        rows, "id int, provisionRevenue int, wipRevenue int, pnlIncome int, provisionCost int, wipCost int, pnlCost int"
    )
    assert ids(p.booking_state(df, None)) == ids(p.booking_state(df, "All_Shipment")) == [1, 2, 3]
    assert ids(p.booking_state(df, "Fully_Revenue_Booked")) == [1]
    assert ids(p.booking_state(df, "Partial_Revenue_Booked")) == [2]
    assert ids(p.booking_state(df, "Fully_Cost_Booked")) == [1]
    assert ids(p.booking_state(df, "Partial_cost_Booked")) == [2]
    assert ids(p.booking_state(df, "Partial_Cost_Booked")) == []


def one(spark, column, ddl="x string", value=None):
    return spark.createDataFrame([(value,)], ddl).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value, want",
    [("0.454", ".454"), ("2072.92", "2072.920"), ("0", ".000"), ("-0.5", "-.500"), ("1000000", "#" * 11), (None, None)],
)
def test_fixed_three(spark, value, want):
    assert one(spark, fx.fixed_three(F.col("x").cast("decimal(18,4)")), value=value) == want


def test_text_functions(spark):
    x = F.col("x")
    assert one(spark, fx.in_parentheses(x), value="Sea (FCL/FCL) (b)") == "FCL/FCL"
    assert one(spark, fx.in_parentheses(x), value="Sea") is None
    assert one(spark, fx.squeeze(x), value="a \n\t b  c") == "a b c"
    assert one(spark, fx.split_number(x), value="12345678") == "123-45678"
    assert one(spark, fx.without_last(x), value="ABCU1234567") == "ABCU123456"
    assert one(spark, fx.blank_to_null(x), value="  ") is None
    assert one(spark, fx.oracle_concat("a", x, "b")) == "ab"
    assert one(spark, F.concat(F.lit("a"), x)) is None
    assert one(spark, fx.address_line(x, x, F.lit("C"), x)) == "  C "
    assert one(spark, fx.full_address(F.lit("1"), x, F.lit("C"))) == "1,,C"
    assert one(spark, fx.xml_escape(x), value="a<b & c>") == "a&lt;b &amp; c&gt;"
    assert one(spark, fx.json_text(F.struct(x, F.lit(1).alias("y")))) == '{"x":null,"y":1}'
    assert one(spark, p.list_value(x, F.lit("c"))) is None


@pytest.mark.parametrize("word, want", [("Y", True), ("on", True), ("1", True), (" FALSE ", False), ("off", False), ("maybe", None)])
def test_booleans(spark, word, want):
    assert one(spark, fx.to_boolean(F.col("x")), value=word) is want


def test_whole_days_truncates_toward_zero(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1), datetime(2024, 1, 3, 12)), (datetime(2024, 1, 3, 12), datetime(2024, 1, 1))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    days = [r.d for r in df.select(fx.whole_days(F.col("b"), F.col("a")).alias("d")).collect()]
    assert days == ["2 Days", "-2 Days"]


def test_date_patterns(spark):
    ts = F.lit(datetime(2025, 9, 5, 7, 8, 9, 123456)).cast("timestamp_ntz")
    row = spark.range(1).select(
        fx.short_upper_date(ts).alias("a"),
        F.date_format(ts, fx.DAY_MONTH_YEAR).alias("b"),
        F.date_format(ts, fx.ISSUE_STAMP).alias("c"),
        F.date_format(ts, fx.REPLY_STAMP).alias("d"),
        F.date_format(ts, fx.COMPACT_DATE).alias("e"),
    ).first()
    assert tuple(row) == (
        "05-SEP-25", "05-Sep-2025", "2025-09-05T07:08:09.1234560Z", "2025-09-05T07:08:09.123+05:30", "250905",
    )


@pytest.mark.parametrize("listed", [[1, 2], [1, None], [], [None]])
def test_membership_matches_sql(spark, listed):
    df = spark.createDataFrame([(1,), (3,), (None,)], "a int")
    keys = spark.createDataFrame([(x,) for x in listed], "b int")
    got = {r.a: r.f for r in joins.membership_flags(df, "a", {"other": df, "f": keys}).collect()}
    df.createOrReplaceTempView("member_rows")
    keys.createOrReplaceTempView("member_keys")

    def keep(test):
        sql = f"select a, case when a {test} (select b from member_keys) then 1 else 0 end f from member_rows"
        return {r.a: r.f for r in spark.sql(sql).collect()}

    inside, outside = keep("in"), keep("not in")
    for a, flag in got.items():
        assert (flag is True) == (inside[a] == 1)
        assert (flag is False) == (outside[a] == 1)


def test_child_sums_equal_the_full_join(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    a = spark.createDataFrame([(1, 5), (1, 7), (2, 1)], "fk int, x int")
    b = spark.createDataFrame([(1, 2), (1, 3), (1, None)], "fk int, y int")
    sums = {"sx": ("a", "x"), "sy": ("b", "y")}
    wide = joins.child_sums(parent, {"a": a, "b": b}, "id", "fk", sums)
    full = (
        parent.join(a.withColumnRenamed("fk", "fa"), F.col("id") == F.col("fa"), "left")
        .join(b.withColumnRenamed("fk", "fb"), F.col("id") == F.col("fb"), "left")
        .groupBy("id").agg(F.sum("x").alias("sx"), F.sum("y").alias("sy"))
    )
    assert sorted(wide.collect()) == sorted(full.collect())
    plain = joins.child_sums(parent, {"a": a, "b": b}, "id", "fk", sums, fanout=False)
    assert {r.id: (r.sx, r.sy) for r in plain.collect()} == {1: (12, 5), 2: (1, None), 3: (None, None)}


def test_role_lookup_equals_role_join(spark):
    df = spark.createDataFrame([(1, 10, 11), (2, 11, None), (3, 99, 10)], "id int, a int, b int")
    dim = spark.createDataFrame([(10, "ten"), (11, "eleven")], "id int, name string")
    roles = {"x": "a", "y": "b"}
    keyed = dim.withColumnRenamed("id", "k")
    wide = joins.role_lookup(df, "id", roles, keyed, ["name"], dim_key="k").select("id", "x_name", "y_name")
    joined = joins.role_join(df, keyed, roles, ["name"], key="k", how="left").select("id", "x_name", "y_name")
    assert sorted(wide.collect()) == sorted(joined.collect())


def test_partner_lookup(spark):
    docs = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "id int, company_code string")
    partners = spark.createDataFrame(
        [("A", "S1", "IN"), ("A", "S0", "OUT"), ("B", None, "IN"), ("A", "S2", "IN")], "company_code string, sender_code string, sftp_type string"
    )
    found, rejects = joins.partner_lookup(docs, partners, ["company_code"])
    assert [(r.id, r.sender_code) for r in found.collect()] == [(1, "S1")]
    assert ids(rejects) == [2, 3]


def test_config_and_counts(spark):
    header = spark.createDataFrame([(1, "LINE_CODE"), (2, "AGENT_CODE")], "id int, config_key string")
    values = spark.createDataFrame([(1, "L1")], "config_header_id int, config_value string")
    row = joins.config_row(header, values, ["LINE_CODE", "AGENT_CODE", "NONE"]).first()
    assert tuple(row) == ("L1", None, None)
    empty = spark.createDataFrame([], "id long, status string")
    assert spark.range(1).select(next_id(empty, "id")).first()[0] == 1
    assert tuple(status_counts(empty, "status", {"ok": "Completed"}, "n").first()) == (0, 0)


def test_rollup_and_split(spark):
    boxes = spark.createDataFrame(
        [(1, "2", " 3750 "), (1, "1", " "), (1, "1", None)], "k int, teu string, kg string"
    )
    row = container_rollup(boxes, ["k"], "teu", "kg").first()
    assert (str(row.teu), str(row.tare_mt)) == ("4", "3.8")
    parent = spark.createDataFrame([(1, "g"), (2, "g")], "id int, g string")
    child = spark.createDataFrame([(1,), (1,)], "fk int")
    assert tuple(presence_split(parent, child, "id", "fk", ["g"]).first()) == ("g", 1, 1)


def test_margin(spark):
    df = spark.createDataFrame([(0.0, 5.0), (200.0, 50.0)], "r double, c double")
    assert [r.m for r in df.select(margin_pct(F.col("r"), F.col("c")).alias("m")).collect()] == [0.0, 75.0]


def test_trade(spark):
    df = spark.createDataFrame([("Transit", "Import"), ("Other", "Export"), (None, None)], "o string, s string")
    code = p.trade_code(F.col("o"), F.col("s"))
    out = df.select(code.alias("t"), p.default_consignee(code).alias("c")).collect()
    assert [tuple(r) for r in out] == [("Transit", "T9999"), ("Export", "D9999"), (None, "D9999")]
    assert one(spark, p.code_map(F.col("x"), {"Air": "A"}), value="air") is None
    assert one(spark, p.code_map(F.col("x"), {"Air": "A"}, default=""), value=None) == ""
