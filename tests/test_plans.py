"""What the plans must and must not contain."""

import re

import pytest

from cargolens.catalog import QUERIES
from cargolens.catalog.tables import NOW
from cargolens.operators import xml_shred as xs
from cargolens.operators.lists import gather_lines

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "rpt_daily_status", "rpt_wip", "rpt_inbound_log", "rpt_sales_enquiry", "rpt_sailing_schedule", "rpt_user_bundle",
        "doc_manifest_bol", "doc_air_house_list", "doc_530", "state_upsert_arrays", "join_config", "num_instalment",
    ],
)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert word not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["flt_date_window"](spark, SF_DIR))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan(QUERIES["agg_house_weight"](spark, SF_DIR))).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["l_orderkey", "l_quantity"]


def test_outer_join_becomes_inner(spark):
    assert "LeftOuter" not in plan(QUERIES["join_left_to_inner"](spark, SF_DIR))


@pytest.mark.parametrize("name", sorted(xs.TABLES))
def test_messages_are_parsed_once(spark, name):
    rows = spark.createDataFrame([("<M><Header><MessageID>1</MessageID></Header></M>",)], "xml_data string")
    good, _ = xs.split_malformed(xs.parse_messages(rows))
    assert plan(xs.shred_table(good, name, NOW)).count("from_xml(") == 1


@pytest.mark.parametrize("name", ["doc_manifest_con_ctr", "doc_customs_xml"])
def test_lines_are_numbered_in_one_reading(spark, name):
    assert "_range_bounds" not in plan(QUERIES[name](spark, SF_DIR))


def test_what_a_reply_shows_is_worked_out_once(spark):
    text = plan(QUERIES["rpt_wip_reply"](spark, SF_DIR))
    assert "l_extendedprice" not in text and "o_orderkey" not in text


def test_lines_are_dealt_once_and_gathered_there(spark):
    lines = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 1, "a"), (2, 1, None), (4, 1, "x")], "k long, no long, line string")
    names = spark.createDataFrame([(1, "A", 1), (1, "B", 2), (2, "C", 1), (3, "D", 1)], "k long, name string, times int")
    out = gather_lines(lines, "k", ["no"], names=names)
    assert sorted((r.name, r.content) for r in out.collect()) == [("A", "a\na\nb"), ("B", "a\na\na\na\nb\nb"), ("C", None)]
    alone = plan(gather_lines(lines, "k", ["no"]))
    # both halves of the aggregate stand above the only exchange
    assert alone.count("Exchange hashpartitioning") == 1 and alone.index("partial_collect_list") < alone.index("Exchange hashpartitioning")


def test_containers_are_dealt_by_their_shipment_once(spark):
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        text = plan(QUERIES["doc_manifest_con_ctr"](spark, SF_DIR))
    finally:
        spark.conf.set(conf, before)
    # neither to be grouped, nor to meet their types
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert not any("ctr_no" in keys for keys in dealt)
    assert text.count("container_sl_no") > 0 and text.index("hashpartitioning(shipment_id") < text.index("hashpartitioning(_mc")
    assert not any("_type" in keys and "container_sl_no" in rest for keys, rest in re.findall(r"Exchange hashpartitioning\(([^)]*)\)[^\n]*\n([^\n]*)", text))
