"""Plan guards: the physical plans keep the scale properties the design
relies on (checked on the sf0.001 tables)."""

import os
import re

import pytest

import __spark_entry__ as E

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
PYTHON_OK = {"rank_script"}  # the user-script surface (Z1) is Python by design


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_no_cartesian_no_python(spark, key):
    plan = _plan(E.queries()[key](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key
    if key not in PYTHON_OK:
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas",
                             plan), key


def test_trend_table_one_sort_two_exchanges(spark):
    plan = _plan(E.queries()["trend_table"](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Window ") == 2 and plan.count("Sort [") == 1


def test_top_per_day_limits_before_shuffle(spark):
    plan = _plan(E.queries()["top_per_day"](spark, SF))
    assert plan.count("WindowGroupLimit") == 2  # partial (before Exchange) + final


@pytest.mark.parametrize("key", ["top_24h", "top_30d", "recent_hours"])
def test_time_window_reaches_the_scan(spark, key):
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", _plan(E.queries()[key](spark, SF)))
    assert any("GreaterThanOrEqual(" in p for p in pushed), pushed


@pytest.mark.parametrize("key", ["ns_filter", "lowercase_filter", "ext_filter", "strict_ext",
                                 "space_filter", "blacklist", "valid_title", "clean_nonempty"])
def test_title_rules_drop_rows(spark, key):
    from trafficlens.plans import registered as R
    assert E.queries()[key](spark, SF).count() < R.v6_pages(spark, SF).count()


def test_search_by_title_reads_one_bucket(spark, capsys):
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(auto, "false")  # the plan then names the buckets; files are pruned either way
    try:
        E.queries()["trend_of_title"](spark, SF).explain("formatted")
    finally:
        spark.conf.unset(auto)
    assert "SelectedBucketsCount: 1 out of 16" in capsys.readouterr().out


def test_entry_2_reads_the_files_of_its_hours(spark):
    from trafficlens.plans import batch_trends as BT
    from trafficlens.session import fresh_path
    from trafficlens.sources import pagecounts as PC
    root, out = fresh_path(spark, "t_latest"), fresh_path(spark, "t_latest_out")
    lines = spark.createDataFrame([("en A 1 1", f"201503010{h}0000") for h in range(6)],
                                  "value string, stamp string")
    PC.write_pagecount_files(lines, root)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = BT.run_latest(spark, root, out=out, first=2, last=3)
        assert sorted(r.dt for r in df.collect()) == ["20150301020000", "20150301030000"]
        assert _scan_metric(df._jdf.queryExecution().executedPlan(), "numFiles") == 2  # of 6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert spark.read.text(out).count() == 1


def test_every_reject_reason_occurs(spark):
    got = {r.status for r in E.queries()["rejects"](spark, SF).collect()}
    assert got == {"shape", "keyword", "title", "empty", "count"}


def test_new_pages_enter_without_history(spark):
    from trafficlens.operators import timelines as TL
    from trafficlens.plans import registered as R
    hist, new = R.split_history(R.v8_page_counts(spark, SF), R.v8(spark, SF), days=1500)
    matched = TL.merge_timelines(TL.timelines_from_counts(hist), new)
    assert matched.count() < E.queries()["timeline_merge_keep_new"](spark, SF).count()


def test_scan_prunes_columns(spark):
    plan = _plan(E.queries()["daily_counts"](spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(x.split(":")[0] for x in schema.split(",")) == {"ts", "event_type"}


def test_file_hours_pruned_before_read(spark):
    from trafficlens.session import fresh_path
    from trafficlens.sources import pagecounts as PC
    root = fresh_path(spark, "t_prune")
    lines = spark.createDataFrame([("en A 1 1", f"201503010{h}0000") for h in range(5)],
                                  "value string, stamp string")
    PC.write_pagecount_files(lines, root)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # plain plan: the scan node is reachable
    try:
        df = PC.read_pagecounts(spark, root, hours=("2015-03-01 02:00:00", "2015-03-01 02:00:00"))
        assert [r.stamp for r in df.collect()] == ["20150301020000"]
        assert _scan_metric(df._jdf.queryExecution().executedPlan(), "numFiles") == 1  # 1 of 5 read
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def _scan_metric(node, key):
    if "Scan" in node.nodeName() and node.metrics().get(key).isDefined():
        return node.metrics().get(key).get().value()
    kids = node.children()
    for i in range(kids.size()):
        v = _scan_metric(kids.apply(i), key)
        if v is not None:
            return v
    return None
