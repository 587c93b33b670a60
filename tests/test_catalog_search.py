"""Declared tables, overwriting, corrupt text rows, bucketed merge, script
over lines, exclusion tables, the title index."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trafficlens.functions import titles as X
from trafficlens.operators import rank_lines
from trafficlens.operators import ranking as RK
from trafficlens.operators import timelines as TL
from trafficlens.operators import title_index as TI
from trafficlens.operators import udf as U
from trafficlens.plans import registered as R
from trafficlens.session import fresh_path
from trafficlens.sources import catalog as CT
from trafficlens.sources.schemas import TABLES

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture()
def tables(spark):
    root = fresh_path(spark, "t_wh")
    return root, CT.create_tables(spark, "t_" + root.rsplit("-", 1)[1], root, TABLES,
                                  partition_by={"raw_daily_pagecounts_table": ["dates"]})


def test_declared_tables(spark, tables):
    _, names = tables
    assert len(names) == 9
    for name, (columns, _) in TABLES.items():
        got = {(c.name, c.dataType.upper()) for c in spark.catalog.listColumns(names[name])}
        assert got == {tuple(c.split()) for c in columns.split(", ")} and spark.table(names[name]).count() == 0
    CT.create_tables(spark, names["pages"].split(".")[0], "/nowhere")  # they are there already


def test_overwrite_whole_and_by_partition(spark, tables):
    _, names = tables
    name = names["raw_daily_pagecounts_table"]
    df = lambda r: spark.createDataFrame(r, "pageviews string, dates string, redirect_title string, extra int")
    CT.insert_overwrite(df([("1", "d1", "A", 0), ("2", "d2", "A", 0), ("3", "d2", "B", 0)]), name)
    assert rows(spark.table(name)) == [("A", "1", "d1"), ("A", "2", "d2"), ("B", "3", "d2")]
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    for mode in ("static", "dynamic"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        CT.overwrite_partitions(df([("9", "d2", "C", 0), ("8", "d3", "C", 0)]), name)
        assert rows(spark.table(name)) == [("A", "1", "d1"), ("C", "8", "d3"), ("C", "9", "d2")]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    CT.insert_overwrite(df([("7", "d7", None, 0)]), name)
    assert rows(spark.table(name)) == [(None, "7", "d7")]
    with pytest.raises(ValueError):
        CT.insert_overwrite(spark.range(1), name)
    with pytest.raises(ValueError):
        CT.overwrite_partitions(df([]), names["pages"])


def test_a_table_replaced_by_a_result_that_reads_it(spark, tables):
    root, names = tables
    name = names["daily_pagecounts_table"]
    CT.insert_overwrite(spark.createDataFrame([(1, "d", "1"), (2, "d", "2")], "page_id bigint, dates string, pageviews string"), name)
    path = CT.replace_from(spark, name, lambda t: t.union(t.withColumn("page_id", F.col("page_id") + 10)), root)
    assert rows(spark.table(name)) == [(1, "d", "1"), (2, "d", "2"), (11, "d", "1"), (12, "d", "2")] or \
        {r.page_id for r in spark.table(name).collect()} == {1, 2, 11, 12}
    assert all(path in f for f in spark.table(name).inputFiles())

    def fails(t):
        return t.withColumn("page_id", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception):
        CT.replace_from(spark, name, fails, root)
    assert spark.table(name).count() == 4  # the old version holds
    with pytest.raises(ValueError):
        CT.replace_from(spark, names["raw_daily_pagecounts_table"], lambda t: t, root)


def test_corrupt_rows_score_zero(spark):
    text = [(1, "[20150301,20150302]", "[1,2]", "3"), (2, "[20150301", "[1]", "1"), (3, "[20150301]", "[1,2]", "3"), (4, None, "[1]", "1"),
            (5, "[20150301]", "[x]", "5"), (6, "[]", "[]", "0"), (7, "[20150301]", "[null]", "1"), (8, "[20150301]", "[4]", "x"),
            (None, "nonsense", "", None)]
    df = spark.createDataFrame(text, "page_id bigint, dates string, pageviews string, total_pageviews string")
    good, bad = TL.split_corrupt(df)
    assert rows(good) == [(1, ["20150301", "20150302"], [1, 2], 3), (6, [], [], 0), (8, ["20150301"], [4], None)]
    assert {r.page_id for r in bad.collect()} == {2, 3, 4, 5, 7, None}
    scored = RK.rank_arrays(TL.parse_timelines(bad)).collect()
    assert all((r.monthly_trend, r.daily_trend, r.error) == (0.0, 0.0, 0.0) for r in scored)


def test_bucketed_merge_moves_new_counts_only(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        hist, new = R.stored_timelines(spark, SF, 16)
        plan = TL.merge_timelines(hist, new)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    join = plan.index("SortMergeJoin")
    left = plan[join:plan.index("tl_timelines_")]  # the plan prints the left side first
    assert "Exchange" not in left and "Bucketed: true" in plan
    assert "Exchange hashpartitioning(page_id" in plan[plan.index("tl_timelines_"):]  # the new counts


def test_line_transform(spark):
    df = spark.createDataFrame([(1, "[" + ",".join(f"201503{d:02d}" for d in range(1, 17)) + "]", "[" + ",".join(map(str, range(5, 21))) + "]", 200),
                                (2, "[20150301]", "[1]", 1), (3, "broken", "[1]", 1), (4, "[1,2]", None, 5)],
                               "page_id bigint, dates string, pageviews string, total_pageviews bigint")
    got = {r.page_id: r for r in U.line_transform(df.repartition(3), U.RANK_LINES, U.RANK_SCHEMA).collect()}
    good, _ = TL.split_corrupt(df.withColumn("total_pageviews", F.col("total_pageviews").cast("string")))
    want = RK.rank_arrays(good.where("page_id = 1")).first()
    assert abs(got[1].daily_trend - want.daily_trend) < 1e-9 and got[1].monthly_trend == want.monthly_trend
    assert got[1].error == want.error and got[1].total_pageviews == 200
    assert all((got[k].monthly_trend, got[k].daily_trend, got[k].error) == (0.0, 0.0, 0.0) for k in (2, 3, 4)) and len(got) == 4
    assert rank_lines.score([1], [1], 1) == (0.0, 0.0, 0.0)
    assert U.line_transform(df.limit(0), U.RANK_LINES, U.RANK_SCHEMA).count() == 0


@pytest.mark.parametrize("limit", [0, 8 << 20])
def test_exclusion_table(spark, limit):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("B", 3), (None, 4), ("a", 5)], "title string, v int")
    out = spark.createDataFrame([("B",), ("B",), (None,), ("zz",)], "name string")
    assert [r.v for r in X.exclude_titles(df, out, excluded="name", broadcast_bytes=limit).orderBy("v").collect()] == [1, 4, 5]
    assert X.exclude_titles(df, out.limit(0), excluded="name", broadcast_bytes=limit).count() == 5


def test_required_grams():
    assert TI.required_grams("^Customer_0+[1-9]?77$") == sorted({"Cus", "ust", "sto", "tom", "ome", "mer", "er_"})
    assert TI.required_grams("abcd|efgh") == [] and TI.required_grams("(?i)abcd") == [] and TI.required_grams("ab") == []
    assert TI.required_grams("(abc)+x*(def)?ghi") == ["abc", "ghi"] and TI.required_grams("a.*bcd\\.e") == [".e"][:0] + ["bcd", "cd.", "d.e"]
    assert TI.required_grams("(((") == []


@settings(max_examples=150, deadline=None)
@given(st.from_regex(r"(ab|c){0,3}[a-c]{2,4}(bca)?(c+ab){1,2}", fullmatch=True))
def test_grams_are_in_every_match(text):
    for pattern in (r"(ab|c){0,3}[a-c]{2,4}(bca)?(c+ab){1,2}", r"cab$", r"[a-c]+ab"):
        if re.search(pattern, text):
            assert all(g in text for g in TI.required_grams(pattern))


def test_title_index(spark, capsys):
    titles = ["Main_Page", "Pagan", "page", "Paging", "xPagex", "日本語版", "ab", "", None, "Pag", "P.g", "Pa", "Main_Page"]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(titles)], "title string, v int")
    path = fresh_path(spark, "t_grams")
    name = TI.write_title_index(df, "t_grams_" + path.rsplit("-", 1)[1], path)
    for pattern in ("Page", "^Pag", "ag", "本語", "日本語", "P\\.g", "zzz", "Pag(e|an)", "Main.*age$", "(?i)page", "e\\x$"):
        try:
            re.compile(pattern)
        except re.error:
            continue
        want = sorted(i for i, t in enumerate(titles) if t is not None and re.search(pattern, t))
        assert sorted(r.v for r in TI.trend_search_indexed(df, name, pattern).collect()) == want, pattern
    # only the buckets of the rarest grams are read
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(auto, "false")
    try:
        TI.candidates(spark, name, "Main_Page").explain("formatted")
    finally:
        spark.conf.unset(auto)
    found = re.search(r"SelectedBucketsCount: (\d+) out of 64", capsys.readouterr().out)
    assert found and int(found[1]) <= 3
