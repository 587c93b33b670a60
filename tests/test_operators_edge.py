"""Edge cases of operators the fixtures do not pin down."""

import datetime as dt

from trafficlens.operators import gaps as G
from trafficlens.operators import ranking as RK
from trafficlens.operators import topn as TN
from trafficlens.operators import trends as T
from trafficlens.sources import dumps as DP


def _hourly(spark, rows):
    return spark.createDataFrame([(t, dt.datetime(2015, 3, 1, h), v) for t, h, v in rows],
                                 "title string, ts timestamp_ntz, views bigint")


def test_missing_hours_global_and_per_key(spark):
    df = _hourly(spark, [("A", 0, 1), ("A", 3, 1), ("B", 1, 1)])
    glob = sorted(r.ts.hour for r in G.missing_hours(df, "ts").collect())
    assert glob == [2]
    per = sorted((r.title, r.ts.hour) for r in G.missing_hours(df, "ts", by="title").collect())
    assert per == [("A", 1), ("A", 2)]


def test_fill_gaps_inserts_zero_days(spark):
    c = spark.createDataFrame([("A", "20150301", 5), ("A", "20150304", 7)], "title string, dt string, views bigint")
    got = sorted((r.dt, r.views) for r in G.fill_gaps(c).collect())
    assert got == [("20150301", 5), ("20150302", 0), ("20150303", 0), ("20150304", 7)]


def test_consecutive_ratio_zero_previous(spark):
    df = _hourly(spark, [("A", 0, 0), ("A", 1, 4), ("A", 2, 2)])
    got = sorted((r.ts.hour, r.prev_ts.hour, r.ratio) for r in RK.consecutive_ratio(df).collect())
    assert got == [(1, 0, 3.0), (2, 1, -0.5)]


def test_trend_search_exact_and_pattern(spark):
    c = spark.createDataFrame([("A_b", "20150301", 1), ("A_c", "20150301", 2), ("B", "20150301", 3)],
                              "title string, dt string, views bigint")
    t = T.trend_table(c)
    assert [r.title for r in TN.trend_search(t, title="A_b").collect()] == ["A_b"]
    assert sorted(r.title for r in TN.trend_search(t, pattern="^A_").collect()) == ["A_b", "A_c"]


def test_top_per_group_ties_break_by_title(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("d", "B", 1.0), ("d", "A", 1.0), ("d", "C", 0.5)],
                               "dt string, title string, daily_trend double")
    got = TN.top_per_group(df, "dt", 2, [F.col("daily_trend").desc(), F.col("title").asc()]).collect()
    assert sorted((r.rank, r.title) for r in got) == [(1, "A"), (2, "B")]


def test_dump_null_and_escapes(spark):
    line = r"""INSERT INTO `redirect` VALUES (7,0,NULL),(8,0,'a\\b'),(9,0,'x,y');"""
    got = sorted(tuple(r) for r in DP.parse_tuples(
        DP.dump_tuples(spark.createDataFrame([(line,)], "value string")), DP.REDIRECT_SCHEMA).collect())
    assert got == [(7, 0, None), (8, 0, "a\\b"), (9, 0, "x,y")]


def test_hours_and_days_ignore_session_zone(spark):
    """A wall-clock time inside a daylight-saving gap of the session zone keeps
    its hour and day."""
    from trafficlens.operators import counts as C
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("A", dt.datetime(2015, 3, 8, 2, 30), 1)],
                                   "title string, ts timestamp_ntz, views bigint")
        assert C.hourly_counts(df).collect()[0].ts == dt.datetime(2015, 3, 8, 2, 0)
        assert C.daily_counts(df).collect()[0].dt == "20150308"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
