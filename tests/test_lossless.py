"""Text and sink paths keep what they were given."""

import pytest

from trafficlens.operators import documents as D
from trafficlens.operators import timelines as TL
from trafficlens.operators.trends import trend_table
from trafficlens.sources import dumps as DP
from trafficlens.sources import text_tables as TT
from trafficlens.sources import trend_lines as TLN
from trafficlens.streaming import hourly as HS

ODD = ["a|b", "line\nbreak", "cr\rhere", "%7C", "100%25", "back\\slash", "\\N", "\\s", "", "it's \"q\"", "(x),(y)"]


def test_zero_counts_and_odd_titles_stay_on_their_dates(spark, tmp_path):
    rows = [(t, f"2015030{d}", v) for t in ODD for d, v in enumerate((4, 0, 5, 10, 5), 1)]
    trends = trend_table(spark.createDataFrame(rows, "title string, dt string, views bigint"))
    TLN.write_trend_lines(trends, str(tmp_path / "lines"))
    read = TLN.read_trend_lines(spark, str(tmp_path / "lines"))
    assert read.where("bad").count() == 0
    direct = {(r.title, str(r.page_date)): (r.page_views, r.daily_trend) for r in D.search_documents(trends).collect()}
    lines = {(r.title, str(r.page_date)): (r.page_views, r.daily_trend)
             for r in D.documents_from_series(read).collect()}
    assert lines == direct
    assert [lines["%7C", f"2015-03-0{d}"][1] for d in range(1, 6)] == [0.0, -1.0, None, 1.0, -0.5]


def test_short_or_wrong_lists_are_bad(spark):
    good = "t|20150301,20150302|1,2|0.0,1.0|0.0|0.0|"
    lines = [good, good.replace("0.0,1.0", "0.0"), good.replace("1.0", "x"), good.replace("1,2", "1,y"), "t|"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert [r.bad for r in TLN.parse_lines(df).collect()] == [False, True, True, True, True]


def test_views_above_int_range(spark):
    df = spark.createDataFrame([("t", "20150301", 3_000_000_000)], "title string, dt string, views bigint")
    assert D.search_documents(trend_table(df)).first().page_views == 3_000_000_000


@pytest.mark.parametrize("sep", ["|", "\t", ","])
def test_delimited_round_trip(spark, tmp_path, sep):
    rows = [(i, t) for i, t in enumerate(ODD + [sep, None])]
    TT.write_delimited(spark.createDataFrame(rows, "i bigint, t string"), str(tmp_path / "t"), sep)
    got = TT.read_delimited(spark, str(tmp_path / "t"), "i bigint, t string, _corrupt string", sep).collect()
    assert sorted((r.i, r.t) for r in got) == rows and not any(r._corrupt for r in got)


def test_single_file_is_bounded(spark, tmp_path):
    with pytest.raises(ValueError):
        TT.write_delimited(spark.range(11), str(tmp_path / "t"), single_file=True, max_rows=10)


def test_dump_titles(spark):
    titles = ODD + ["NULL", "\\\\two", "'", "x" * 20_000, "\\'" * 10_000, "tab\there"]
    rows = spark.createDataFrame([(i, 0, t) for i, t in enumerate(titles)],
                                 "rd_from bigint, rd_namespace int, rd_title string")
    lines = DP.to_dump_lines(rows.selectExpr("*", "rd_from % 3 as b"), "redirect", "b",
                             DP.REDIRECT_SCHEMA.fieldNames(), {"rd_title"})
    got = DP.parse_tuples(DP.dump_tuples(lines, table="redirect"), DP.REDIRECT_SCHEMA).collect()
    assert {r.rd_from: r.rd_title for r in got} == dict(enumerate(titles))
    line = spark.createDataFrame([(r"""INSERT INTO `redirect` VALUES (1,0,'\"Weird_Al\"_Yankovic'),(2,0,NULL);""",)],
                                 "value string")
    got = DP.parse_tuples(DP.dump_tuples(line), DP.REDIRECT_SCHEMA).collect()
    assert [r.rd_title for r in got] == ['"Weird_Al"_Yankovic', None]


def test_stored_totals(spark):
    history = spark.createDataFrame([(1, ["20150301"], [10], 100), (2, ["20150301"], [5], 50),
                                     (3, ["20150301", "20150302"], [4, 6], 30)],
                                    "page_id bigint, dates array<string>, pageviews array<bigint>, total_pageviews bigint")
    new = spark.createDataFrame([(1, "20150302", 5), (3, "20150302", 9)], "page_id bigint, dt string, views bigint")
    got = {r.page_id: r.total_pageviews for r in TL.merge_timelines(history, new).collect()}
    assert got == {1: 105, 2: 50, 3: 33}


def test_merge_without_its_predecessor_stops(spark, tmp_path):
    df = spark.createDataFrame([("A", 1)], "title string, views bigint").selectExpr(
        "title", "timestamp_ntz'2015-03-01 00:00:00' as ts", "views")
    with pytest.raises(RuntimeError):
        HS.TimelineMerger(str(tmp_path / "m"))(df, 2)
    HS.TimelineMerger(str(tmp_path / "m"))(df, 0)
    HS.TimelineMerger(str(tmp_path / "m"))(df, 2)  # an expired version between is no loss
    assert HS.latest_version(spark, str(tmp_path / "m")).first().dates == ["20150301"]
