"""Redirect lookups (C3), dump tuples (C5) and timeline merge (C4)."""

from pyspark.sql import functions as F

from trafficlens.operators import lookups as L
from trafficlens.operators import timelines as TL
from trafficlens.plans import merge_rank as MR
from trafficlens.sources import dumps as DP

PAGE = [(1, 0, "Facebook", 101), (2, 0, "FB", 102), (3, 0, "New_York", 103), (4, 1, "Talk_page", 104),
        (5, 0, "NYC", 105), (6, 0, "Orphan_R", 106)]
REDIRECT = [(2, 0, "Facebook"), (5, 0, "New_York"), (6, 0, "Missing_Target"), (4, 1, "Facebook")]


def _wiki(spark):
    p = spark.createDataFrame(PAGE, "page_id bigint, page_namespace int, page_title string, page_latest bigint")
    r = spark.createDataFrame(REDIRECT, "rd_from bigint, rd_namespace int, rd_title string")
    return p, r


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_redirects_and_nonredirects(spark):
    p, r = _wiki(spark)
    p0, r0 = L.main_namespace(p, "page_namespace"), L.main_namespace(r, "rd_namespace")
    assert _rows(L.resolve_redirects(p0, r0)) == [("FB", "Facebook", 1, 101), ("NYC", "New York", 3, 103)]
    assert _rows(L.non_redirects(p0, r0)) == [("Facebook", "Facebook", 1, 101), ("New_York", "New York", 3, 103)]
    lk = L.build_lookup(p, r)
    titles = [x[0] for x in _rows(lk)]
    assert len(titles) == len(set(titles)) == 4  # L1 and L2 keys are disjoint


def test_dump_tuples_quote_aware(spark):
    line = r"""INSERT INTO `redirect` VALUES (1,0,'A_b','',''),(2,4,'It\'s_(x),_y','','');"""
    df = spark.createDataFrame([(line,), ("-- comment",)], "value string")
    t = DP.dump_tuples(df, table="redirect")
    got = _rows(DP.parse_tuples(t, DP.REDIRECT_SCHEMA))
    assert got == [(1, 0, "A_b"), (2, 4, "It's_(x),_y")]


def test_dump_roundtrip_render(spark):
    p, _ = _wiki(spark)
    p = p.withColumn("page_title", F.concat("page_title", F.lit("'s_(x)"))).withColumn("_b", F.lit(0))
    lines = DP.to_dump_lines(p, "page", "_b", ["page_id", "page_namespace", "page_title", "page_latest"],
                             {"page_title"})
    schema = "page_id bigint, page_namespace int, page_title string, page_latest bigint"
    from pyspark.sql.types import StructType
    got = _rows(DP.parse_tuples(DP.dump_tuples(lines), StructType.fromDDL(schema)))
    assert got == sorted((a, b, c + "'s_(x)", d) for a, b, c, d in PAGE)


def _history(spark):
    return spark.createDataFrame(
        [(1, ["20150301", "20150302"], [10, 20], 30), (3, ["20150301"], [5], 5)],
        "page_id bigint, dates array<string>, pageviews array<bigint>, total_pageviews bigint")


def test_merge_sums_titles_of_one_page(spark):
    p, r = _wiki(spark)
    lookup = L.build_lookup(p, r)
    new = spark.createDataFrame([("Facebook", "20150303", 7), ("FB", "20150303", 2), ("New_Page", "20150303", 9)],
                                "title string, dt string, views bigint")
    pages = TL.pages_table(L.main_namespace(p, "page_namespace"))
    res = MR.merge_and_rank(_history(spark), new, lookup, pages, persist=False)
    got = {r.page_id: (r.dates, r.pageviews, r.total_pageviews) for r in res.timelines.collect()}
    assert got == {1: (["20150301", "20150302", "20150303"], [10, 20, 9], 39), 3: (["20150301"], [5], 5)}
    assert [r.title for r in res.unmatched.collect()] == ["New_Page"]


def test_merge_replay_is_idempotent(spark):
    new = spark.createDataFrame([(1, "20150303", 9)], "page_id bigint, dt string, views bigint")
    once = TL.merge_timelines(_history(spark), new)
    twice = TL.merge_timelines(once, new)
    assert _rows(once) == _rows(twice)


def test_merge_keep_new(spark):
    new = spark.createDataFrame([(7, "20150303", 4)], "page_id bigint, dt string, views bigint")
    assert 7 not in [r.page_id for r in TL.merge_timelines(_history(spark), new).collect()]
    kept = {r.page_id: r for r in TL.merge_timelines(_history(spark), new, keep_new=True).collect()}
    assert kept[7].pageviews == [4] and kept[7].total_pageviews == 4


def test_write_version_replay(spark):
    from trafficlens.session import fresh_path
    p, r = _wiki(spark)
    lookup = L.build_lookup(p, r)
    new = spark.createDataFrame([("Facebook", "20150303", 7), ("FB", "20150303", 2)],
                                "title string, dt string, views bigint")
    pages = TL.pages_table(L.main_namespace(p, "page_namespace"))
    root = fresh_path(spark, "t_versions")
    out1 = MR.write_version(MR.merge_and_rank(_history(spark), new, lookup, pages), root, 1)
    first = _rows(spark.read.parquet(f"{out1}/daily_timelines"))
    out2 = MR.write_version(MR.merge_and_rank(_history(spark), new, lookup, pages), root, 1)
    assert out1 == out2 and _rows(spark.read.parquet(f"{out2}/daily_timelines")) == first
    assert _rows(spark.read.parquet(f"{out1}/pages").select("page_id", "total_pageviews")) == [(1, 39), (3, 5)]
