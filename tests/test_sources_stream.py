"""Files, text formats and the hourly stream (FIXTURES C6)."""

import datetime as dt

from pyspark.sql import functions as F

from trafficlens.functions.scalars import file_stamp, stamp_to_ts
from trafficlens.operators import trends as T
from trafficlens.session import fresh_path
from trafficlens.sources import manifest as MF
from trafficlens.sources import pagecounts as PC
from trafficlens.sources import trend_lines as TLN
from trafficlens.streaming import hourly as HS


def test_file_time(spark):
    df = spark.createDataFrame([("/x/pagecounts-20150301-000000.gz",), ("/x/other.gz",)], "p string")
    got = df.select(stamp_to_ts(file_stamp("p")).alias("ts")).collect()
    assert got[0].ts == dt.datetime(2015, 3, 1, 0, 0) and got[1].ts is None


def _lines(spark, rows):
    return spark.createDataFrame(rows, "value string, stamp string")


def test_read_files_with_glob_and_hours(spark):
    root = fresh_path(spark, "t_files")
    PC.write_pagecount_files(_lines(spark, [("en A 1 1", "20150301000000"), ("en B 2 2", "20150301010000"),
                                            ("en C 3 3", "20150302000000")]), root)
    all_ = PC.read_pagecounts(spark, root)
    assert sorted(r.value for r in all_.collect()) == ["en A 1 1", "en B 2 2", "en C 3 3"]
    day1 = PC.read_pagecounts(spark, f"{root}/{PC.hour_glob('20150301')}")
    assert sorted(r.value for r in day1.collect()) == ["en A 1 1", "en B 2 2"]
    hrs = PC.read_pagecounts(spark, root, hours=("2015-03-01 01:00:00", "2015-03-02 00:00:00"))
    assert sorted(r.value for r in hrs.collect()) == ["en B 2 2", "en C 3 3"]


def test_trend_lines_roundtrip(spark):
    c = spark.createDataFrame([("A|B", f"201503{d:02d}", v) for d, v in zip(range(1, 17), range(5, 21))],
                              "title string, dt string, views bigint")
    path = fresh_path(spark, "t_lines")
    TLN.write_trend_lines(T.trend_table(c), path)
    text = spark.read.text(path).collect()[0].value
    assert text.startswith("A%7CB|20150301,") and text.endswith("|")
    back = TLN.read_trend_lines(spark, path).collect()[0]
    assert back.title == "A|B" and back.views == list(range(5, 21)) and not back.bad
    assert len(back.weekly) == 17 and len(back.daily) == 16


def test_manifest_shards(spark):
    html = '<li><a href="pagecounts-20150101-090000.gz">x</a></li><li><a href="projectcounts-1">y</a></li>' \
           '<li><a href="pagecounts-20150101-230000.gz">z</a></li>'
    df = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    got = sorted((r.name, r.shard) for r in MF.listing_manifest(df).collect())
    assert got == [("pagecounts-20150101-090000.gz", 1), ("pagecounts-20150101-230000.gz", 2)]


def test_stream_watermark_append(spark):
    """Run 1 (hours 00, 01) emits nothing; after hour 08 arrives, run 2
    emits hours 00 and 01 only (3 h watermark)."""
    root, out, chk = fresh_path(spark, "s_in"), fresh_path(spark, "s_out"), fresh_path(spark, "s_chk")
    PC.write_pagecount_files(_lines(spark, [("en A 1 1", "20150301000000"), ("en A 2 1", "20150301010000")]),
                             root)
    HS.run_to_parquet(HS.hourly_counts_stream(HS.line_stream(spark, root), delay="3 hours"), out, chk)
    assert spark.read.schema("title string, ts timestamp_ntz, views bigint").parquet(out).count() == 0
    PC.write_pagecount_files(_lines(spark, [("en A 5 1", "20150301080000")]), root, mode="append")
    HS.run_to_parquet(HS.hourly_counts_stream(HS.line_stream(spark, root), delay="3 hours"), out, chk)
    got = sorted((r.ts.hour, r.views) for r in spark.read.parquet(out).collect())
    assert got == [(0, 1), (1, 2)]


def test_stream_merge_versions(spark):
    root, m, chk = fresh_path(spark, "m_in"), fresh_path(spark, "m_root"), fresh_path(spark, "m_chk")
    PC.write_pagecount_files(_lines(spark, [("en A 1 1", "20150301000000"), ("en A 2 1", "20150301010000"),
                                            ("en B 4 1", "20150302000000"), ("en A 3 1", "20150302090000")]),
                             root)
    HS.run_merge(HS.hourly_counts_stream(HS.line_stream(spark, root), delay="3 hours"), m, chk)
    t = {r.title: (r.dates, r.pageviews) for r in HS.latest_version(spark, m).collect()}
    assert t == {"A": (["20150301"], [3]), "B": (["20150302"], [4])}
    docs = spark.read.json(f"{m}/docs")
    assert docs.where(F.col("title") == "A").count() >= 1


def test_stream_merge_across_runs(spark):
    """Two scheduled runs: the second merges into the versions the first wrote."""
    root, m, chk = fresh_path(spark, "m2_in"), fresh_path(spark, "m2_root"), fresh_path(spark, "m2_chk")
    PC.write_pagecount_files(_lines(spark, [("en A 1 1", "20150301000000"), ("en B 2 1", "20150301010000"),
                                            ("en A 3 1", "20150301120000")]), root)
    HS.run_merge(HS.hourly_counts_stream(HS.line_stream(spark, root), delay="3 hours"), m, chk)
    first = {r.title: (r.dates, r.pageviews) for r in HS.latest_version(spark, m).collect()}
    assert first == {"A": (["20150301"], [1]), "B": (["20150301"], [2])}
    PC.write_pagecount_files(_lines(spark, [("en A 5 1", "20150302000000"), ("en A 7 1", "20150302200000")]),
                             root, mode="append")
    HS.run_merge(HS.hourly_counts_stream(HS.line_stream(spark, root), delay="3 hours"), m, chk)
    t = {r.title: (r.dates, r.pageviews, r.total_pageviews) for r in HS.latest_version(spark, m).collect()}
    assert t == {"A": (["20150301", "20150302"], [4, 5], 9), "B": (["20150301"], [2], 2)}


def test_stream_merge_three_runs_and_late_rows(spark):
    """A run writes the days it touched only; documents before them are not
    published again; lines of a closed hour are counted."""
    root, m, chk = fresh_path(spark, "m3_in"), fresh_path(spark, "m3_root"), fresh_path(spark, "m3_chk")

    def run(lines):
        PC.write_pagecount_files(_lines(spark, lines), root, mode="append")
        return HS.run_merge(HS.hourly_counts_stream(HS.line_stream(spark, root), delay="3 hours"), m, chk)

    run([("en A 1 1", "20150301000000"), ("en B 2 1", "20150301010000"), ("en A 1 1", "20150301200000")])
    run([("en A 5 1", "20150302000000"), ("en A 7 1", "20150302200000")])
    assert HS.late_rows(run([("en B 9 1", "20150301020000"), ("en A 1 1", "20150303200000")])) == 1
    t = {r.title: (r.dates, r.pageviews) for r in HS.latest_version(spark, m).collect()}
    assert t == {"A": (["20150301", "20150302"], [2, 12]), "B": (["20150301"], [2])}
    last = HS.committed(spark, m)
    days = spark.read.schema(HS.DAYS_SCHEMA).parquet(f"{m}/days")
    newest = days.where(F.col("batch") == days.agg(F.max("batch")).first()[0]).collect()
    assert [(r.title, r.dt, r.views) for r in newest] == [("A", "20150302", 12)]
    docs = spark.read.json(f"{m}/docs")
    newest = docs.where(F.col("version") == docs.where("title is not null").agg(F.max("version")).first()[0])
    assert {(r.title, r.page_date) for r in newest.collect()} == {("A", "2015-03-02")} and last is not None
