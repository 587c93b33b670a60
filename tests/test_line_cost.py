"""What files and streams of lines cost a line: the hour is told by file, and
lines are laid out document by document."""

from pyspark.sql import functions as F

from trafficlens.functions import scalars as S
from trafficlens.functions import titles as X
from trafficlens.plans import batch_trends as BT
from trafficlens.session import fresh_path
from trafficlens.sources import bindings as B
from trafficlens.sources import pagecounts as PC
from trafficlens.streaming import hourly as HS
from trafficlens.streaming import store as ST

LINES = [("en A 1 1", "20150301000000"), ("en A 2 1", "20150301003000"), ("en A 4 1", "20150302010000"), ("de A 8 1", "20150302020000"),
         ("en User:x 3 4", "20150301000000"), ("en B#c 5 4", "20150301000000"), ("en %23 1 2", "20150301000000"), ("en B 2x 4", "20150301000000"),
         ("", "20150303000000"), ("en two words 1 2", "20150303000000"), ("en C 7 7", None), ("en C 1 1", "20159903000000")]


def files(spark, name="t_cost"):
    return PC.write_pagecount_files(spark.createDataFrame(LINES, "value string, stamp string"), fresh_path(spark, name))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_files_hold_the_lines_of_the_tokens(spark, tmp_path):
    docs = [(1, "One two\r\n three  four", "en", 9), (31, " lead\ttrail ", "de", 3), (2, None, "en", 1), (3, "", "en", 0), (4, "a b", None, 5),
            (None, "no id", "en", 2), (5, "no count", "fr", None), (1, "One two", "en", 9), (6, "é%20+ a b\x0bc", "en", 1)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    plain = PC.write_pagecount_files(B.token_lines(spark, str(tmp_path)), fresh_path(spark, "t_plain"))
    got = PC.write_pagecount_files(B.token_files(spark, str(tmp_path)), fresh_path(spark, "t_blocks"), value=B.token_block())
    both = [rows(PC.read_pagecounts(spark, root).select("value", "stamp")) for root in (plain, got)]
    assert both[0] == both[1] and len(both[0]) > 15
    assert "explode" not in optimized(B.token_files(spark, str(tmp_path)).select(B.token_block()))


def test_hours_are_told_once_a_file(spark):
    root = files(spark, "t_[a]{b}").replace("[a]{b}", "?a??b?")  # names that hold signs of a glob
    got = PC.read_pagecounts(spark, root, hours=("2015-03-01 00:30:00", "2015-03-02 01:00:00"))
    assert rows(got.select("value", "stamp")) == [LINES[1], LINES[2]]
    assert "Filter" not in optimized(got)  # no line is asked again
    none = PC.read_pagecounts(spark, root, hours=("2016-01-01 00:00:00", "2016-01-02 00:00:00"))
    assert none.columns == got.columns and none.collect() == []


def test_files_are_counted_as_lines_are(spark):
    lines = PC.read_pagecounts(spark, files(spark))
    for grain in ("day", "hour"):
        assert rows(BT.counts_from_files(lines, grain)) == rows(BT.counts_from_lines(lines, grain).select("title", "dt", "views"))
    assert "pagecounts-" not in optimized(BT.counts_from_files(lines)).split("Aggregate")[-1].split("\n", 1)[1]  # under the first aggregate


def test_counted_lines_are_the_ok_ones(spark):
    lines = PC.read_pagecounts(spark, files(spark))
    ok = F.col("status") == "ok"
    for rules in ({}, {"keyword": "b"}, {"extra_rule": lambda p: p != "A"}):
        want = X.parse_lines(lines, keep=["stamp"], **rules).select("stamp", F.when(ok, F.col("title")), F.when(ok, F.col("views")))
        assert rows(X.counted_lines(lines, keep=["stamp"], **rules)) == rows(want)


def test_arrivals_keep_hours_without_accepted_lines(spark):
    lines = PC.read_pagecounts(spark, files(spark)).withColumn("ts", S.stamp_to_instant("stamp"))
    parsed = X.parse_lines(lines, keep=["ts"])
    ok = F.col("status") == "ok"
    want = parsed.groupBy(F.when(ok, F.col("title")).alias("title"), S.hour_of(S.instant_to_wallclock("ts")).alias("ts")) \
        .agg(F.sum(F.when(ok, F.col("views"))).alias("views"))
    assert rows(ST.arrivals(lines)) == rows(want)


def test_event_time_by_integers(spark):
    stamps = ["20150301-000000", "20150301-235960", "20160229-010203", "20150229-000000", "19000229-000000", "20000229-000000", "20150431-000000",
              "20150100-000000", "20151301-000000", "20150301-240000", "20150301-006000", "20150301-000061", "2015030 -000000", "+2015030-000000",
              "20150301_000000", "20150301-00000", "2015031 -000000", "20150301- 00000", "09991231-235959", ""]
    paths = [f"file:/x/src=pagecounts-{s}/part-0.gz" for s in stamps] + \
        ["file:/x/20150301-000000", "file:/pagecounts-20150101-000000/src=pagecounts-20150301-010000/pagecounts-20150405-060000.gz", None]
    place = X.once(spark.createDataFrame([(p,) for p in paths], "p string"), ["p"], S.file_place("p").alias("place"))
    got = X.once(place, ["p"], S.place_number("place").alias("n")).select("p", S.number_to_instant("n"))
    assert rows(got) == rows(got.select("p", S.stamp_to_instant(S.file_stamp("p"))))


def test_stream_hours_of_any_layout(spark):
    """Hour directories, flat files, and files named for another hour than their directory."""
    base = spark.createDataFrame([("en A 1 1",)], "value string")
    for layout in ("src=pagecounts-20150301-000000", "src=other", "src=pagecounts-20150301-0000001"):
        root = fresh_path(spark, "t_layout")
        base.coalesce(1).write.text(f"{root}/{layout}")
        lines = HS.line_stream(spark, root)
        assert lines.isStreaming and {"value", "stamp", "ts", "file_path", "hour_name"} == set(lines.columns)
        out = fresh_path(spark, "t_out")
        q = lines.select("stamp", S.number_to_instant(S.place_number(S.file_place("hour_name"))).alias("fast"), "ts") \
            .writeStream.format("parquet").option("checkpointLocation", fresh_path(spark, "t_chk")).trigger(availableNow=True).start(out)
        q.awaitTermination()
        (r,) = spark.read.parquet(out).collect()
        assert r.fast == r.ts and (r.stamp is None) == (layout == "src=other")
