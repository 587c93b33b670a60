"""Entries 1 and 2: page-count files -> cleaned titles -> counts per
(title, day) or (title, hour) -> trend table -> trend lines.

One Spark plan: scan (file pruning on the path), per-line Column rules in
the scan's codegen span, partial aggregate, shuffle on (title, stamp),
shuffle on title, one sort, windows. Rejected lines are a second output
built from the same parse.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.functions import titles as X
from trafficlens.functions.scalars import file_stamp
from trafficlens.operators.trends import trend_table
from trafficlens.sources.pagecounts import file_hours, read_pagecounts
from trafficlens.sources.trend_lines import write_trend_lines

GRAIN_CHARS = {"day": 8, "hour": 14}


def parse(lines: DataFrame, strict_ext: bool = False, keyword: str | None = None,
          blacklist: Sequence[str] = X.BLACKLIST,
          namespaces: Sequence[str] = X.EXCLUDED_NAMESPACES, extra_rule=None) -> DataFrame:
    return X.parse_lines(lines, keep=["stamp"], strict_ext=strict_ext, keyword=keyword,
                         blacklist=blacklist, namespaces=namespaces, extra_rule=extra_rule)


def accepted(lines: DataFrame, **rules) -> DataFrame:
    return X.accepted_lines(lines, keep=["stamp"], **rules)


def counts_from_parsed(parsed: DataFrame, grain: str = "day", stamp: str = "stamp") -> DataFrame:
    """(title, dt, views) summed over accepted lines; dt = 'yyyyMMdd' (day)
    or 'yyyyMMddHHmmss' (hour).

    Rejected lines keep a NULL title and NULL views, fall into one group per
    stamp (cut to a row per map task by the partial aggregate) and are
    dropped by ``views IS NOT NULL`` after the aggregate: an accepted group
    always has views. Filtering before the aggregate would make Catalyst
    inline the whole parse into the filter once per reference.
    """
    ok = F.col("status") == "ok"
    dt = F.substring(stamp, 1, GRAIN_CHARS[grain])
    g = parsed.select(F.when(ok, F.col("title")).alias("title"), dt.alias("dt"),
                      F.when(ok, F.col("views")).alias("_v"))
    return (g.groupBy("title", "dt").agg(F.sum("_v").cast("bigint").alias("views"))
             .where(F.col("views").isNotNull()))


def counts_from_lines(lines: DataFrame, grain: str = "day", **rules) -> DataFrame:
    return counts_from_parsed(parse(lines, **rules), grain)


def counts_from_files(lines: DataFrame, grain: str = "day", **rules) -> DataFrame:
    """``counts_from_lines`` of lines that have the path of their file: lines
    are summed by (title, file) first, and the hour is read off a path once a
    group, not once a line."""
    by_file = X.accepted_lines(lines, keep=["file_path"], **rules) \
        .groupBy("title", "file_path").agg(F.sum("views").alias("views"))
    dt = F.substring(file_stamp(F.col("file_path")), 1, GRAIN_CHARS[grain])
    return by_file.groupBy("title", dt.alias("dt")).agg(F.sum("views").cast("bigint").alias("views"))


def trends_from_lines(lines: DataFrame, grain: str = "day", **rules) -> DataFrame:
    return trend_table(counts_from_lines(lines, grain, **rules))


def rejects(lines: DataFrame, **rules) -> DataFrame:
    return parse(lines, **rules).where(F.col("status") != "ok")


def run(spark: SparkSession, paths, out: str | None = None, grain: str = "day",
        glob: str | None = None, hours: tuple | None = None, **rules) -> DataFrame:
    """Read files, compute the trend table; write trend lines when ``out``."""
    lines = read_pagecounts(spark, paths, glob=glob, hours=hours)
    trends = trend_table(counts_from_files(lines, grain, **rules))
    if out:
        write_trend_lines(trends, out)
    return trends


def run_latest(spark: SparkSession, root: str, out: str | None = None, first: int = 48, last: int = 70,
               as_of=None, **rules) -> DataFrame:
    """Entry 2: hourly trends of the files ``first``..``last`` hours back.

    ``as_of`` (a datetime) is the hour of the newest file unless given; it is
    found by listing, and only the files of the range are opened."""
    if as_of is None:
        as_of = file_hours(spark, root).agg(F.max("ts")).first()[0]
    hours = (as_of - timedelta(hours=last), as_of - timedelta(hours=first))
    return run(spark, root, out=out, grain="hour", hours=hours, **rules)
