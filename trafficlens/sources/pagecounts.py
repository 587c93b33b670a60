"""Hourly page-count files.

Input files are named ``pagecounts-YYYYMMDD-HHMMSS[.gz]`` (flat), or live
under a directory with that name (``src=pagecounts-...`` as written by
``write_pagecount_files``). Either way the hour comes from the file path
via ``_metadata.file_path``; no driver-side listing, sorting or per-file
RDD union. gzip is decoded by the text source (one task per .gz file, as
gzip cannot be split; many small files are packed into one task).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.functions.scalars import file_stamp, hour_of, stamp_to_ts


def read_pagecounts(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None,
                    name_regex: str | None = None, hours: tuple | None = None) -> DataFrame:
    """(value, file_path, stamp 'yyyyMMddHHmmss', ts) for every line.

    glob       -- a file-name glob (``pathGlobFilter``), e.g. 'pagecounts-2015*'
    name_regex -- a regex on the file path (pruned per file, before reading)
    hours      -- (first, last) timestamps: keep files whose hour lies within
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if hours is not None:  # told by name and once a file; a filter would be asked again for every line
        ts = stamp_to_ts(file_stamp(F.col("path")))
        lo, hi = (F.lit(h).cast("timestamp_ntz") for h in hours)
        found = _listed(spark, paths, glob).where((ts >= lo) & (ts <= hi)).collect()  # as many as the hours have files
        paths = [re.sub(r"([\\*?\[\]{}])", r"\\\1", r.path) for r in found]
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.text(paths) if paths else \
        spark.createDataFrame([], "value string, _metadata struct<file_path: string>")
    path = F.col("_metadata.file_path")
    if name_regex:
        df = df.where(path.rlike(name_regex))
    stamp = file_stamp(path)
    return df.select("value", path.alias("file_path"), stamp.alias("stamp"),
                     stamp_to_ts(stamp).alias("ts"))


def _listed(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """The paths of the files; none is opened."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths).select("path")


def union_sources(*frames: DataFrame) -> DataFrame:
    """Union of reads with possibly different column sets."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def recent_hours(df: DataFrame, as_of, first: int = 48, last: int = 70, ts: str = "ts") -> DataFrame:
    """S3: rows whose hour is ``first``..``last`` hours (inclusive) before
    ``as_of`` (a Column, e.g. a scalar subquery, or a literal)."""
    a = as_of if isinstance(as_of, F.Column) else F.lit(as_of).cast("timestamp_ntz")
    lo = a - F.make_dt_interval(F.lit(0), F.lit(last))
    hi = a - F.make_dt_interval(F.lit(0), F.lit(first))
    return df.where((F.col(ts) >= lo) & (F.col(ts) <= hi))


def hour_range(hits: DataFrame, first: int = 48, last: int = 70, ts: str = "ts") -> DataFrame:
    """S3 on raw rows: those whose hour is ``first``..``last`` hours
    (inclusive) before the hour of the latest row.

    The lower bound is a scalar subquery compared with the stored column
    itself, so it reaches the scan and only the range is aggregated. The upper
    bound is counted from it: two different subqueries would be merged by
    Spark into one of a struct, which is not pushed.
    """
    hour = hour_of(F.max(ts))
    lo = hits.select((hour - F.make_dt_interval(F.lit(0), F.lit(last))).alias("lo")).scalar()
    recent = hits.where(F.col(ts) >= lo)
    if first <= 0:
        return recent
    return recent.where(F.col(ts) < lo + F.make_dt_interval(F.lit(0), F.lit(last - first + 1)))


def day_range(hits: DataFrame, days: int, ts: str = "ts") -> DataFrame:
    """Raw rows of the last ``days`` days up to the day of the latest row
    (a bound on the stored column, as in ``hour_range``)."""
    first = F.date_sub(F.max(ts).cast("date"), days - 1).cast(hits.schema[ts].dataType)
    return hits.where(F.col(ts) >= hits.select(first.alias("lo")).scalar())


def file_hours(spark: SparkSession, root: str) -> DataFrame:
    """The hours (ts) for which there are files; no file is opened."""
    return _listed(spark, root).select(stamp_to_ts(file_stamp(F.col("path"))).alias("ts")).distinct()


def write_pagecount_files(lines: DataFrame, root: str, stamp: str = "stamp",
                          compression: str = "gzip", mode: str = "overwrite", value="value") -> str:
    """Lay lines out as hourly page-count files, one directory per hour
    ``src=pagecounts-YYYYMMDD-HHMMSS`` (the layout the reader accepts).

    ``value`` (a column name or a Column) is a line, or several with newlines
    between them; a Column is evaluated behind the shuffle by hour."""
    src = F.concat(F.lit("pagecounts-"), F.substring(stamp, 1, 8), F.lit("-"),
                   F.substring(stamp, 9, 6))
    # large hours are split over tasks and files, small ones share a task
    value = F.col(value) if isinstance(value, str) else value
    (lines.withColumn("src", src).drop(stamp).hint("rebalance", "src")
          .select(value.alias("value"), "src").write.mode(mode).option("compression", compression)
          .partitionBy("src").text(root))
    return root


def hour_glob(day: str) -> str:
    """Directory glob for one day of the layout above."""
    return f"src=pagecounts-{day}-*"


__all__ = ["read_pagecounts", "union_sources", "recent_hours", "hour_range", "day_range",
           "file_hours", "write_pagecount_files", "hour_glob"]
