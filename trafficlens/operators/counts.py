"""Count aggregation.

All aggregates are plain ``groupBy().agg()``: Spark plans a partial
(map-side) aggregate before the shuffle, so a hot title costs one row per
map task per key, whatever its share of the raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from trafficlens.functions.scalars import day_stamp, hour_of


def daily_counts(hits: DataFrame, key: str = "title", ts: str = "ts",
                 views: str = "views") -> DataFrame:
    """A1: (key, dt 'yyyyMMdd', views) summed per key and day."""
    return (hits.groupBy(F.col(key), day_stamp(ts).alias("dt"))
                .agg(F.sum(views).cast("bigint").alias("views")))


def hourly_counts(hits: DataFrame, key: str = "title", ts: str = "ts",
                  views: str = "views") -> DataFrame:
    """A2: (key, ts hour, views) summed per key and hour."""
    return (hits.groupBy(F.col(key), hour_of(ts).alias("ts"))
                .agg(F.sum(views).cast("bigint").alias("views")))


def stamp_counts(hits: DataFrame, key: str = "title", stamp: str = "stamp",
                 views: str = "views") -> DataFrame:
    """A1 on pre-formatted stamps (the source's string keys)."""
    return hits.groupBy(key, stamp).agg(F.sum(views).cast("bigint").alias("views"))


def series_arrays(counts: DataFrame, key: str = "title", order: str = "dt",
                  views: str = "views") -> DataFrame:
    """A3: one row per key with date-sorted parallel arrays.

    The array length is bounded by the number of distinct stamps (days or
    hours) of the key, not by its raw row count.
    """
    pts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(views).alias("v"))))
    return (counts.groupBy(key).agg(pts.alias("_pts"))
                  .select(key, F.col("_pts.o").alias("dates"), F.col("_pts.v").alias("views")))


def duplicates(df: DataFrame, keys=("project", "page"), out: str = "page") -> DataFrame:
    """A4: GROUP BY keys HAVING COUNT(*) > 1, projecting ``out``."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1).select(out, "n"))


def min_views(df: DataFrame, n: int, views: str = "views") -> DataFrame:
    """keep rows with views > n."""
    return df.where(F.col(views) > F.lit(n))


def sorted_counts(df: DataFrame, key: str = "title", ts: str = "ts") -> DataFrame:
    """O2: total order by key then time (range-partitioned sort)."""
    return df.orderBy(key, ts)


def load_stats(parsed: DataFrame, by: str = "stamp", status: str = "status") -> DataFrame:
    """Lines read and lines accepted per input file / stamp."""
    return (parsed.groupBy(by)
                  .agg(F.count(F.lit(1)).alias("lines"),
                       F.count_if(F.col(status) == "ok").alias("accepted"),
                       F.sum(F.when(F.col(status) == "ok", F.col("views"))).cast("bigint")
                        .alias("views")))


def observed(parsed: DataFrame, name: str, status: str = "status") -> tuple[DataFrame, Observation]:
    """S24 while the rows pass: ``parsed`` with the lines, accepted lines and
    views it hands on counted by whatever action reads it; no second scan."""
    ok = F.col(status) == "ok"
    seen = Observation(name)
    return parsed.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(ok).alias("accepted"),
                          F.sum(F.when(ok, F.col("views"))).cast("bigint").alias("views")), seen
