"""Top-N reports.

Global top-N is ``orderBy().limit()`` which Spark plans as
TakeOrderedAndProject: each task keeps its own N best rows and only those
reach the final merge, so no task ever holds more than N rows per input
partition. Per-group top-N uses ``row_number() <= N``; Spark inserts a
partial WindowGroupLimit before the shuffle, so a hot group (one day with
all titles) is cut to N rows per map task before it moves.

The time reference ``as_of`` defaults to the latest time in the data
(a scalar subquery evaluated on the executors), never the wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.operators.ranking import rank_long


def latest(df: DataFrame, col: str) -> Column:
    """max(col) of ``df`` as a scalar-subquery Column."""
    return df.select(F.max(col)).scalar()


def top_recent_hours(hourly: DataFrame, n: int = 10, hours: int = 24, as_of=None,
                     key: str = "title", ts: str = "ts", views: str = "views") -> DataFrame:
    """Titles trending over the last ``hours`` hourly points up to ``as_of``.

    Score = the daily-score rule (W6) applied to the hourly series of the
    window; ties broken by views then title. Output carries the rank.
    """
    as_of = latest(hourly, ts) if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    start = as_of - F.make_dt_interval(F.lit(0), F.lit(hours))
    recent = hourly.where((F.col(ts) > start) & (F.col(ts) <= as_of))
    return top_by(recent, n, "daily_trend", ts, key, views)


def top_by(recent: DataFrame, n: int, score: str, order: str, key: str = "title",
           views: str = "views") -> DataFrame:
    """The ``n`` best titles of counts that already hold the window only
    (cut on the raw rows by ``hour_range`` / ``day_range``)."""
    scored = rank_long(recent, key, order, views)
    return _top(scored, n, [F.col(score).desc(), F.col("total_pageviews").desc(), F.col(key).asc()])


def top_recent_days(daily: DataFrame, n: int = 10, days: int = 30, as_of=None,
                    key: str = "title", dt: str = "dt", views: str = "views") -> DataFrame:
    """Titles with the largest monthly rank (W5) over the last ``days`` days."""
    day = F.to_date(F.col(dt), "yyyyMMdd")
    as_of = F.to_date(latest(daily, dt), "yyyyMMdd") if as_of is None else F.to_date(F.lit(as_of))
    recent = daily.where((day > F.date_sub(as_of, days)) & (day <= as_of))
    return top_by(recent, n, "monthly_trend", dt, key, views)


def _top(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    top = df.orderBy(*order).limit(n)
    # rank inside the N kept rows only (a window over at most N rows)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def top_per_group(df: DataFrame, group: str, n: int, order: list[Column]) -> DataFrame:
    """T3 core: the N first rows of every group under ``order``."""
    r = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("rank", r).where(F.col("rank") <= n)


def top_per_day(trends: DataFrame, n: int = 10, key: str = "title", dt: str = "dt",
                score: str = "daily_trend") -> DataFrame:
    """For every day the N titles with the highest daily trend."""
    return top_per_group(trends.select(dt, key, "views", score), dt, n,
                         [F.col(score).desc_nulls_last(), F.col(key).asc()])


def trend_search(trends: DataFrame, title: str | None = None, pattern: str | None = None,
                 key: str = "title") -> DataFrame:
    """T4: all points of one title (exact) or of titles matching a regex. On
    a stored trend table bucketed by the title (``catalog.save_table``), the
    exact form reads one bucket, and within it the row groups of the title."""
    if title is not None:
        return trends.where(F.col(key) == F.lit(title))
    return trends.where(F.col(key).rlike(pattern))
