"""Timelines: per-page day series merged with new counts.

A timeline row is (page_id, dates array<string>, pageviews array<bigint>,
total_pageviews). Arrays are bounded by the number of days of one page.

Merge = one outer join on page_id (matched pages get the new points, quiet
pages are kept), instead of the source's inner join + outer/IS NULL pair:
one shuffle instead of two. A new day that is already in the history
replaces it, so re-applying the same batch never double counts. The stored
total of a page may cover more than its points: it stays for quiet pages,
and matched pages get the new views less those of replaced days (D8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.functions.scalars import json_bigint_array, json_string_array, sum_array

TIMELINE_COLUMNS = ["page_id", "dates", "pageviews", "total_pageviews"]


def timelines_from_counts(counts: DataFrame, key: str = "page_id", dt: str = "dt",
                          views: str = "views") -> DataFrame:
    """(key, dt, views) -> timelines; several titles of one page are summed
    per day first (decision D7)."""
    per_day = counts.groupBy(key, dt).agg(F.sum(views).cast("bigint").alias("_v"))
    pts = F.array_sort(F.collect_list(F.struct(F.col(dt).alias("d"), F.col("_v").alias("v"))))
    g = per_day.groupBy(key).agg(pts.alias("_p"))
    return g.select(key, F.col("_p.d").alias("dates"), F.col("_p.v").alias("pageviews"),
                    sum_array(F.col("_p.v")).alias("total_pageviews"))


def parse_timelines(df: DataFrame) -> DataFrame:
    """Text timelines ('[d1,d2]', '[v1,v2]') -> typed arrays."""
    return df.select("page_id", json_string_array("dates").alias("dates"),
                     json_bigint_array("pageviews").alias("pageviews"),
                     F.col("total_pageviews").try_cast("bigint").alias("total_pageviews"))


def split_corrupt(text: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Text timelines -> (typed timelines, rows that are none). A row is corrupt
    if a list does not parse, the lists differ in length, or a date or a count
    is missing; it goes with its text, for the bad-row rule (W8)."""
    pair = text.select(
        "page_id", "dates", "pageviews", F.col("total_pageviews").cast("string").alias("total_pageviews"),
        json_string_array("dates").alias("_dates"), json_bigint_array("pageviews").alias("_pageviews"))
    bad = (F.col("_dates").isNull() | F.col("_pageviews").isNull() | (F.size("_dates") != F.size("_pageviews"))
           | F.exists("_dates", lambda d: d.isNull()) | F.exists("_pageviews", lambda v: v.isNull()))
    bad = F.coalesce(bad, F.lit(True))
    return parse_timelines(pair.where(~bad)), pair.where(bad).select(*TIMELINE_COLUMNS)


def merge_timelines(history: DataFrame, new_counts: DataFrame, keep_new: bool = False,
                    key: str = "page_id", dt: str = "dt", views: str = "views") -> DataFrame:
    """L7 + L8 + U1 + A6: history timelines merged with new (key, dt, views).

    keep_new=False drops pages that have no history yet (source behaviour);
    keep_new=True starts a timeline for them.
    """
    new = timelines_from_counts(new_counts, key, dt, views).select(
        key, F.arrays_zip(F.col("dates").alias("d"), F.col("pageviews").alias("v")).alias("_n"))
    h = history.select(key, F.arrays_zip(F.col("dates").alias("d"), F.col("pageviews").alias("v")).alias("_h"),
                       F.coalesce("total_pageviews", sum_array(F.col("pageviews"))).alias("_t"))
    j = h.join(new, key, "full" if keep_new else "left")
    empty = F.array().cast("array<struct<d:string,v:bigint>>")
    n = F.coalesce(F.col("_n"), empty)
    new_days = F.transform(n, lambda p: p["d"])
    old = F.coalesce(F.col("_h"), empty)
    kept = F.filter(old, lambda p: ~F.array_contains(new_days, p["d"]))
    views_of = lambda points: F.coalesce(sum_array(F.transform(points, lambda p: p["v"])), F.lit(0))
    total = F.coalesce("_t", F.lit(0)) + views_of(n) - (views_of(old) - views_of(F.col("_k")))
    out = j.select(key, "_t", "_n", "_h", kept.alias("_k"), F.array_sort(F.concat(kept, n)).alias("_m"))
    return out.select(key, F.col("_m.d").alias("dates"), F.col("_m.v").alias("pageviews"),
                      total.cast("bigint").alias("total_pageviews"))


def timeline_points(timelines: DataFrame, key: str = "page_id") -> DataFrame:
    """Timelines -> long (key, dt, views)."""
    z = timelines.select(key, F.explode(F.arrays_zip(F.col("dates").alias("dt"),
                                                     F.col("pageviews").alias("views"))).alias("_p"))
    return z.select(key, "_p.dt", "_p.views")


def attach_pages(pages: DataFrame, scored: DataFrame) -> DataFrame:
    """The `new_pages` projection (pages with fresh total and monthly)."""
    p = pages.select("page_id", "url", "title", "page_latest")
    return (p.join(scored.select("page_id", "total_pageviews", "monthly_trend"), "page_id")
             .select("page_id", "url", "title", "page_latest", "total_pageviews", "monthly_trend")
             .distinct())


def daily_trend_rows(pages: DataFrame, scored: DataFrame) -> DataFrame:
    """The `new_daily_trends` projection (page_id, trend, error)."""
    p = pages.select("page_id")
    return (p.join(scored.select("page_id", F.col("daily_trend").alias("trend"), "error"), "page_id")
             .distinct())


def pages_table(page: DataFrame, base_url: str = "https://en.wikipedia.org/wiki/") -> DataFrame:
    """The `pages` table from wiki pages: url, display title, zero scores."""
    return page.select("page_id", F.concat(F.lit(base_url), F.col("page_title")).alias("url"),
                       F.replace(F.col("page_title"), F.lit("_"), F.lit(" ")).alias("title"),
                       "page_latest", F.lit(0).cast("bigint").alias("total_pageviews"),
                       F.lit(0.0).alias("monthly_trend"))
