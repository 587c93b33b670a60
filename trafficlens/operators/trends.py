"""Change-ratio trends over a per-title series.

Index convention: ``idx`` is the 0-based position of a point in its title's
date-sorted series; windows count observed points (gaps are not filled).

- daily  (W1): c[i]/c[i-1] - 1, 0.0 at idx 0.
- weekly (W2): at idx > 13, sum(c[idx-7:idx]) / sum(c[idx-14:idx-7]) - 1, else 0.0.
- monthly(W3): at idx > 59, sum(c[idx-30:idx]) / sum(c[idx-60:idx-30]) - 1, else 0.0.
- published (W4): the list the source writes for weekly/monthly starts with
  an extra 0.0, so the value shown next to date k is the one computed at
  k-1. Both the ``*_at`` and the published columns are returned.
A zero divisor gives NULL (the source crashed there).

Plan: one hash Exchange on the title and one sort; the range sums are
differences of one running sum (prefix sums), so every frame costs O(1) per
row instead of O(width). The series per title is bounded by its number of
days (or hours), which is what one window partition holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEEK = 7
MONTH = 30


def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num, den) - F.lit(1.0)


def trend_table(counts: DataFrame, key: str = "title", order: str = "dt",
                views: str = "views") -> DataFrame:
    """(key, order, views, idx, daily_trend, weekly_trend_at,
    monthly_trend_at, weekly_trend, monthly_trend)."""
    w = Window.partitionBy(key).orderBy(order)
    base = counts.select(
        F.col(key), F.col(order), F.col(views).alias("views"),
        (F.row_number().over(w) - 1).alias("idx"),
        F.lag(views, 1).over(w).alias("_prev"),
        F.sum(views).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
         .alias("_cum"),
    )

    def cum_before(k: int) -> Column:
        # sum of the points before position idx-k+1, i.e. cum[idx-k] (0 when idx-k < 0)
        return F.lag("_cum", k, 0).over(w)

    def window_ratio(width: int, shift: int) -> Column:
        # sum(c[idx-s-width : idx-s]) / sum(c[idx-s-2*width : idx-s-width]) - 1
        a, b, c = cum_before(1 + shift), cum_before(1 + shift + width), cum_before(1 + shift + 2 * width)
        return _ratio(a - b, b - c)

    idx = F.col("idx")
    daily = F.when(idx == 0, F.lit(0.0)).otherwise(_ratio(F.col(views), F.col("_prev")))
    weekly_at = F.when(idx > 2 * WEEK - 1, window_ratio(WEEK, 0)).otherwise(F.lit(0.0))
    monthly_at = F.when(idx > 2 * MONTH - 1, window_ratio(MONTH, 0)).otherwise(F.lit(0.0))
    # published value at idx = value computed at idx - 1
    weekly_pub = F.when(idx > 2 * WEEK, window_ratio(WEEK, 1)).otherwise(F.lit(0.0))
    monthly_pub = F.when(idx > 2 * MONTH, window_ratio(MONTH, 1)).otherwise(F.lit(0.0))
    return base.select(
        key, order, "views", "idx",
        daily.alias("daily_trend"),
        weekly_at.alias("weekly_trend_at"),
        monthly_at.alias("monthly_trend_at"),
        weekly_pub.alias("weekly_trend"),
        monthly_pub.alias("monthly_trend"),
    )


def daily_trend(counts: DataFrame, key="title", order="dt", views="views") -> DataFrame:
    """W1 only."""
    return trend_table(counts, key, order, views).select(key, order, "views", "daily_trend")


def weekly_trend(counts: DataFrame, key="title", order="dt", views="views") -> DataFrame:
    """W2 (+ published alignment W4)."""
    return trend_table(counts, key, order, views).select(
        key, order, "views", "weekly_trend_at", "weekly_trend")


def monthly_trend(counts: DataFrame, key="title", order="dt", views="views") -> DataFrame:
    """W3 (+ published alignment W4)."""
    return trend_table(counts, key, order, views).select(
        key, order, "views", "monthly_trend_at", "monthly_trend")


def trend_series(trends: DataFrame, key: str = "title", order: str = "dt") -> DataFrame:
    """Trend table -> one row per key with the published lists (S9 input).

    weekly/monthly lists get the trailing element the source emits (the
    value computed at the last index), so their length is n + 1 when the
    series has more than 13 points and 1 otherwise.
    """
    pts = F.array_sort(F.collect_list(F.struct(
        F.col(order).alias("o"), F.col("views").alias("v"), F.col("daily_trend").alias("d"),
        F.col("weekly_trend").alias("w"), F.col("monthly_trend").alias("m"),
        F.col("weekly_trend_at").alias("wa"), F.col("monthly_trend_at").alias("ma"))))
    g = trends.groupBy(key).agg(pts.alias("_p"))
    n = F.size("_p")
    last = F.element_at("_p", -1)

    def published(field: str, at_field: str) -> Column:
        full = F.concat(F.col(f"_p.{field}"), F.array(last[at_field]))
        return F.when(n > 13, full).otherwise(F.array(F.lit(0.0)))

    return g.select(
        key,
        F.col("_p.o").alias("dates"),
        F.col("_p.v").alias("views"),
        F.col("_p.d").alias("daily"),
        published("w", "wa").alias("weekly"),
        published("m", "ma").alias("monthly"),
    )
