"""Page ranking scores.

Source rules, on a date-sorted series c[0..n-1] with a stored total:
- monthly (W5): sum(c[-15:]) - sum(c[-30:-15])
- daily   (W6): (c[-1] - c[-8]) * (1 + ln(1 + sum(c[-8:-1])))
- error   (W7): 1 / sqrt(total)
- bad row (W8): when any of them fails (n < 8, total NULL or <= 0) all three
  are 0 and the total is kept.

Two forms: ``rank_long`` on a long (key, order, views) table (one window on
the key + a grouped aggregate that reuses its partitioning, so a single
Exchange), and ``rank_arrays`` on timeline rows that already hold the series
(pure per-row array expressions, no shuffle at all).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.functions.scalars import sum_array


def _scores(n: Column, total: Column, last15: Column, prev15: Column,
            y2: Column, y1: Column, wk: Column) -> list[Column]:
    ok = (n >= 8) & total.isNotNull() & (total > 0)
    monthly = (last15 - prev15).cast("double")
    daily = (y2 - y1).cast("double") * (F.lit(1.0) + F.log(F.lit(1.0) + wk.cast("double")))
    error = F.lit(1.0) / F.sqrt(total.cast("double"))
    zero = F.lit(0.0)
    return [F.when(ok, monthly).otherwise(zero).alias("monthly_trend"),
            F.when(ok, daily).otherwise(zero).alias("daily_trend"),
            F.when(ok, error).otherwise(zero).alias("error")]


def rank_long(counts: DataFrame, key: str = "title", order: str = "dt",
              views: str = "views", total: DataFrame | None = None) -> DataFrame:
    """(key, total_pageviews, n, monthly_trend, daily_trend, error).

    ``total`` may hold a stored (key, total_pageviews); by default the total
    is the sum of the series.
    """
    r = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))
    v = F.col(views)
    rr = counts.select(key, views, r.alias("_r"))
    z = F.lit(0).cast("bigint")
    g = rr.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(v).cast("bigint").alias("_sum"),
        F.coalesce(F.sum(F.when(F.col("_r") <= 15, v)), z).alias("_last15"),
        F.coalesce(F.sum(F.when(F.col("_r").between(16, 30), v)), z).alias("_prev15"),
        F.max(F.when(F.col("_r") == 1, v)).alias("_y2"),
        F.max(F.when(F.col("_r") == 8, v)).alias("_y1"),
        F.coalesce(F.sum(F.when(F.col("_r").between(2, 8), v)), z).alias("_wk"),
    )
    if total is not None:
        g = g.join(total, key, "left")
    else:
        g = g.withColumn("total_pageviews", F.col("_sum"))
    t = F.col("total_pageviews")
    return g.select(key, t.alias("total_pageviews"), "n",
                    *_scores(F.col("n"), t, F.col("_last15"), F.col("_prev15"),
                             F.col("_y2"), F.col("_y1"), F.col("_wk")))


def rank_arrays(timelines: DataFrame, key: str = "page_id", dates: str = "dates",
                views: str = "pageviews", total: str = "total_pageviews") -> DataFrame:
    """W5-W8 on rows holding (dates array, views array, total)."""
    s = F.array_sort(F.arrays_zip(F.col(dates).alias("d"), F.col(views).alias("v")))
    df = timelines.select(key, F.col(total).alias("total_pageviews"),
                          F.transform(s, lambda x: x["v"]).alias("_v"))
    v = F.col("_v")
    n = F.size(v)

    def seg(lo_from_end: int, hi_from_end: int) -> Column:
        # sum of v[n-lo : n-hi] (python slice from the end), clipped at 0
        start = F.greatest(n - lo_from_end, F.lit(0))
        stop = F.greatest(n - hi_from_end, F.lit(0))
        length = F.greatest(stop - start, F.lit(0))
        return sum_array(F.slice(v, start + 1, length))

    return df.select(
        key, "total_pageviews", n.alias("n"),
        *_scores(n, F.col("total_pageviews"), seg(15, 0), seg(30, 15),
                 F.try_element_at(v, F.lit(-1)), F.try_element_at(v, F.lit(-8)), seg(8, 1)))


def consecutive_ratio(counts: DataFrame, key: str = "title", order: str = "ts",
                      views: str = "views") -> DataFrame:
    """From the 2nd point of each key: (key, t, prev_t, count/prev - 1)
    with a previous count of 0 read as 1."""
    w = Window.partitionBy(key).orderBy(order)
    prev = F.lag(views).over(w)
    prev_t = F.lag(order).over(w)
    df = counts.select(key, order, prev_t.alias("prev_" + order), F.col(views),
                       prev.alias("_prev"))
    p = F.when(F.col("_prev") == 0, F.lit(1)).otherwise(F.col("_prev"))
    return (df.where(F.col("_prev").isNotNull())
              .select(key, order, "prev_" + order,
                      (F.col(views).cast("double") / p - F.lit(1.0)).alias("ratio")))
