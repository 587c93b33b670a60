"""Search documents from a trend table (W-docs, S19).

One document per (title, date) with a deterministic id sha1(title + date),
so re-publishing the same day overwrites instead of duplicating.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.functions.scalars import doc_id, stamp_to_date

DOC_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("page_date", T.DateType()),
    T.StructField("page_views", T.LongType()),
    T.StructField("daily_trend", T.FloatType()),
    T.StructField("weekly_trend", T.FloatType()),
    T.StructField("monthly_trend", T.FloatType()),
])


def search_documents(trends: DataFrame, key: str = "title", dt: str = "dt") -> DataFrame:
    return trends.select(
        doc_id(F.col(key), F.col(dt)).alias("_id"),
        F.col(key).alias("title"),
        stamp_to_date(dt).alias("page_date"),
        F.col("views").cast("bigint").alias("page_views"),
        F.col("daily_trend").cast("float").alias("daily_trend"),
        F.col("weekly_trend").cast("float").alias("weekly_trend"),
        F.col("monthly_trend").cast("float").alias("monthly_trend"),
    )


def documents_from_series(series: DataFrame, key: str = "title") -> DataFrame:
    """Documents from the list form (title, dates, views, daily, weekly,
    monthly): zip by position; a weekly/monthly value past the end is 0.0,
    a NULL inside a list stays NULL."""
    z = series.select(key, F.posexplode("dates").alias("_i", "_d"), "views", "daily",
                      "weekly", "monthly")
    i = F.col("_i") + 1

    def at(c):
        return F.when(i <= F.size(c), F.try_element_at(F.col(c), i)).otherwise(F.lit(0.0))

    return z.select(
        doc_id(F.col(key), F.col("_d")).alias("_id"),
        F.col(key).alias("title"),
        stamp_to_date("_d").alias("page_date"),
        F.try_element_at("views", i).cast("bigint").alias("page_views"),
        at("daily").cast("float").alias("daily_trend"),
        at("weekly").cast("float").alias("weekly_trend"),
        at("monthly").cast("float").alias("monthly_trend"),
    )
