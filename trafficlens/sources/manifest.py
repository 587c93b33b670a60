"""Listing manifest (S23): hourly file names linked from directory pages.

Links are pulled from the html with ``regexp_extract_all`` (per row), kept
when they start with the prefix, and every file is given a shard by its
hour: 0-7 -> 0, 8-15 -> 1, 16-23 -> 2 (three download hosts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.functions.scalars import file_stamp, stamp_to_ts

HREF_PATTERN = r'href="([^"]*)"'


def links(pages: DataFrame, html: str = "html", keep: tuple = ("page_id",)) -> DataFrame:
    return pages.select(*keep, F.explode(F.regexp_extract_all(F.col(html), F.lit(HREF_PATTERN),
                                                              F.lit(1))).alias("name"))


def listing_manifest(pages: DataFrame, prefix: str = "pagecounts-", shards: int = 3,
                     html: str = "html", keep: tuple = ("page_id",)) -> DataFrame:
    lk = links(pages, html, keep).where(F.col("name").startswith(prefix))
    ts = stamp_to_ts(file_stamp(F.col("name")))
    return lk.select(*keep, "name", ts.alias("ts"),
                     F.floor(F.hour(ts) / F.lit(24 // shards)).cast("int").alias("shard"))
