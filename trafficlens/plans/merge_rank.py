"""Entry 3: attach page ids to new day counts, merge them into the history
timelines, score every page and project `pages` / `daily_trends`.

One DAG; the merged timelines are written and also scored, so they are
persisted (memory and disk: a lost executor recomputes its blocks from
lineage). Scores are arithmetic on a row's arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.operators import lookups as L
from trafficlens.operators import ranking as RK
from trafficlens.operators import timelines as TL


@dataclass
class MergeResult:
    timelines: DataFrame      # new_daily_timelines
    scored: DataFrame         # new_pages_raw
    pages: DataFrame          # new_pages
    daily_trends: DataFrame   # new_daily_trends
    unmatched: DataFrame      # titles with no lookup entry


def page_day_counts(day_counts: DataFrame, lookup: DataFrame) -> DataFrame:
    """L5 + D7: (page_id, dt, views) summed over all titles of a page."""
    cid = L.counts_with_id(day_counts, lookup)
    return cid.groupBy("page_id", "dt").agg(F.sum("views").cast("bigint").alias("views"))


def merge_and_rank(history: DataFrame, day_counts: DataFrame, lookup: DataFrame,
                   pages: DataFrame, keep_new: bool = False, persist: bool = True) -> MergeResult:
    return rank_merged(history, page_day_counts(day_counts, lookup), pages,
                       L.unmatched_titles(day_counts, lookup), keep_new, persist)


def rank_merged(history: DataFrame, counts: DataFrame, pages: DataFrame, unmatched: DataFrame,
                keep_new: bool = False, persist: bool = True) -> MergeResult:
    """As above, on counts that already have page ids: (page_id, dt, views)."""
    merged = TL.merge_timelines(history, counts, keep_new=keep_new)
    if persist:
        merged = merged.persist(StorageLevel.MEMORY_AND_DISK)
    scored = RK.rank_arrays(merged).select("page_id", "total_pageviews", "monthly_trend",
                                           "daily_trend", "error")
    return MergeResult(merged, scored, TL.attach_pages(pages, scored),
                       TL.daily_trend_rows(pages, scored), unmatched)


def write_version(result: MergeResult, root: str, batch_id: int) -> str:
    """Write one merge as version ``batch_id``; re-running the same batch id
    rewrites the same version from the same inputs (idempotent)."""
    out = f"{root.rstrip('/')}/version={batch_id}"
    result.timelines.write.mode("overwrite").parquet(f"{out}/daily_timelines")
    result.pages.write.mode("overwrite").parquet(f"{out}/pages")
    result.daily_trends.write.mode("overwrite").parquet(f"{out}/daily_trends")
    result.timelines.unpersist()
    return out
