"""Redirect resolution and the title -> page lookup.

All joins are equi-joins that Spark plans as sort-merge (or, when AQE
measures a side below the broadcast threshold at runtime, as a broadcast
hash join). The one many-to-one join with a possibly hot key is
``redirect.rd_title = page.page_title`` (thousands of redirects may point to
one page); its other side is unique per title, so AQE's skew-join split of
the hot partition is exact (the single matching page row is replicated to
each split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.functions.scalars import underscores_to_spaces

LOOKUP_COLUMNS = ["redirect_title", "true_title", "page_id", "page_latest"]


def main_namespace(df: DataFrame, ns: str) -> DataFrame:
    """keep namespace-0 rows (applied to pages and redirects)."""
    return df.where(F.col(ns) == 0)


def resolve_redirects(page: DataFrame, redirect: DataFrame) -> DataFrame:
    """L1: (redirect_title, true_title, page_id, page_latest) for every
    redirect whose source and target pages exist; one hop only."""
    src = page.select(F.col("page_id").alias("rd_from"), F.col("page_title").alias("redirect_title"))
    dst = page.select(F.col("page_title").alias("rd_title"), "page_id", "page_latest")
    r = redirect.select("rd_from", "rd_title")
    return (r.join(src, "rd_from").join(dst, "rd_title")
             .select("redirect_title", underscores_to_spaces(F.col("rd_title")).alias("true_title"),
                     "page_id", "page_latest"))


def non_redirects(page: DataFrame, redirect: DataFrame) -> DataFrame:
    """L2: pages that are not a redirect source (explicit anti-join)."""
    p = page.join(redirect.select(F.col("rd_from").alias("page_id")), "page_id", "left_anti")
    return p.select(F.col("page_title").alias("redirect_title"),
                    underscores_to_spaces(F.col("page_title")).alias("true_title"),
                    "page_id", "page_latest")


def page_lookups(page: DataFrame, redirect: DataFrame) -> DataFrame:
    """L3: L1 union L2 (their redirect titles are disjoint)."""
    return resolve_redirects(page, redirect).unionByName(non_redirects(page, redirect))


def build_lookup(page: DataFrame, redirect: DataFrame) -> DataFrame:
    """L4: namespace filter, then L1 and L2, then the union."""
    p = main_namespace(page, "page_namespace")
    r = main_namespace(redirect, "rd_namespace")
    return page_lookups(p, r)


def counts_with_id(counts: DataFrame, lookup: DataFrame, key: str = "title") -> DataFrame:
    """Attach page ids to (title, ...) counts; unmatched titles drop out."""
    lk = lookup.select(F.col("redirect_title").alias(key), "page_id")
    return counts.join(lk, key)


def unmatched_titles(counts: DataFrame, lookup: DataFrame, key: str = "title") -> DataFrame:
    """Titles with no lookup entry (reported instead of silently lost)."""
    lk = lookup.select(F.col("redirect_title").alias(key))
    return counts.join(lk, key, "left_anti")
