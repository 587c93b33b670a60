"""Missing hours (S22) and optional gap filling (decision D5).

For every key the hours between its first and last observed hour are
generated with ``sequence`` + ``explode`` (bounded by the key's time span,
not by its row count) and anti-joined with the observed hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _span(df: DataFrame, ts: str, by: list[str], step: str) -> DataFrame:
    g = df.groupBy(*by).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    return g.select(*by, F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {step}"))).alias(ts))


def missing_hours(df: DataFrame, ts: str = "ts", by: str | None = None) -> DataFrame:
    """Hours in [first, last] with no row; per key when ``by`` is given."""
    keys = [by] if by else []
    seen = df.select(*keys, ts).distinct() if keys else df.select(ts).distinct()
    return _span(df, ts, keys, "1 HOUR").join(seen, keys + [ts], "left_anti")


def fill_gaps(counts: DataFrame, key: str = "title", dt: str = "dt",
              views: str = "views") -> DataFrame:
    """Daily series with the missing days of each key set to 0 views."""
    day = counts.select(key, F.to_date(dt, "yyyyMMdd").alias("_d"), views)
    span = _span(day, "_d", [key], "1 DAY")
    full = span.join(day, [key, "_d"], "left")
    return full.select(key, F.date_format("_d", "yyyyMMdd").alias(dt),
                       F.coalesce(F.col(views), F.lit(0).cast("bigint")).alias(views))
