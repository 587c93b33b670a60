"""Trend-line text.

A line is ``title|d1,d2|c1,c2|daily..|weekly..|monthly..|`` (trailing pipe).
In a title '%', '|', CR and LF are written as %25, %7C, %0D and %0A, and a
NULL value as \\N, so lines read back as what was written (decision D14).
Reading keeps a ``bad`` flag instead of printing and skipping malformed lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.operators.trends import trend_series


NULL_MARK = r"\N"
ESCAPES = [("%", "%25"), ("|", "%7C"), ("\r", "%0D"), ("\n", "%0A")]


def _join(c: str) -> Column:
    return F.array_join(F.col(c).cast("array<string>"), ",", NULL_MARK)


def format_lines(series: DataFrame, key: str = "title") -> DataFrame:
    """Series lists -> one text line per title."""
    title = F.col(key)
    for plain, code in ESCAPES:
        title = F.replace(title, F.lit(plain), F.lit(code))
    parts = [title] + [_join(c) for c in ("dates", "views", "daily", "weekly", "monthly")]
    return series.select(F.concat(F.concat_ws("|", *parts), F.lit("|")).alias("value"))


def write_trend_lines(trends: DataFrame, path: str, key: str = "title", order: str = "dt") -> str:
    """Trend table -> text lines (gz), overwriting the target."""
    format_lines(trend_series(trends, key, order), key).write.mode("overwrite") \
        .option("compression", "gzip").text(path)
    return path


def parse_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Text lines -> typed lists + bad flag."""
    f = F.split(F.col(col), r"\|", -1)

    def lst(i: int, typ: str) -> Column:
        return F.transform(F.split(F.get(f, i), ","), lambda x: x.try_cast(typ))

    def wrong(i: int, typ: str) -> Column:
        """A value that is neither a number nor the mark for NULL."""
        return F.exists(F.split(F.get(f, i), ","), lambda x: (x != NULL_MARK) & x.try_cast(typ).isNull())

    title = F.get(f, 0)
    for plain, code in reversed(ESCAPES):
        title = F.replace(title, F.lit(code), F.lit(plain))
    no_number = wrong(3, "double") | wrong(4, "double") | wrong(5, "double")
    df = lines.select(title.alias("title"),
                      F.split(F.get(f, 1), ",").alias("dates"),
                      lst(2, "bigint").alias("views"), lst(3, "double").alias("daily"),
                      lst(4, "double").alias("weekly"), lst(5, "double").alias("monthly"),
                      F.size(f).alias("_n"), no_number.alias("_wrong"))
    n = F.size("dates")
    bad = F.coalesce((F.col("_n") < 6) | (n != F.size("views")) | (n != F.size("daily"))
                     | ~F.size("weekly").isin(F.lit(1), n + 1) | ~F.size("monthly").isin(F.lit(1), n + 1)
                     | F.exists("views", lambda x: x.isNull()) | F.col("_wrong"), F.lit(True))
    return df.select("title", "dates", "views", "daily", "weekly", "monthly", bad.alias("bad"))


def read_trend_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.text(path))
