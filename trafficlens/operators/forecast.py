"""Per-title traffic forecast (M1).

Least squares of views on the 0-based point index, per title, with the
built-in ``regr_slope`` / ``regr_intercept`` aggregates (partial
aggregation before the shuffle), extrapolated ``h`` points ahead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def forecast(counts: DataFrame, horizons=(1, 7), key: str = "title", order: str = "dt",
             views: str = "views") -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    pts = counts.select(key, F.col(views).cast("double").alias("y"),
                        (F.row_number().over(w) - 1).cast("double").alias("x"))
    fit = pts.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
    )
    last_x = F.col("n") - 1
    cols = [F.col("intercept") + F.col("slope") * (last_x + h) for h in horizons]
    return fit.select(key, "n", "slope", "intercept",
                      *[c.alias(f"forecast_{h}") for c, h in zip(cols, horizons)])


SEASON = 7


def seasonal_forecast(counts: DataFrame, horizons=(1, 7), alpha: float = 0.3, gamma: float = 0.2, season: int = SEASON,
                      key: str = "title", order: str = "dt", views: str = "views") -> DataFrame:
    """Additive seasonal smoothing per title: (key, n, level, error, forecast_h).

    One fold over a title's points: the prediction is the level plus the
    weekday's part, and its error moves the level by ``alpha`` and the part by
    ``gamma (1 - alpha)``. ``error`` is the rolling-origin one: the mean absolute
    error of each point predicted from those before it, from the second season
    on; null for shorter series. A title's points are as many as its days."""
    points = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(views).cast("double").alias("y"))))
    got = counts.groupBy(key).agg(F.transform(points, lambda p: p["y"]).alias("_y"))

    def step(acc, y):
        part = acc["i"] % season
        e = y - acc["level"] - F.get(acc["season"], part)
        late = acc["i"] >= season
        return F.struct(
            (acc["i"] + 1).alias("i"), (acc["level"] + alpha * e).alias("level"),
            F.transform(acc["season"], lambda s, k: F.when(k == part, s + gamma * (1 - alpha) * e).otherwise(s)).alias("season"),
            (acc["off"] + F.when(late, F.abs(e)).otherwise(0.0)).alias("off"))

    start = F.struct(F.lit(0).alias("i"), F.get("_y", F.lit(0)).alias("level"),
                     F.array_repeat(F.lit(0.0), season).alias("season"), F.lit(0.0).alias("off"))
    fit = got.select(key, F.aggregate("_y", start, step).alias("f"))
    n = F.col("f.i")
    return fit.select(
        key, n.cast("bigint").alias("n"), F.col("f.level").alias("level"),
        F.when(n > season, F.col("f.off") / (n - season)).alias("error"),
        *[(F.col("f.level") + F.get("f.season", (n - 1 + h) % season)).alias(f"forecast_{h}") for h in horizons])
