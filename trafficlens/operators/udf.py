"""User-code surface.

Z1  script transform: a pandas function over row batches (``mapInPandas``,
    Arrow transfer), the counterpart of piping rows through an external
    script. Spark still partitions the rows; the function sees one batch.
    ``line_transform`` pipes tab-separated lines through an external program
    instead (SQL ``TRANSFORM .. USING``).
Z2  per-title lambdas are not needed: every built-in rule is a Column.
Z3  user title rules: any Column -> Column predicate, combined with the
    built-in ones (see ``titles.parse_lines(extra_rule=...)``).
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Functions of this module run inside Python workers; ship them by value so
# executors need only numpy/pandas, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def script_transform(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                     schema: str) -> DataFrame:
    """Run ``fn`` on every Arrow batch of ``df``; ``schema`` is its output."""
    def run(batches):
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


RANK_SCHEMA = ("page_id bigint, total_pageviews bigint, monthly_trend double, "
               "daily_trend double, error double")


def rank_batch(pdf: pd.DataFrame) -> pd.DataFrame:
    """The ranking rule (W5-W8) written as plain Python over one batch of
    timeline rows: the kind of user script Z1 carries."""
    out = {"page_id": [], "total_pageviews": [], "monthly_trend": [], "daily_trend": [],
           "error": []}
    for pid, dates, views, total in zip(pdf["page_id"], pdf["dates"], pdf["pageviews"],
                                        pdf["total_pageviews"]):
        order = np.argsort(np.asarray(dates, dtype=object), kind="stable")
        c = np.asarray(views, dtype=np.int64)[order]
        n = len(c)
        ok = n >= 8 and total is not None and not pd.isna(total) and total > 0
        if ok:
            monthly = float(c[-15:].sum() - c[-30:-15].sum())
            wk = float(c[-8:-1].sum())
            daily = float(c[-1] - c[-8]) * (1.0 + np.log(1.0 + wk))
            error = 1.0 / np.sqrt(float(total))
        else:
            monthly = daily = error = 0.0
        out["page_id"].append(pid)
        out["total_pageviews"].append(total)
        out["monthly_trend"].append(monthly)
        out["daily_trend"].append(daily)
        out["error"].append(error)
    return pd.DataFrame(out)


def line_transform(df: DataFrame, script: str, schema: str, program: str | None = None) -> DataFrame:
    """The rows of ``df`` as tab-separated lines through ``script``, which
    Spark sends to the executors; its lines are read by ``schema``. Values must
    hold no tab and no line break. ``program`` runs the script on an executor:
    the workers' Python unless given (``spark.pyspark.python``)."""
    spark = df.sparkSession
    spark.sparkContext.addFile(script)
    program = program or spark.conf.get("spark.pyspark.python", None) or os.environ.get("PYSPARK_PYTHON") or "python3"
    tabs = "ROW FORMAT DELIMITED FIELDS TERMINATED BY '\t' LINES TERMINATED BY '\n' NULL DEFINED AS '\\\\N'"
    df.createOrReplaceTempView(view := f"_lines_{uuid.uuid4().hex[:12]}")
    return spark.sql(f"SELECT TRANSFORM({', '.join(f'`{c}`' for c in df.columns)}) {tabs} "
                     f"USING '{program} {os.path.basename(script)}' AS ({schema}) {tabs} FROM {view}")


RANK_LINES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "rank_lines.py")
