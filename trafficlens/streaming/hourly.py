"""Hourly ingestion as Structured Streaming.

R1  new files are picked up exactly once: file source + checkpoint,
    ``trigger(availableNow=True)`` for scheduled runs.
R2  hourly tumbling counts per title with an event-time watermark; append
    mode emits an hour once no later data can change it.
R3  the watermark delay is the lateness rule (a parameter).
R4  ``foreachBatch`` adds each batch to the stored days: the new totals of the
    (title, day) pairs it touched, keyed by the batch id; a replayed batch
    rewrites its own rows from the same inputs, so nothing is counted twice.
R5  trends are recomputed only for titles the batch touched (semi-join).
R6  their search documents are published from the first touched day on
    (idempotent ids).

State is bounded by the watermark (one row per open hour and title).
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.functions import titles as X
from trafficlens.functions.scalars import file_place, file_stamp, instant_to_wallclock, number_to_instant, place_number, stamp_to_instant
from trafficlens.operators import timelines as TL
from trafficlens.operators.documents import search_documents
from trafficlens.operators.trends import trend_table


def line_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming lines with their file and its hour (event time).

    ``hour_name`` is what tells the hour: where files lie in hour directories
    the short name of that directory, else the path."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(source)
    path = name = F.col("_metadata.file_path")
    if df.dtypes == [("value", "string"), ("src", "string")]:
        plain = F.col("src").startswith("pagecounts-") & (F.length("src") == 26) & ~F.col("_metadata.file_name").contains("pagecounts-")
        name = F.when(plain, F.col("src")).otherwise(path)
    stamp = file_stamp(path)
    return df.select("value", stamp.alias("stamp"), stamp_to_instant(stamp).alias("ts"), path.alias("file_path"),
                     name.alias("hour_name"))


def hourly_counts_stream(lines: DataFrame, delay: str = "48 hours", **rules) -> DataFrame:
    """(title, ts, views) per closed hour. The default delay is the
    source's 48-hour offset before an hour is used."""
    # the event time is told once a line and step by step, as its steps refer
    # to each other several times
    if "hour_name" in lines.columns:
        lines = X.once(lines, ["value"], file_place("hour_name").alias("_place"))
        lines = X.once(lines, ["value"], place_number("_place").alias("_number"))
        lines = lines.select("value", number_to_instant("_number").alias("ts"))
    # rejected lines: NULL title and views, dropped after the aggregate (they
    # move the watermark, see also batch_trends.counts_from_parsed)
    g = X.counted_lines(lines, keep=["ts"], **rules)
    agg = (g.withWatermark("ts", delay)
            .groupBy(F.window("ts", "1 hour"), "title")
            .agg(F.sum("views").cast("bigint").alias("views")))
    return (agg.where(F.col("views").isNotNull())
               .select("title", instant_to_wallclock(F.col("window.start")).alias("ts"), "views"))


def run_to_parquet(counts: DataFrame, out: str, checkpoint: str, available_now: bool = True):
    """Append closed hours to a parquet table (file sink: exactly once)."""
    w = (counts.writeStream.format("parquet").outputMode("append")
               .option("path", out).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def committed(spark: SparkSession, root: str, before: int | None = None) -> int | None:
    """The newest batch (below ``before``) whose outputs are all written."""
    try:
        done = spark.read.schema("batch bigint").json(f"{root.rstrip('/')}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if before is not None:
        done = done.where(F.col("batch") < before)
    return done.agg(F.max("batch")).first()[0]


# stored closed hours; dt and batch are partition columns (typed here, not inferred)
HOURLY_SCHEMA = "title string, ts timestamp_ntz, views bigint, dt string, batch bigint"


# totals of a day as of a batch; the newest batch of a (title, dt) holds
DAYS_SCHEMA = "title string, views bigint, dt string, batch bigint"


def stored_days(spark: SparkSession, root: str, upto: int) -> DataFrame:
    """(title, dt, views) after batch ``upto``."""
    days = spark.read.schema(DAYS_SCHEMA).parquet(f"{root.rstrip('/')}/days")
    return (days.where(F.col("batch") <= upto)
                .groupBy("title", "dt").agg(F.max_by("views", "batch").alias("views")))


class TimelineMerger:
    """foreachBatch target for R4-R6, keyed by title.

    Layout under ``root``:
      hourly/dt=<day>/batch=<id>   closed hours of each batch, by day
      days/dt=<day>/batch=<id>     totals of the (title, day) pairs it touched
      docs/version=<id>            documents of the touched titles, from the
                                   first day the batch touched of each
      commits/version=<id>         written last: the version is whole
    A batch writes what it touched and no copy of the rest; the timelines of
    a version are read from the days (``timelines``). Only batch 0 may start
    from an empty history, so a moved root stops the stream instead of
    publishing a history without its past. A batch rewrites only its own
    partitions (dynamic overwrite), and reads the closed hours from its
    earliest day on: a bound on the partition column.
    """

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def _write(self, rows: DataFrame, name: str, batch_id: int) -> str:
        path = f"{self.root}/{name}"
        (rows.withColumn("batch", F.lit(batch_id).cast("bigint"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("dt", "batch").parquet(path))
        return path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id > 0 and committed(spark, self.root, before=batch_id) is None:
            raise RuntimeError(f"no committed version before batch {batch_id} under {self.root}")
        hourly = self._write(batch.select("title", "ts", "views", F.date_format("ts", "yyyyMMdd").alias("dt")),
                             "hourly", batch_id)
        hours = spark.read.schema(HOURLY_SCHEMA).parquet(hourly).where(F.col("batch") <= batch_id)
        touched = hours.where(F.col("batch") == batch_id).select("title", "dt").distinct()
        earliest = touched.select(F.min("dt")).first()[0]  # one value; none without rows
        days = (hours.where(F.col("dt") >= F.lit(earliest))
                     .join(touched, ["title", "dt"], "left_semi")
                     .groupBy("title", "dt").agg(F.sum("views").cast("bigint").alias("views")))
        self._write(days, "days", batch_id)
        # A changed day changes the trends of that day and of later ones
        first = touched.groupBy("title").agg(F.min("dt").alias("_first"))
        points = stored_days(spark, self.root, batch_id).join(first, "title", "left_semi")
        changed = trend_table(points).join(first, "title").where(F.col("dt") >= F.col("_first")).drop("_first")
        search_documents(changed).write.mode("overwrite").json(f"{self.root}/docs/version={batch_id}")
        spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch")).coalesce(1) \
            .write.mode("overwrite").json(f"{self.root}/commits/version={batch_id}")


def run_merge(counts: DataFrame, root: str, checkpoint: str, available_now: bool = True):
    q = (counts.writeStream.outputMode("append").foreachBatch(TimelineMerger(root))
               .option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    s = q.start()
    if available_now:
        s.awaitTermination()
    return s


def late_rows(query) -> int:
    """(title, hour) rows a query left out because their hour was closed, in
    the progress reports it still holds (``numRecentProgressUpdates``). Hours
    with late lines are counted anew by the batch entry over their files."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress
               for op in json.loads(p.json)["stateOperators"])


def timelines(spark: SparkSession, root: str, version: int) -> DataFrame:
    """(title, dates, pageviews, total_pageviews) after batch ``version``."""
    return TL.timelines_from_counts(stored_days(spark, root, version), key="title")


def latest_version(spark: SparkSession, root: str) -> DataFrame:
    """The timelines of the newest committed version."""
    return timelines(spark, root, committed(spark, root))
