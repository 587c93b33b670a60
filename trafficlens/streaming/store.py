"""A store of day totals fed by the hourly stream (R3-R6 in full).

One streaming query parses each file once and hands its micro-batches to
``StreamStore`` (``foreachBatch``). Under ``root``, by batch id:

  open/dt=/batch=      counts of the hours that arrived, closed or not
  late/dt=/batch=      counts that arrived for hours already closed (R3)
  days/dt=/batch=      new totals of the (title, day) pairs a batch changed
  tails/batch=         last points of the titles it changed (R5)
  trends/batch=        trends from the first day it changed of each title on
  docs/version=        search documents of those trends (R6)
  commits/version=     written last: batch, newest hour seen, closed up to
  compact/dt=/asof=    whole days, rewritten by compaction (R4)
  tails_base/upto=     whole tails, likewise
  compactions/upto=    written last: the state of each day that holds

Hours close when the newest hour seen is ``delay`` behind them, as a
watermark does; unlike there, lines of closed hours are kept and added to
their day by the batch they arrive in. A total is the stored one plus what
the batch brings, so hours are never added up again. A replayed batch
reads the same earlier versions and rewrites its own partitions.

Trends come from tails: the last ``TAIL`` points of a title and how many
stand before them. The monthly trend looks 61 points back, so a change
within the last ``TAIL - LOOKBACK`` points needs the tail alone; titles with
an older change are read whole, and only they are.

A version is read from the compacted days that held at the newest compaction
up to it and the batches since: files per version follow the days and the
batches since the compaction, not all batches ever. Versions from the
newest compaction that ``expire`` keeps on stay readable.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.functions import titles as X
from trafficlens.functions.scalars import file_stamp, hour_of, stamp_to_ts
from trafficlens.operators import timelines as TL
from trafficlens.operators.documents import search_documents
from trafficlens.operators.trends import MONTH, trend_table

LOOKBACK = 2 * MONTH + 1
TAIL = LOOKBACK + 31
HOURS = "title string, ts timestamp_ntz, views bigint, dt string, batch bigint"
DAYS = "title string, views bigint, dt string, batch bigint"
COMPACT = "title string, views bigint, dt string, asof bigint"
POINTS = "array<struct<dt:string,views:bigint>>"
TAILS = f"title string, before bigint, points {POINTS}, batch bigint"
TAILS_BASE = f"title string, before bigint, points {POINTS}, upto bigint"
TRENDS = ("title string, dt string, views bigint, idx bigint, daily_trend double, weekly_trend_at double, "
          "monthly_trend_at double, weekly_trend double, monthly_trend double, batch bigint")
_TIME = "%Y-%m-%d %H:%M:%S"


class StreamStore:
    def __init__(self, root: str, delay_hours: int = 48):
        self.root, self.delay = root.rstrip("/"), timedelta(hours=delay_hours)

    # ------------------------------------------------------------ files

    def _read(self, spark: SparkSession, name: str, schema: str, paths: list[str] | None = None) -> DataFrame:
        """A table of the store; empty before its first write."""
        base = f"{self.root}/{name}"
        if paths == []:
            return spark.createDataFrame([], schema)
        try:
            return spark.read.schema(schema).option("basePath", base).parquet(*(paths or [base]))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def _json(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        try:
            return spark.read.schema(schema).json(f"{self.root}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, name: str, batch_id: int, by: tuple[str, ...] = ("dt", "batch")) -> None:
        rows.withColumn(by[-1], F.lit(batch_id).cast("bigint")).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{self.root}/{name}")

    def _mark(self, spark: SparkSession, name: str, version: int, rows: list[dict]) -> None:
        spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").coalesce(1) \
            .write.mode("overwrite").text(f"{self.root}/{name}={version}")

    # ------------------------------------------------------------ versions

    def commit(self, spark: SparkSession, before: int | None = None) -> dict | None:
        """The newest commit (below batch ``before``): batch, newest, closed."""
        done = self._json(spark, "commits", "batch bigint, newest string, closed string")
        if before is not None:
            done = done.where(F.col("batch") < before)
        last = done.orderBy(F.desc("batch")).first()
        return last.asDict() if last else None

    def version(self, spark: SparkSession) -> int | None:
        last = self.commit(spark)
        return last["batch"] if last else None

    def compaction(self, spark: SparkSession, upto: int) -> tuple[int, dict[str, int]]:
        """The newest compaction up to a version, and by day the compacted state
        that holds (as many as the time span has days)."""
        done = self._json(spark, "compactions", "dt string, asof bigint, upto bigint").where(F.col("upto") <= upto)
        newest = done.agg(F.max("upto")).first()[0]
        if newest is None:
            return -1, {}
        return newest, {r.dt: r.asof for r in done.where(F.col("upto") == newest).collect() if r.dt is not None}

    def days(self, spark: SparkSession, version: int, only: list[str] | None = None) -> DataFrame:
        """(title, dt, views) as of a version, of all days or the listed ones."""
        upto, states = self.compaction(spark, version)
        paths = [f"{self.root}/compact/dt={d}/asof={n}" for d, n in sorted(states.items()) if only is None or d in only]
        since = self._read(spark, "days", DAYS).where((F.col("batch") > upto) & (F.col("batch") <= version))
        if only is not None:
            since = since.where(F.col("dt").isin(only))
        whole = self._read(spark, "compact", COMPACT, paths).select("title", "views", "dt", F.lit(-1).cast("bigint").alias("batch"))
        return whole.unionByName(since).groupBy("title", "dt").agg(F.max_by("views", "batch").alias("views"))

    def tails(self, spark: SparkSession, version: int) -> DataFrame:
        """(title, before, points) as of a version."""
        upto, _ = self.compaction(spark, version)
        since = self._read(spark, "tails", TAILS).where((F.col("batch") > upto) & (F.col("batch") <= version))
        whole = self._read(spark, "tails_base", TAILS_BASE, [f"{self.root}/tails_base/upto={upto}"] if upto >= 0 else [])
        both = whole.select("title", "before", "points", F.lit(-1).cast("bigint").alias("batch")).unionByName(since)
        return both.groupBy("title").agg(F.max_by(F.struct("before", "points"), "batch").alias("t")) \
            .select("title", "t.before", "t.points")

    def trends(self, spark: SparkSession, version: int) -> DataFrame:
        """The newest trends of every (title, day) up to a version."""
        found = self._read(spark, "trends", TRENDS).where(F.col("batch") <= version)
        row = F.struct(*(c.split()[0] for c in TRENDS.split(", ")[2:-1]))
        return found.groupBy("title", "dt").agg(F.max_by(row, "batch").alias("r")).select("title", "dt", "r.*")

    def timelines(self, spark: SparkSession, version: int) -> DataFrame:
        return TL.timelines_from_counts(self.days(spark, version), key="title")

    def late(self, spark: SparkSession) -> DataFrame:
        """(title, ts, views, dt, batch): what arrived after its hour closed."""
        return self._read(spark, "late", HOURS)

    # ------------------------------------------------------------ a micro-batch

    def __call__(self, arrived: DataFrame, batch_id: int) -> None:
        """``arrived``: (title, ts, views) counts of the batch; hours without an
        accepted line have a row without a title."""
        spark = arrived.sparkSession
        last = self.commit(spark, before=batch_id)
        if batch_id > 0 and last is None:
            raise RuntimeError(f"no committed version before batch {batch_id} under {self.root}")
        before = last["batch"] if last else -1
        self._write(arrived.select("title", "ts", "views", F.date_format("ts", "yyyyMMdd").alias("dt")), "open", batch_id)
        hours = self._read(spark, "open", HOURS).where(F.col("batch") <= batch_id)
        mine = hours.where(F.col("batch") == batch_id)
        seen = mine.agg(F.max("ts")).first()[0]
        newest = max((datetime.strptime(last["newest"], _TIME) if last and last["newest"] else datetime.min), seen or datetime.min)
        was = datetime.strptime(last["closed"], _TIME) if last and last["closed"] else None
        closed = max(was or datetime.min, newest - self.delay) if newest > datetime.min else None
        if closed is not None:
            self._apply(spark, hours, mine, was, closed, batch_id, before)
        self._mark(spark, "commits/version", batch_id, [{
            "batch": batch_id, "newest": newest.strftime(_TIME) if newest > datetime.min else None,
            "closed": closed.strftime(_TIME) if closed else None}])

    def _apply(self, spark, hours, mine, was, closed, batch_id, before) -> None:
        end = F.col("ts") + F.expr("interval 1 hour")
        named = F.col("title").isNotNull()
        to = F.lit(closed).cast("timestamp_ntz")
        closing = hours.where(named & (end <= to) & (F.col("dt") <= closed.strftime("%Y%m%d")))
        late = mine.where(F.lit(False))
        if was is not None:
            since = F.lit(was).cast("timestamp_ntz")
            closing = closing.where((end > since) & (F.col("dt") >= (was - timedelta(hours=1)).strftime("%Y%m%d")))
            late = mine.where(named & (end <= since))
        self._write(late.drop("batch"), "late", batch_id)
        late = self._read(spark, "late", HOURS).where(F.col("batch") == batch_id)
        changes = closing.unionByName(late).groupBy("title", "dt").agg(F.sum("views").cast("bigint").alias("views"))
        touched = [r.dt for r in closing.unionByName(late).select("dt").distinct().collect()]  # days
        old = self.days(spark, before, touched).withColumnRenamed("views", "_old")
        self._write(changes.join(old, ["title", "dt"], "left")
                    .select("title", "dt", (F.coalesce("_old", F.lit(0)) + F.col("views")).alias("views")), "days", batch_id)
        self._trends(spark, batch_id, before)

    def _trends(self, spark, batch_id, before) -> None:
        mine = self._read(spark, "days", DAYS).where(F.col("batch") == batch_id).select("title", "dt", "views")
        first = mine.groupBy("title").agg(F.min("dt").alias("first"), F.collect_list(F.struct("dt", "views")).alias("new"))
        known = first.join(self.tails(spark, before), "title", "left")
        none = F.array().cast(POINTS)
        new_days = F.transform("new", lambda p: p["dt"])
        kept = F.filter(F.coalesce("points", none), lambda p: ~F.array_contains(new_days, p["dt"]))
        points = known.select("title", "first", F.coalesce("before", F.lit(0)).cast("bigint").alias("before"),
                              F.array_sort(F.concat(kept, "new")).alias("points"))
        # enough points before the first change, or no others
        prior = F.size(F.filter("points", lambda p: p["dt"] < F.col("first")))
        points = points.withColumn("near", (F.col("before") == 0) | (prior >= LOOKBACK))
        path = f"{self.root}/scratch/batch={batch_id}"
        points.write.mode("overwrite").parquet(path)
        points = spark.read.parquet(path)
        deep = points.where(~F.col("near")).select("title", "first")
        if not deep.isEmpty():  # older changes: these titles are read whole
            whole = self.days(spark, batch_id).join(deep, "title") \
                .groupBy("title", "first").agg(F.array_sort(F.collect_list(F.struct("dt", "views"))).alias("points"))
            points = points.where("near").drop("near").unionByName(
                whole.select("title", "first", F.lit(0).cast("bigint").alias("before"), "points"))
        cut = F.greatest(F.size("points") - TAIL, F.lit(0))
        self._write(points.select("title", (F.col("before") + cut).cast("bigint").alias("before"),
                                  F.slice("points", cut + 1, F.lit(TAIL)).alias("points")), "tails", batch_id, ("batch",))
        long = points.select("title", F.inline("points"))
        starts = points.select("title", "first", "before")
        changed = trend_table(long).join(starts, "title").where(F.col("dt") >= F.col("first")) \
            .withColumn("idx", (F.col("idx") + F.col("before")).cast("bigint")).drop("first", "before")
        self._write(changed, "trends", batch_id, ("batch",))
        stored = self._read(spark, "trends", TRENDS).where(F.col("batch") == batch_id).drop("batch")
        search_documents(stored).write.mode("overwrite").json(f"{self.root}/docs/version={batch_id}")

    # ------------------------------------------------------------ compaction

    def compact(self, spark: SparkSession) -> int | None:
        """Rewrite the days that batches changed since the last compaction, one
        row a (title, day), and the tails; returns the version compacted."""
        version = self.version(spark)
        if version is None:
            return None
        upto, states = self.compaction(spark, version)
        if upto == version:
            return version
        changed = self._read(spark, "days", DAYS).where((F.col("batch") > upto) & (F.col("batch") <= version)) \
            .select("dt").distinct()
        days = [r.dt for r in changed.collect()]  # days
        if days:
            self._write(self.days(spark, version, days).repartition("dt").sortWithinPartitions("dt", "title"),
                        "compact", version, ("dt", "asof"))
        self._write(self.tails(spark, version), "tails_base", version, ("upto",))
        states |= dict.fromkeys(days, version)
        self._mark(spark, "compactions/upto", version, [{"dt": d, "asof": n} for d, n in states.items()] or [{"dt": None}])
        return version

    def expire(self, spark: SparkSession, keep: int) -> int:
        """Delete what no version from the newest compaction up to ``keep`` on
        needs; returns how many partitions went."""
        upto, _ = self.compaction(spark, keep)
        if upto < 0:
            return 0
        held = {(r.dt, r.asof) for r in self._json(spark, "compactions", "dt string, asof bigint, upto bigint")
                .where(F.col("upto") >= upto).select("dt", "asof").collect()}  # days, a few times
        closed = (self._json(spark, "commits", "batch bigint, closed string").where(F.col("batch") == upto).first() or {})
        open_from = closed["closed"][:10].replace("-", "") if closed and closed["closed"] else ""
        hadoop = spark._jvm.org.apache.hadoop.fs
        fs = hadoop.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

        def parts(pattern):
            return [s.getPath() for s in fs.globStatus(hadoop.Path(f"{self.root}/{pattern}")) or []]

        def value(path, level=0):
            for _ in range(level):
                path = path.getParent()
            return path.getName().split("=", 1)[1]

        gone = [p for p in parts("days/dt=*/batch=*") + parts("tails/batch=*") + parts("scratch/batch=*") if int(value(p)) <= upto]
        gone += [p for p in parts("open/dt=*/batch=*") if int(value(p)) <= upto and value(p, 1) < open_from]
        gone += [p for p in parts("compact/dt=*/asof=*") if int(value(p)) <= upto and (value(p, 1), int(value(p))) not in held]
        gone += [p for name in ("tails_base/upto=*", "compactions/upto=*", "commits/version=*") for p in parts(name)
                 if int(value(p)) < upto]
        for p in gone:
            fs.delete(p, True)
        return len(gone)


def arrivals(lines: DataFrame, **rules) -> DataFrame:
    """(title, ts, views) summed over accepted lines, by title and hour; an
    hour's rejected lines leave a row without a title, so that it is seen.

    Lines are summed by (title, file) first, so that the hour is read off a
    path once a group, not once a line."""
    by_file = X.counted_lines(lines, keep=["file_path"], **rules) \
        .groupBy("title", "file_path").agg(F.sum("views").alias("_v"))
    ts = hour_of(stamp_to_ts("stamp"))
    return X.once(by_file, ["title", "_v"], file_stamp("file_path").alias("stamp")).groupBy("title", ts.alias("ts")).agg(F.sum("_v").cast("bigint").alias("views"))


def run_store(lines: DataFrame, store: StreamStore, checkpoint: str, available_now: bool = True, **rules):
    """Feed the store from a stream of lines (``hourly.line_stream``)."""
    q = lines.select("value", "file_path").writeStream.outputMode("append").option("checkpointLocation", checkpoint) \
        .foreachBatch(lambda batch, batch_id: store(arrivals(batch, **rules), batch_id))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    s = q.start()
    if available_now:
        s.awaitTermination()
    return s
