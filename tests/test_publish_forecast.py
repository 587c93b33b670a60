"""The document connector, metrics observed on a write, the seasonal
forecast, files chosen by a regex on their names."""

import json
import os

import pytest
from pyspark.sql import functions as F

from trafficlens.functions import titles as X
from trafficlens.operators import counts as C
from trafficlens.operators import forecast as M
from trafficlens.operators.documents import DOC_SCHEMA
from trafficlens.session import fresh_path
from trafficlens.sources import doc_store as DS
from trafficlens.sources import pagecounts as PC
from trafficlens.streaming import hourly as HS


def docs(spark, rows):
    return spark.createDataFrame([(i, t, v) for i, t, v in rows], "_id string, title string, page_views bigint") \
        .selectExpr("_id", "title", "date'2015-03-01' as page_date", "page_views", "cast(0.1 as float) daily_trend",
                    "cast(null as float) weekly_trend", "0f as monthly_trend")


def stored(spark, root):
    return sorted((r._id, r.title, r.page_views) for r in DS.read_docs(spark, root).collect())


def test_connector_upserts_by_id(spark):
    root = fresh_path(spark, "t_docs")
    assert stored(spark, root) == []
    DS.publish(docs(spark, [(str(i), "é \"q\"\n", i) for i in range(25)]).repartition(3), root, bulk=4)
    DS.publish(docs(spark, [("3", "new", 300), ("99", "x", 1)]), root)
    want = sorted([(str(i), "é \"q\"\n", i) for i in range(25) if i != 3] + [("3", "new", 300), ("99", "x", 1)])
    assert stored(spark, root) == want
    assert DS.read_docs(spark, root).schema == DOC_SCHEMA
    assert sum(p["rows"] for m in DS.manifests(root) for p in m["parts"]) == 27
    DS.publish(docs(spark, []), root)
    assert stored(spark, root) == want
    with pytest.raises(Exception):
        docs(spark, [("1", "t", 1)]).write.format(DS.NAME).mode("overwrite").save(root)


def test_a_failed_write_and_parts_of_lost_attempts_do_not_exist(spark):
    root = fresh_path(spark, "t_docs")
    DS.publish(docs(spark, [("1", "a", 1)]), root)
    bad = docs(spark, [("2", "b", 2), ("3", "c", 3)]).repartition(2) \
        .withColumn("title", F.when(F.col("_id") == "3", F.raise_error(F.lit("no"))).otherwise(F.col("title")))
    with pytest.raises(Exception):
        DS.publish(bad, root)
    assert stored(spark, root) == [("1", "a", 1)]
    part = DS.manifests(root)[0]["parts"][0]["path"]
    with open(f"{root}/{os.path.dirname(part)}/part-00000-999.json", "w") as f:  # an attempt that lost
        f.write(json.dumps({"_id": "9", "title": "ghost"}))
    assert stored(spark, root) == [("1", "a", 1)]
    writer = DS.BatchWriter(root, 10)
    one, two = DS.Part(part, 1, 1), None
    writer.commit([one, two])  # a task without a result
    assert stored(spark, root) == [("1", "a", 1)]


def test_stream_commits_a_batch_once(spark):
    root, src, chk = fresh_path(spark, "t_docs"), fresh_path(spark, "t_src"), fresh_path(spark, "t_chk")
    DS.register(spark)

    def run(rows):
        docs(spark, rows).write.mode("append").parquet(src)
        stream = spark.readStream.schema(DOC_SCHEMA).parquet(src)
        stream.writeStream.format(DS.NAME).option("path", root).option("query", "q").option("checkpointLocation", chk) \
            .trigger(availableNow=True).start().awaitTermination()

    run([("1", "a", 1), ("2", "b", 2)])
    run([("2", "b", 20)])
    assert stored(spark, root) == [("1", "a", 1), ("2", "b", 20)]
    last = DS.manifests(root)[-1]
    DS.StreamWriter(root, 10, "q").commit([DS.Part(p["path"], p["rows"], 1) for p in last["parts"]], 1)  # again
    assert stored(spark, root) == [("1", "a", 1), ("2", "b", 20)]
    assert len([f for f in os.listdir(f"{root}/manifests") if f.startswith("stream-q")]) == len(DS.manifests(root))


def test_observed_metrics_of_a_write_and_of_a_stream(spark):
    lines = spark.createDataFrame([("en A 1 1", "20150301000000"), ("en b 2 1", "20150301000000"), ("en C 40 1", "20150301010000"),
                                   ("junk", "20150301010000")], "value string, stamp string")
    parsed, seen = C.observed(X.parse_lines(lines, keep=["stamp"]), "t")
    parsed.where("status = 'ok'").write.mode("overwrite").parquet(fresh_path(spark, "t_seen"))
    assert seen.get == {"lines": 4, "accepted": 2, "views": 41}
    root = fresh_path(spark, "t_files")
    PC.write_pagecount_files(lines, root)
    stream = X.parse_lines(HS.line_stream(spark, root), keep=["ts"])
    ok = F.col("status") == "ok"
    q = stream.observe("load", F.count(F.lit(1)).alias("lines"), F.count_if(ok).alias("accepted")) \
        .writeStream.format("noop").option("checkpointLocation", fresh_path(spark, "t_chk")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = [json.loads(p.json)["observedMetrics"]["load"] for p in q.recentProgress if p.numInputRows]
    assert sum(m["lines"] for m in got) == 4 and sum(m["accepted"] for m in got) == 2


def plain_seasonal(y, h, alpha=0.3, gamma=0.2, season=7):
    level, part, off = y[0], [0.0] * season, []
    for i, v in enumerate(y):
        e = v - (level + part[i % season])
        if i >= season:
            off.append(abs(e))
        level += alpha * e
        part[i % season] += gamma * (1 - alpha) * e
    return level, sum(off) / len(off) if off else None, [level + part[(len(y) - 1 + k) % season] for k in h]


def test_seasonal_forecast(spark):
    series = {"A": [10, 20, 30, 40, 50, 60, 70] * 6, "B": [5], "C": [3, 1, 4, 1, 5, 9, 2, 6], "D": list(range(20))}
    rows = [(t, f"{20150000 + i}", v) for t, ys in series.items() for i, v in enumerate(ys)]
    got = {r.title: r for r in M.seasonal_forecast(spark.createDataFrame(rows, "title string, dt string, views bigint"), (1, 7, 10)).collect()}
    for t, ys in series.items():
        level, error, ahead = plain_seasonal([float(v) for v in ys], (1, 7, 10))
        r = got[t]
        assert r.n == len(ys) and abs(r.level - level) < 1e-9
        assert (r.error is None) == (error is None) and (error is None or abs(r.error - error) < 1e-9)
        assert all(abs(a - b) < 1e-9 for a, b in zip((r.forecast_1, r.forecast_7, r.forecast_10), ahead))
    assert got["A"].error < 20  # the weekly pattern is learned


def test_files_by_a_regex_on_their_names(spark):
    root = fresh_path(spark, "t_files")
    lines = [(f"en A{h} 1 1", f"2015030{d}{h:02d}0000") for d in (1, 2) for h in (0, 7, 13)]
    PC.write_pagecount_files(spark.createDataFrame(lines, "value string, stamp string"), root)
    got = PC.read_pagecounts(spark, root, name_regex=r"pagecounts-2015030[12]-0[0-9]0000")
    assert sorted((r.value, r.stamp) for r in got.collect()) == sorted(x for x in lines if x[1][8] == "0")
