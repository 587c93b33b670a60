"""What keeps the cost of a line bounded: a line is split and matched once,
and derived lines are built by compiled expressions."""

import pytest

from trafficlens.functions import titles as X
from trafficlens.plans import batch_trends as BT
from trafficlens.plans import registered as R
from trafficlens.sources import bindings as B

LINES = ["en Caf%C3%A9_x 3 4", "en Big+one 3 4", "en User:x 3 4", "de Q 1 2", "en A#b 2x 4", "en %23 1 2", "en A\nb 1 2",
         "en Two words 3 4", "en the 1 2", "", None, "en Tok 3 4", "en Tok 3 4"]


def lines(spark):
    df = spark.createDataFrame([(i, v, "20150301000000") for i, v in enumerate(LINES)], "doc_id int, value string, stamp string")
    return df.selectExpr("doc_id", "concat(value, '') as value", "stamp")  # a derived line, as those of the tables are


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("query", [
    lambda d: X.accepted_lines(d, keep=["doc_id"]),
    lambda d: X.accepted_lines(d, keep=["doc_id"], keyword="a", require_count=False),
    lambda d: BT.rejects(d, keyword="a"),
    lambda d: X.shaped_pages(d, keep=["doc_id"]).where(X.is_valid_title("page"))])
def test_a_line_is_split_once(spark, query):
    plan = optimized(query(lines(spark)))
    assert plan.count("split(") == 1 and plan.count("regexp_replace(") <= 1


def test_filters_keep_their_rows(spark):
    d = lines(spark)
    parsed = X.parse_lines(d, keep=["doc_id"]).collect()
    assert [r.status for r in sorted(parsed, key=lambda r: r.doc_id)] == \
        ["ok", "ok", "title", "shape", "count", "empty", "shape", "title", "title", "shape", "empty", "ok", "ok"]
    ok = sorted((r.doc_id, r.title, r.views) for r in parsed if r.status == "ok")
    assert sorted(tuple(r) for r in X.accepted_lines(d, keep=["doc_id"]).collect()) == ok
    lenient = sorted(r.doc_id for r in parsed if r.status in ("ok", "count"))
    assert sorted(r.doc_id for r in X.accepted_lines(d, keep=["doc_id"], require_count=False).collect()) == lenient
    assert sorted(r.doc_id for r in BT.rejects(d.withColumn("stamp", d.stamp)).withColumn("doc_id", X.F.lit(0)).collect()) == \
        [0] * sum(r.status != "ok" for r in parsed)
    pages = sorted(tuple(r) for r in X.shaped_pages(d, keep=["doc_id"]).collect())
    old = d.where(X.line_shape("value")).select("doc_id", X.line_group(d.value, 1))
    assert pages == sorted(tuple(r) for r in old.collect())


def test_tricky_lines_are_compiled(spark):
    plan = optimized(B.tricky_lines(spark, "/root/testdata/sf0.001"))
    assert "transform(" not in plan and "lambda" not in plan


def test_tricky_lines_spread(spark):
    """One small file is one scan partition; its lines are dealt to all cores."""
    got = R.v6_pages(spark, "/root/testdata/sf0.001")
    assert got.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
