"""Search-document sink and source.

``write_search_docs`` replaces its target; ``publish_search_docs`` upserts by
the deterministic ``_id`` into a store laid out by month (or another date
pattern) and rewrites only the parts that the new documents touch. A connector format (any
``DataFrameWriter.format``) can be passed in instead of JSON.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlens.operators.documents import DOC_SCHEMA
from trafficlens.session import shared_root


def write_search_docs(docs: DataFrame, path: str, fmt: str = "json",
                      max_records_per_file: int = 0, options: dict | None = None) -> str:
    w = docs.write.mode("overwrite").format(fmt)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
    return path


def read_search_docs(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(DOC_SCHEMA).format(fmt).load(path)


def publish_search_docs(docs: DataFrame, path: str, layout: str = "yyyyMM") -> str:
    """Upsert by ``_id``: a new document replaces the stored one of its
    id, all other documents stay.

    The touched parts (``page_date`` written as ``layout``) are merged into
    a checkpoint before they are overwritten, so the store is never read
    while it is written."""
    spark = docs.sparkSession
    shared_root(spark)
    docs = docs.select(*DOC_SCHEMA.fieldNames(), F.date_format("page_date", layout).alias("part")).checkpoint()
    try:
        stored = spark.read.schema(docs.schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        merged = docs
    else:
        low, high = docs.agg(F.min("part"), F.max("part")).first()
        kept = stored.filter(F.col("part").between(low, high)) \
            .join(docs.select("part").distinct(), "part", "left_semi").join(docs, "_id", "left_anti")
        merged = kept.select(docs.columns).union(docs).checkpoint()
    merged.hint("rebalance", "part").write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("part").json(path)
    return path
