"""The corpus pipeline: five stages over ``documents``.

A stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's docs. Every stage works on all
that its predecessor kept, judges its own input, and its decisions take
effect; all but the last return the columns of documents.

Defined cases, for every stage: a null text counts as empty and stays null;
nulls in other columns stay; repeated rows are documents of their own, of
which near_duplicates keeps one (of equal ids the smallest digest of the
text, of equal rows any one, no id last); null, empty and blank texts share
the fingerprint zero and are one group; very long texts are judged whole;
columns beyond those of documents pass through all stages but the last,
whatever their names, unless they begin with ``_llm_``; an empty table gives
an empty one, and without labels nothing is toxic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trafficlens.llm.contamination import find_contamination
from trafficlens.llm.disclosure import sanitise
from trafficlens.llm.pieces import encode, read_model
from trafficlens.llm.queries import MODEL
from trafficlens.llm.simhash import keep_one
from trafficlens.llm.toxicity import drop_toxic, toxicity_model
from trafficlens.session import fresh_path
from trafficlens.sources.bindings import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return drop_toxic(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return keep_one(docs, shingle=3, max_distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return find_contamination(docs, table(spark, sf_dir, "benchmark"), window=13, min_share=0.05,
                              keep_clean=True)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are masked."""
    return sanitise(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as pieces: doc_id, ids, n_tokens, parity, round_trip."""
    return encode(docs, read_model(MODEL))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("pii", pii), ("sentencepiece", sentencepiece)]

# Trained classifier, XXH64 and the tokenizer have no DuckDB SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
