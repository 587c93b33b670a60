"""Catalog tables and SQL views.

Tables live in the session catalog (in-memory, or Hive when the cluster has
one). Loading is append or overwrite, of the whole table or of the partitions
that the new rows have. A result that reads the table it replaces is written
as a new version beside it, and the table then points there: readers see the
old version or the new one, and a failed write leaves the old one in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trafficlens.sources.schemas import TABLES


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def save_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
               bucket_by: tuple[int, str] | None = None, path: str | None = None) -> str:
    """create/replace a table (at ``path``, if given), optionally
    bucketed for co-located joins and single-key reads."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    w.saveAsTable(name)
    return name


def load_into(df: DataFrame, name: str, overwrite: bool = False) -> None:
    """LOAD DATA / INSERT [OVERWRITE] TABLE ... SELECT."""
    df.write.insertInto(name, overwrite=overwrite)


def create_tables(spark: SparkSession, database: str, root: str, tables: dict = TABLES,
                  partition_by: dict[str, list[str]] | None = None) -> dict[str, str]:
    """The declared tables, empty, under ``root``; full names by name.
    Columns and separators are those of the declaration; the files are Parquet."""
    create_database(spark, database)
    full = {}
    for name, (columns, _) in tables.items():
        full[name] = f"{database}.{name}"
        parts = (partition_by or {}).get(name)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full[name]} ({columns}) USING parquet "
                  f"{'PARTITIONED BY (' + ', '.join(parts) + ') ' if parts else ''}"
                  f"LOCATION '{root.rstrip('/')}/{name}/version={uuid.uuid4().hex[:12]}'")
    return full


def fitted(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of a table, by name, in its order and with its types."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"no column for {missing}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def insert_overwrite(df: DataFrame, name: str) -> None:
    """INSERT OVERWRITE TABLE .. SELECT: the rows replace all others, also
    partitions without new rows."""
    _overwrite(df, name, "static")


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """INSERT OVERWRITE of the partitions that the rows have; others stay."""
    if not _partitions(df.sparkSession, name):
        raise ValueError(f"{name} has no partitions")
    _overwrite(df, name, "dynamic")


def _overwrite(df: DataFrame, name: str, mode: str) -> None:
    """The writer's option does not reach ``insertInto``: the session's does,
    for the time of the insert."""
    spark, key = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        load_into(fitted(df, spark.table(name).schema), name, overwrite=True)
    finally:
        spark.conf.set(key, old)


def _partitions(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def replace_from(spark: SparkSession, name: str, build: Callable[[DataFrame], DataFrame], root: str) -> str:
    """Replace a table by a result that may read it: ``build`` gets the table.
    The new version is written whole before the table points to it."""
    if _partitions(spark, name):
        raise ValueError("a partitioned table is replaced by partitions")
    table = spark.table(name)
    path = f"{root.rstrip('/')}/{name.rsplit('.', 1)[-1]}/version={uuid.uuid4().hex[:12]}"
    fitted(build(table), table.schema).write.parquet(path)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return path


def sql_view(spark: SparkSession, df: DataFrame, name: str, query: str) -> DataFrame:
    """Register a temp view and run SQL on it."""
    df.createOrReplaceTempView(name)
    return spark.sql(query)
