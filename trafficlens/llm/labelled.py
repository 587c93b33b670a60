"""Labelled rows for training: folds, all of them by shard, and the bounded sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.session import shared_root


def held_out(doc_id="doc_id"):
    """True where crc32 of the id as text leaves remainder 1 by 3; a null id
    is in no fold and never labelled."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _known(labels: DataFrame, target: str) -> DataFrame:
    return labels.filter(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()) \
        .groupBy("doc_id").agg(F.max(target).cast("int").alias("label"))


def training_rows(docs: DataFrame, labels: DataFrame, target: str, shard_rows: int,
                  broadcast_rows: int = 1 << 20, shards_per_task: int = 4) -> DataFrame:
    """shard, doc_id, label, text of every labelled document outside the
    held-out fold, sorted, with each shard whole in one partition.

    Shards are dealt by a hash of the id and hold ``shard_rows`` rows or so:
    their number grows with the rows. ``shards_per_task`` of them or so share a
    partition, so that what each leaves is summed before it is shuffled. Equal ids are settled as in
    ``training_sample``. The labels are sent everywhere while they are few.
    """
    shared_root(docs.sparkSession)
    known = _known(labels, target).checkpoint()
    n = known.count()
    shards = max(1, -(-n // shard_rows))
    return docs.where(~held_out()).select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .join(F.broadcast(known) if n <= broadcast_rows else known, "doc_id") \
        .withColumn("shard", F.expr(f"cast(pmod(xxhash64(doc_id), {shards}) as int)")) \
        .repartition(-(-shards // shards_per_task), "shard") \
        .groupBy("shard", "doc_id", "label").agg(F.min("text").alias("text")) \
        .sortWithinPartitions("shard", "doc_id")


def training_sample(docs: DataFrame, labels: DataFrame, target: str, per_class: int) -> DataFrame:
    """doc_id, label, text of at most ``per_class`` documents of each class,
    drawn by a hash of the id from all rows outside the held-out fold.

    The bound keeps the drawn ids small enough to send everywhere, so the
    texts are picked out where they are. A doc_id with several labels
    counts as its largest; one that several documents share gives the
    smallest text.
    """
    known = _known(labels, target)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    drawn = known.filter("label = 1").orderBy(*order).limit(per_class) \
        .union(known.filter("label = 0").orderBy(*order).limit(per_class))
    shared_root(docs.sparkSession)
    drawn = drawn.checkpoint()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .join(F.broadcast(drawn), "doc_id") \
        .groupBy("doc_id", "label").agg(F.min("text").alias("text"))
