"""SimHash near-duplicates by multi-index hashing.

Fingerprints: 64 bits, a bit is 1 if more than half of the shingles'
XXH64 digests have it. Distinct fingerprints are indexed under the points
of small Hamming balls: within each segment of the fingerprint every value
at most ``max_distance / 2`` bits away is enumerated while the other
segments are held, and combined over segments for larger distances. Two
fingerprints are within ``max_distance`` bits if and only if they meet in
a point, and a table entry (a point) holds at most one Hamming ball of
fingerprints however large a group of near copies is. Matches fetched from
a point are verified by their complete distance to the point's smallest
fingerprint, which links the members in a star; the links' connected
components are the groups.

Defined cases: null, empty and blank texts have no shingle and the
fingerprint zero, which links like any other; fewer words than the shingle
length make one shingle; repeated rows each get a row; a null doc_id never
names a group unless the group has no other; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.session import shared_root

from . import text_batches as tb

BITS = 64
BLOCK = 1 << 15


def _fingerprints(texts: pa.Array, shingle: int, seed: int) -> list[int]:
    """Fingerprints as signed 64-bit integers."""
    data, offs = tb.buffer_of(texts)
    data = tb.LOWER[data] if len(data) else data
    starts, ends, rows = tb.word_bounds(data, offs, tb.NOT_SPACE)
    n = len(texts)
    out = np.zeros(n, np.int64)
    if not len(starts):
        return out
    # the words with one space between them, as one buffer
    lens = ends - starts
    first = np.concatenate(([0], np.cumsum(lens + 1)))
    flat = np.full(int(first[-1]), 0x20, np.uint8)
    src = np.repeat(starts - np.concatenate(([0], np.cumsum(lens)[:-1])), lens)
    at = np.arange(len(src))
    flat[at + np.repeat(np.arange(len(lens)), lens)] = data[at + src]
    n_words = tb.counts_by_row(rows, n)
    head = np.concatenate(([0], np.cumsum(n_words)))
    n_shingles = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    row_of = np.repeat(np.arange(n), n_shingles)
    k = np.arange(len(row_of)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles)
    w0 = head[row_of] + k
    w1 = np.minimum(w0 + shingle, head[row_of + 1])
    view, digest = memoryview(flat), xxhash.xxh64_intdigest
    begin, end = first[w0], first[w1] - 1
    ones = np.zeros((n, BITS), np.int64)
    for lo in range(0, len(begin), BLOCK):  # bits are counted a block of shingles at a time
        part = slice(lo, lo + BLOCK)
        h = np.fromiter((digest(view[a:b], seed) for a, b in zip(begin[part].tolist(), end[part].tolist())),
                        ">u8", len(begin[part]))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1)
        row = row_of[part]
        starts_at = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        ones[row[starts_at]] += np.add.reduceat(bits, starts_at, axis=0, dtype=np.uint32)
    some = np.flatnonzero(n_shingles)
    chosen = np.packbits(2 * ones[some] > n_shingles[some][:, None], axis=1)
    out[some] = chosen.view(">u8").ravel().astype(np.uint64).view(np.int64)
    return out


def _prints_with(docs: DataFrame, keep: list[str], shingle: int, seed: int) -> DataFrame:
    """The bigint columns ``keep`` and ``fp`` (the 64 bits as a bigint)."""
    def run(batches):
        for batch in batches:
            for rows, texts in tb.chunks(batch, limit=tb.CHUNK_BYTES // 2):
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(k).cast(pa.int64()) for k in range(len(keep))],
                     pa.array(_fingerprints(texts, shingle, seed))], names=[*keep, "fp"])

    return docs.select(*keep, "text").mapInArrow(run, ", ".join(f"{c} bigint" for c in [*keep, "fp"]))


def fingerprints(docs: DataFrame, shingle: int, seed: int = 42) -> DataFrame:
    """doc_id and fp, one row per input row."""
    return _prints_with(docs, ["doc_id"], shingle, seed)


def ball_masks(max_distance: int, segments: int = 4) -> list[int]:
    """The XOR masks of a ball of radius max_distance / 2, by segment."""
    radius = max_distance // 2
    width = BITS // segments
    masks = [0]
    for size in range(1, radius + 1):
        for bits in combinations([s * width + b for s in range(segments) for b in range(width)], size):
            m = sum(1 << b for b in bits)
            masks.append(m - (1 << 64) if m >> 63 else m)
    return masks


def links(distinct: DataFrame, max_distance: int) -> DataFrame:
    """Links (a, b), a < b, between distinct fingerprints; their connected
    components are those of all pairs within ``max_distance`` bits."""
    if max_distance % 2 or not 0 <= max_distance <= 4:
        raise ValueError("max_distance must be 0, 2 or 4")
    probes = F.array(*[F.lit(m).cast("bigint") for m in ball_masks(max_distance)])
    table = distinct.select("fp", F.explode(probes).alias("mask")) \
        .select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("point"))
    met = table.groupBy("point").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("members")) \
        .filter(F.size("members") > 1)
    return met.select("a", F.explode("members").alias("b")) \
        .filter((F.col("a") != F.col("b"))
                & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of each connected component, by the
    large-star / small-star rounds; every round is cut with checkpoint()."""
    spark = edges.sparkSession
    shared_root(spark)

    def star(e, large):
        both = e.select(F.col("u"), F.col("v")).union(e.select(F.col("v"), F.col("u"))) if large \
            else e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        seen = both.join(low, "u")
        if large:
            new = seen.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            new = seen.select(F.col("v").alias("u"), F.col("m").alias("v")) \
                .union(low.select(F.col("u"), F.col("m").alias("v")))
        return new.filter(F.col("u") != F.col("v")).distinct()

    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).distinct().checkpoint()
    mark = None
    while True:
        e = star(star(e, True), False).checkpoint()
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def groups_of(prints: DataFrame, max_distance: int) -> DataFrame:
    """fp, root: the smallest fingerprint that each distinct one reaches."""
    distinct = prints.select("fp").distinct()
    roots = components(links(distinct, max_distance)).checkpoint()
    return distinct.join(roots, F.col("fp") == F.col("node"), "left") \
        .select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2,
                    seed: int = 42) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable by links)."""
    shared_root(docs.sparkSession)
    prints = fingerprints(docs, shingle, seed).checkpoint()
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))  # copies meet here, pre-aggregated
    named = first.join(groups_of(prints, max_distance), "fp")
    group = named.groupBy("root").agg(F.min("first").alias("component_id")).checkpoint()
    of_print = named.join(group, "root").select("fp", "component_id")
    return prints.join(of_print, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_distance: int = 2, seed: int = 42,
             broadcast_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs``, all columns: one of each group.

    The smallest doc_id stays (no doc_id comes last), then the smallest
    digest of the text; of rows equal in both, any one.
    """
    shared_root(docs.sparkSession)
    key = {"_llm_id": F.col("doc_id"), "_llm_rank": F.xxhash64("text")}
    if {*key, "_llm_row"} & set(docs.columns):
        raise ValueError("documents has a column of the operator's own name")
    keyed = docs.withColumns(key)
    prints = _prints_with(keyed, ["_llm_id", "_llm_rank"], shingle, seed).checkpoint()
    rows = prints.groupBy("_llm_id", "_llm_rank", "fp").agg(F.count("*").alias("n"))
    rows = rows.join(groups_of(prints, max_distance), "fp").select(
        "root", "n", F.struct(F.col("_llm_id").isNull().alias("none"), "_llm_id", "_llm_rank").alias("k"))
    # written first, so that the join below may split the rows of a large group
    best = rows.groupBy("root").agg(F.min("k").alias("best")).checkpoint()
    # what must go: losers, and winners written more than once, which come back singly
    gone = rows.join(best, "root").withColumn("wins", F.col("k") == F.col("best")) \
        .filter(~F.col("wins") | (F.col("n") > 1)).select("k.*", "wins").drop("none").checkpoint()
    small = 64 * gone.count() <= broadcast_bytes  # measured, else Spark shuffles both sides
    side = F.broadcast if small else (lambda df: df)
    same = lambda g: keyed["_llm_id"].eqNullSafe(g["_llm_id"]) & (keyed["_llm_rank"] == g["_llm_rank"])
    gone_side, repeated = side(gone), side(gone.filter("wins"))
    single = keyed.join(gone_side, same(gone_side), "left_anti").select(docs.columns)
    again = keyed.join(repeated, same(repeated), "left_semi") \
        .groupBy("_llm_id", "_llm_rank").agg(F.first(F.struct(*docs.columns)).alias("_llm_row"))
    return single.union(again.select("_llm_row.*"))
