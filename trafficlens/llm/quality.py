"""Quality classifier: nearest-neighbour voting among latent-semantic vectors.

Terms are words, runs of punctuation, and marks for capitals, repeated
words and line shapes, hashed into buckets. Document frequencies are
counted over all documents; a truncated SVD of the weighted term matrix of
a bounded labelled sample (``per_class`` documents a class, outside the
held-out fold) gives the latent space. The sample's vectors are broadcast;
every document's vector is compared with all of them in blocks of exact
cosine products, and its ``neighbours`` nearest vote by similarity.

Defined cases: null and empty texts have the zero vector, and so have
texts of unknown terms only: every similarity is 0 and the score is the
sample's share of label 1; a very long text is a chunk of its own;
repeated rows score alike; ties in similarity go to the smaller sample
doc_id; without labels every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text_batches as tb
from .labelled import held_out, training_sample

BUCKETS = 1 << 13
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
PUNCT = tb.NOT_SPACE & ~tb.ALNUM
NOT_NEWLINE = np.ones(256, bool)
NOT_NEWLINE[0x0A] = False


def term_counts(texts: pa.Array):
    """(rows, buckets, counts) of the distinct terms of each row."""
    data, offs = tb.buffer_of(texts)
    low = tb.LOWER[data] if len(data) else data
    starts, ends, rows = tb.word_bounds(data, offs, tb.ALNUM)
    words = tb.word_digests(low, starts, ends)
    p0, p1, prow = tb.word_bounds(data, offs, PUNCT)
    again = np.zeros(len(words), bool)  # a word said twice counts as a repeat, not as the word
    again[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    marks = [(rows[~again], words[~again]), (prow, tb.word_digests(data, p0, p1) + np.uint64(1))]
    if len(data):
        upper = np.concatenate(([0], np.cumsum(UPPER[data])))
        shouted = (upper[ends] - upper[starts] >= 2) & (upper[ends] - upper[starts] == ends - starts)
        l0, l1, lrow = tb.word_bounds(data, offs, NOT_NEWLINE)
        n_words = np.searchsorted(starts, l1) - np.searchsorted(starts, l0)
        size = np.minimum(n_words.astype(np.float64), 1 << 12)
        for number, (r, kind) in enumerate(((rows[shouted], 0), (rows[again], 0),
                                            (lrow, np.log2(size + 1).astype(np.uint64)))):
            marks.append((r, tb.mix(np.zeros(len(r), np.uint64) + kind + np.uint64(64 * (number + 1)))))
    row = np.concatenate([m[0] for m in marks])
    bucket = (np.concatenate([m[1] for m in marks]) % np.uint64(BUCKETS)).astype(np.int64)
    key, count = np.unique(row * BUCKETS + bucket, return_counts=True)
    return key // BUCKETS, key % BUCKETS, count


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, over all documents, and their number."""
    def run(batches):
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for _, texts in tb.chunks(batch):
                _, bucket, _ = term_counts(texts)
                seen += np.bincount(bucket, minlength=BUCKETS)
                n += len(texts)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(seen[some], n))],
                                         names=["bucket", "n"])

    got = docs.select("text").mapInArrow(run, "bucket bigint, n bigint") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # one row a bucket at most
    df, total = np.zeros(BUCKETS, np.int64), 0
    for r in got:
        if r.bucket < 0:
            total = r.n
        else:
            df[r.bucket] = r.n
    return df, total


def _weighted(texts: pa.Array, idf: np.ndarray):
    row, bucket, count = term_counts(texts)
    weight = np.sqrt(count) * idf[bucket]
    norm = np.sqrt(np.bincount(row, weights=weight * weight, minlength=len(texts)))
    return row, bucket, weight / np.maximum(norm, 1e-12)[row]


def _vectors(texts: pa.Array, model: dict) -> np.ndarray:
    """Unit latent vectors; zero where nothing is known."""
    row, bucket, weight = _weighted(texts, model["idf"])
    n = len(texts)
    out = np.zeros((n, model["basis"].shape[1]), np.float32)
    if len(row):
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        part = model["basis"][bucket] * weight[:, None].astype(np.float32)
        out[row[first]] = np.add.reduceat(part, first, axis=0)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.where(norm > 1e-9, out / np.maximum(norm, 1e-9), 0).astype(np.float32)


def _basis(matrix: np.ndarray, rank: int, seed: int, rounds: int = 3) -> np.ndarray:
    """Right singular vectors by randomised subspace iteration."""
    rank = max(1, min(rank, *matrix.shape))
    q = np.random.default_rng(seed).normal(size=(matrix.shape[1], rank)).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(matrix.T @ (matrix @ q))
    _, _, v = np.linalg.svd(matrix @ q, full_matrices=False)
    return (q @ v.T).astype(np.float32)


def quality_model(docs: DataFrame, labels: DataFrame, target: str = "quality", per_class: int = 2000,
                  rank: int = 64, seed: int = 11) -> dict | None:
    df, total = document_frequencies(docs)
    idf = np.where(df > 0, np.log((1 + total) / (1 + df)) + 0.1, 0.0)
    sample = training_sample(docs, labels, target, per_class)
    rows = sample.orderBy("doc_id").collect()
    if not rows:
        return None
    label = np.array([r.label for r in rows], np.float32)
    matrix = np.zeros((len(rows), BUCKETS), np.float32)
    for at in range(0, len(rows), 64):
        row, bucket, weight = _weighted(pa.array([r.text for r in rows[at:at + 64]], pa.large_string()), idf)
        matrix[at + row, bucket] = weight
    model = {"idf": idf, "basis": _basis(matrix, rank, seed)}
    vec = matrix @ model["basis"]
    norm = np.linalg.norm(vec, axis=1, keepdims=True)
    return model | {"vectors": (vec / np.maximum(norm, 1e-9)).astype(np.float32), "labels": label}


def _votes(vec: np.ndarray, model: dict, neighbours: int, block: int = 512) -> np.ndarray:
    k = min(neighbours, len(model["labels"]))
    out = np.empty(len(vec))
    prior = float(model["labels"].mean())
    for at in range(0, len(vec), block):
        sim = vec[at:at + block] @ model["vectors"].T
        near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        top = np.take_along_axis(sim, near, axis=1)
        # argpartition picks any of those that tie with the k-th: settle them by position
        edge = top.min(axis=1, keepdims=True)
        tied = np.flatnonzero(((sim == edge).sum(1) > (top == edge).sum(1)))
        for r in tied:
            near[r] = np.argsort(-sim[r], kind="stable")[:k]
            top[r] = sim[r, near[r]]
        weight = np.maximum(top, 0) ** 4
        total = weight.sum(1)
        vote = (weight * model["labels"][near]).sum(1) / np.maximum(total, 1e-12)
        out[at:at + block] = np.where(total > 1e-12, vote, prior)
    return np.clip(out, 0, 1)


def score_quality(docs: DataFrame, model: dict | None, neighbours: int = 15,
                  cut: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    # bounded by the parameters: basis, idf and 2 * per_class vectors
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for rows, texts in tb.chunks(batch, limit=tb.CHUNK_BYTES // 2):
                m = sent.value
                score = np.full(len(texts), 0.5) if m is None else \
                    _votes(_vectors(texts, m), m, neighbours)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), pa.array(score)], names=["doc_id", "score"])

    got = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")
    return got.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= cut).cast("int").alias("predicted"))
