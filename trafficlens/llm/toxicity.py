"""Toxicity: a convolutional text classifier trained by parameter averaging.

A word's embedding is the sum of the hashed embeddings of the word and of
its first ``PREFIXES`` bytes; convolutions of several widths run over the
whole text, are max-pooled, and a logistic layer reads the pooled values. The decision threshold is calibrated by language, where the
language is told from the text's own function words, and the score is
shifted so that the threshold of every language sits at ``CUT``.

Training uses every labelled row outside the held-out fold, whole texts.
The rows are dealt into shards of about ``SHARD_ROWS``; in each round every
shard trains the network it was sent over its own rows, in numpy, and the
changes are averaged: of an embedding over the shards that moved it, of the
rest by rows. Document frequencies are counted over all these rows, and the
thresholds come from all rows kept back, counted by ``BINS`` bins between
the smallest and the largest logit. What is sent is one network, bounded by ``BUCKETS``. Scoring folds embedding and
filters into one table for each filter column, so that a document costs a
few gathers a word.

Defined cases: null and empty texts are scored as a text of padding; a
very long text is a chunk of its own; repeated rows score alike; without
any labelled rows of a class every score is 0; other columns are ignored.
"""

from __future__ import annotations

import pickle
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text_batches as tb
from .labelled import held_out, training_rows

CUT = 0.7
BUCKETS = 1 << 18
PREFIXES = (4, 6)
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
SHARD_ROWS = 8000
BINS = 1 << 16
# Function words that tell the languages apart; fixed values.
FUNCTION_WORDS = {
    "en": "the of and to in is that for was with".split(),
    "de": "der die und das den von mit sich des ist".split(),
    "fr": "le les des et une est dans pour que qui".split(),
    "es": "el los del las una por con para que se".split(),
}


def _digest_of(words: list[str]) -> np.ndarray:
    data, offs = tb.buffer_of(pa.array(words, pa.large_string()))
    return tb.word_digests(data, offs[:-1], offs[1:])


def tokens(texts: pa.Array):
    """Word digests (lower case), their row numbers, and the buckets of each
    word: of itself and of its prefixes."""
    data, offs = tb.buffer_of(texts)
    data = tb.LOWER[data] if len(data) else data
    starts, ends, rows = tb.word_bounds(data, offs, tb.ALNUM)
    digests = tb.word_digests(data, starts, ends)
    parts = [digests] + [tb.mix(tb.word_digests(data, starts, np.minimum(starts + p, ends)) + np.uint64(p))
                         for p in PREFIXES]
    buckets = np.stack([(d % np.uint64(BUCKETS)).astype(np.int32) for d in parts], axis=1)
    return digests, rows, buckets


def languages(digests: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The number of the language whose function words are most frequent;
    the first of those that tie."""
    votes = [tb.counts_by_row(rows[np.isin(digests, _digest_of(w))], n)
             for w in FUNCTION_WORDS.values()]
    return np.argmax(votes, axis=0)


def _features(rows: DataFrame) -> DataFrame:
    """shard, nth, label, lang, bucket numbers (packed) of the training rows;
    ``nth`` numbers the rows of a shard. Partitions and order stay."""
    def run(batches):
        shard, nth = None, 0
        for batch in batches:
            for part, texts in tb.chunks(batch):
                digests, row, ids = tokens(texts)
                lang = languages(digests, row, len(texts))
                cut = np.concatenate(([0], np.cumsum(tb.counts_by_row(row, len(texts)))))
                number = []
                for s in part.column(0).to_pylist():
                    shard, nth = s, nth + 1 if s == shard else 0
                    number.append(nth)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(number, pa.int32()), part.column(1), pa.array(lang),
                     pa.array([_pack(ids[a:b]) for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                    names=["shard", "nth", "label", "lang", "ids"])

    return rows.select("shard", "label", "text") \
        .mapInArrow(run, "shard int, nth int, label int, lang bigint, ids binary").checkpoint()


def _pack(ids: np.ndarray) -> bytes:
    return len(ids).to_bytes(4, "little") + pa.compress(ids.tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    width = 1 + len(PREFIXES)
    size = int.from_bytes(data[:4], "little") * width * 4
    return np.frombuffer(pa.decompress(data[4:], size, "zstd", asbytes=True), np.int32).reshape(-1, width)


def _rows(batches):
    for batch in batches:
        yield from zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns)))


def _frequencies(features: DataFrame) -> tuple[np.ndarray, set[int]]:
    """Documents that hold each bucket, over all rows, and the labels met."""
    def run(batches):
        df, classes = np.zeros(BUCKETS, np.int64), np.zeros(2, np.int64)
        for _, _, label, _, ids in _rows(batches):
            df[np.unique(_unpack(ids))] += 1
            classes[label] += 1
        some, met = np.flatnonzero(df), np.flatnonzero(classes)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1 - met)), pa.array(np.append(df[some], classes[met]))],
                                         names=["bucket", "n"])

    got = features.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = got.column(0).to_numpy(), got.column(1).to_numpy()  # one row a bucket at most
    df = np.zeros(BUCKETS, np.int64)
    df[bucket[bucket >= 0]] = n[bucket >= 0]
    return df, {int(-1 - b) for b in bucket[bucket < 0]}


class _Network:
    """Embedding, filters and the logistic layer, with Adagrad steps."""

    def __init__(self, n_embeddings: int, seed: int):
        rng = np.random.default_rng(seed)
        k = FILTERS * len(WIDTHS)
        normal = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        self.rng = rng
        self.embed = normal(0.1, n_embeddings, DIM)
        self.filters = [normal(0.3, w, DIM, FILTERS) for w in WIDTHS]
        self.bias, self.out = np.zeros(k, np.float32), normal(0.3, k)
        self.const = np.zeros(1, np.float32)
        self.squares = {name: np.full(a.shape, 1e-3, np.float32) for name, a in self.dense().items()}
        self.squares["embed"] = np.full(self.embed.shape, 1e-3, np.float32)

    def dense(self) -> dict[str, np.ndarray]:
        return {"bias": self.bias, "out": self.out, "const": self.const} | \
            {f"filters{w}": f for w, f in zip(WIDTHS, self.filters)}

    def state(self) -> tuple[np.ndarray, dict, dict]:
        return self.embed.copy(), {k: a.copy() for k, a in self.dense().items()}, {k: a.copy() for k, a in self.squares.items()}

    def load(self, state) -> None:
        embed, dense, squares = state
        self.embed[:] = embed
        for k, a in self.dense().items():
            a[...] = dense[k]
        for k, a in self.squares.items():
            a[...] = squares[k]

    def change(self, state, n: int, shard: int = 0) -> dict:
        """What ``n`` rows changed since ``state``: the embeddings moved (number,
        change, change of the squares, shards) and the rest, times ``n``."""
        embed, dense, squares = state
        moved = np.flatnonzero((self.squares["embed"] != squares["embed"]).any(1))
        rows = np.concatenate([self.embed[moved] - embed[moved], self.squares["embed"][moved] - squares["embed"][moved],
                               np.ones((len(moved), 1), np.float32)], axis=1)
        return {"n": n, "rng": (shard, self.rng), "moved": moved, "rows": rows, "dense": {k: (a - dense[k]) * n for k, a in self.dense().items()},
                "squares": {k: (self.squares[k] - squares[k]) * n for k in dense}}

    def apply(self, change: dict) -> None:
        """The mean of the shards' changes; the first one's random numbers go on."""
        self.rng = change["rng"][1]
        mean = change["rows"] / change["rows"][:, -1:]
        self.embed[change["moved"]] += mean[:, :DIM]
        self.squares["embed"][change["moved"]] += mean[:, DIM:-1]
        for k, a in self.dense().items():
            a += (change["dense"][k] / change["n"]).astype(np.float32)
            self.squares[k] += (change["squares"][k] / change["n"]).astype(np.float32)

    def pooled(self, ids):
        """Word vectors, largest value of every filter and where it stands;
        behind the last word follows padding of zero vectors."""
        n = max(1, len(ids))
        x = np.zeros((n + max(WIDTHS) - 1, DIM), np.float32)
        x[:len(ids)] = self.embed[ids].sum(1)
        best, where = [], []
        for w, f in zip(WIDTHS, self.filters):
            y = sum(x[k:k + n] @ f[k] for k in range(w))
            at = y.argmax(0)
            best.append(y[at, np.arange(FILTERS)])
            where.append(at)
        return x, np.concatenate(best) + self.bias, where

    def logit(self, ids):
        return float(np.maximum(self.pooled(ids)[1], 0) @ self.out + self.const[0])

    def _step(self, name, array, grad, rate, index=slice(None)):
        acc = self.squares[name]
        acc[index] += grad * grad
        array[index] -= rate * grad / np.sqrt(acc[index])

    def learn(self, ids, label, rate, drop):
        """One Adagrad step; only the words that won a filter's pooling move."""
        x, z, where = self.pooled(ids)
        h = np.maximum(z, 0)
        keep = (self.rng.random(len(h)) >= drop) / (1 - drop)
        logit = float((h * keep) @ self.out + self.const[0])
        d = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label
        back = (d * self.out * keep * (z > 0)).astype(np.float32)
        self._step("out", self.out, (d * h * keep).astype(np.float32), rate)
        self._step("const", self.const, np.array([d], np.float32), rate)
        self._step("bias", self.bias, back, rate)
        moved: dict[int, np.ndarray] = {}
        for i, (w, f) in enumerate(zip(WIDTHS, self.filters)):
            g = back[i * FILTERS:(i + 1) * FILTERS]
            used = np.flatnonzero(g)
            if not len(used):
                continue
            for j in used:
                for k in range(w):
                    if (at := int(where[i][j]) + k) < len(ids):
                        moved[at] = moved.get(at, 0) + f[k, :, j] * g[j]
            self._step(f"filters{w}", f, np.stack([x[where[i] + k].T * g for k in range(w)]), rate)
        if moved:
            index = ids[list(moved)]
            grad = np.repeat(np.stack(list(moved.values())), index.shape[1], axis=0)
            index, back_to = np.unique(index.ravel(), return_inverse=True)
            total = np.zeros((len(index), DIM), np.float32)
            np.add.at(total, back_to, grad)
            self._step("embed", self.embed, total, rate, index)


def _merged(a: dict | None, b: dict | None) -> dict | None:
    """The sum of two changes."""
    if a is None or b is None:
        return a or b
    moved, at = np.unique(np.concatenate([a["moved"], b["moved"]]), return_inverse=True)
    rows = np.zeros((len(moved), a["rows"].shape[1]), np.float32)
    rows[at[:len(a["moved"])]] += a["rows"]
    rows[at[len(a["moved"]):]] += b["rows"]
    both = lambda name: {k: v + b[name][k] for k, v in a[name].items()}
    return {"n": a["n"] + b["n"], "rng": min(a["rng"], b["rng"], key=lambda g: g[0]), "moved": moved, "rows": rows, "dense": both("dense"), "squares": both("squares")}


def _round(features: DataFrame, net: _Network, remap: np.ndarray, rate: float, drop: float) -> dict | None:
    """The sum of the changes of all shards, each trained over its own rows
    from ``net`` on with random numbers of its own; every fifth row of a shard
    is left out. One shard alone is trained as without shards."""
    sent = features.sparkSession.sparkContext.broadcast((net, remap))

    def run(batches):
        start, to = sent.value
        state, bits, total = start.state(), start.rng.bit_generator, None
        for shard, rows in groupby(_rows(batches), lambda r: r[0]):
            fit = [(label, ids) for _, nth, label, _, ids in rows if nth % 5]  # a shard's, packed
            start.rng = np.random.Generator(bits.jumped(shard))
            for i in start.rng.permutation(len(fit)):
                start.learn(to[_unpack(fit[i][1])], fit[i][0], rate, drop)
            if fit:
                total = _merged(total, start.change(state, len(fit), shard))
            start.load(state)
            del fit
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], names=["change"])
        del state, total
        tb.release()

    return features.mapInArrow(run, "change binary").rdd.map(lambda r: pickle.loads(r[0])).treeReduce(_merged)


def _kept_logits(features: DataFrame, net: _Network, remap: np.ndarray) -> np.ndarray:
    """(language, label, logit, rows) of the rows that were left out, the
    logits in bins."""
    sent = features.sparkSession.sparkContext.broadcast((net, remap))

    def run(batches):
        model, to = sent.value
        for batch in batches:
            rows = [(lang, label, model.logit(to[_unpack(ids)])) for _, _, label, lang, ids in _rows([batch])]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (pa.int64(), pa.int32(), pa.float64()))], names=["lang", "label", "logit"])

    logits = features.where("nth % 5 = 0").mapInArrow(run, "lang bigint, label int, logit double").checkpoint()
    low, high = logits.agg(F.min("logit"), F.max("logit")).first()
    width = max(high - low, 1e-9) / BINS
    got = logits.groupBy("lang", "label", F.round((F.col("logit") - low) / width).alias("bin")).count() \
        .orderBy("lang", "label", "bin").collect()
    return np.array([(r.lang, r.label, low + r.bin * width, r["count"]) for r in got], float)


def _threshold(kept: np.ndarray, prior: float) -> float:
    """The cut with the fewest errors, toxic rows weighing ``prior`` in all."""
    s, at = np.unique(kept[:, 2], return_inverse=True)
    toxic, clean = (np.bincount(at, kept[:, 3] * (kept[:, 1] == y), len(s)) for y in (1, 0))
    below = np.concatenate(([0], np.cumsum(toxic * (prior / max(1, toxic.sum())))))  # toxic rows under the cut
    above = np.concatenate((np.cumsum((clean * ((1 - prior) / max(1, clean.sum())))[::-1])[::-1], [0]))
    cuts = np.concatenate(([s[0] - 1], (s[1:] + s[:-1]) / 2, [s[-1] + 1]))
    errors = below + above
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float(cuts[best[len(best) // 2]])


def train(rows: DataFrame, prior: float = 0.1, epochs: int = 4, rate: float = 0.05,
          drop: float = 0.2, min_df: int = 5, seed: int = 7) -> dict | None:
    """The model trained on all ``rows`` (``training_rows``) as plain arrays, or
    None without both classes.

    A fifth of every shard is kept from training for the thresholds;
    ``prior`` is the share of toxic documents the cut is chosen for. Buckets
    met in fewer than ``min_df`` documents share one embedding.
    """
    features = _features(rows)
    df, classes = _frequencies(features)
    if len(classes) < 2:
        return None
    common = np.flatnonzero(df >= min_df)
    remap = np.full(BUCKETS, len(common), np.int32)  # bucket -> embedding
    remap[common] = np.arange(len(common))
    net = _Network(len(common) + 1, seed)
    for epoch in range(epochs):
        change = _round(features, net, remap, rate / (1 + epoch), drop)
        if change is not None:
            net.apply(change)
    kept = _kept_logits(features, net, remap)
    pooled = _threshold(kept, prior)
    cuts = np.full(len(FUNCTION_WORDS), pooled)
    for k in range(len(cuts)):
        own = kept[kept[:, 0] == k]
        if min(own[own[:, 1] == y, 3].sum() for y in (0, 1)) >= 30:
            cuts[k] = _threshold(own, prior)
    mean = np.average(kept[:, 2], weights=kept[:, 3])
    spread = max(float(np.sqrt(np.average((kept[:, 2] - mean) ** 2, weights=kept[:, 3]))), 1e-6)
    return {"tables": [[(net.embed @ f[k]).astype(np.float32) for k in range(len(f))] for f in net.filters],
            "bias": net.bias, "out": net.out, "const": float(net.const[0]), "remap": remap,
            "cuts": cuts, "scale": 3.0 / spread}


def _scores(texts: pa.Array, model: dict | None) -> np.ndarray:
    n = len(texts)
    if model is None:
        return np.zeros(n)
    digests, rows, buckets = tokens(texts)
    lang = languages(digests, rows, n)
    n_words = tb.counts_by_row(rows, n)
    some = np.flatnonzero(n_words)
    begin = (np.cumsum(n_words) - n_words)[some]
    _, sample, word = np.unique(digests, return_index=True, return_inverse=True)
    ids = model["remap"][buckets[sample]]
    z = np.zeros((n, len(model["bias"])), np.float32)  # padding alone gives zeros
    if len(word):
        for i, tables in enumerate(model["tables"]):
            own = [t[ids].sum(1) for t in tables]  # of the chunk's distinct words
            y = own[0][word]
            for k in range(1, len(own)):
                same = rows[k:] == rows[:-k]  # the k-th word on is in the same text
                y[:-k][same] += own[k][word[k:][same]]
            z[some, i * FILTERS:(i + 1) * FILTERS] = np.maximum.reduceat(y, begin, axis=0)
    logit = np.maximum(z + model["bias"], 0) @ model["out"] + model["const"]
    shifted = model["scale"] * (logit - model["cuts"][lang]) + np.log(CUT / (1 - CUT))
    return 1 / (1 + np.exp(-np.clip(shifted, -30, 30)))


def toxicity_model(docs: DataFrame, labels: DataFrame, shard_rows: int = SHARD_ROWS) -> dict | None:
    return train(training_rows(docs, labels, "toxic", shard_rows))


def score_toxicity(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few megabytes, fixed by the parameters

    def run(batches):
        for batch in batches:
            for rows, texts in tb.chunks(batch):
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), pa.array(_scores(texts, sent.value))],
                    names=["doc_id", "score"])

    got = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")
    return got.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= CUT).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of ``docs``, with all columns, that score under ``CUT``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for rows, texts in tb.chunks(batch):
                yield rows.filter(pa.array(_scores(texts, sent.value) < CUT))

    return docs.mapInArrow(run, docs.schema)
