"""Benchmark decontamination with suffix arrays of the documents.

The documents are cut into shards (a few megabytes of a partition each);
every shard gets the suffix array of its words. All windows of the test
items are binary-searched in it; the range of equal suffixes gives every
verbatim location, and matches are extended to their full length. A
document word inside such an occurrence is hit; documents whose hit share
reaches ``min_share`` are contaminated.

Test items reach the shards as broadcast blocks of at most
``block_words`` words each; with more than one block the passes are
chained and carry the hit words and items of a document along, so neither
the benchmark's size nor repeated rows change the result.

Defined cases: null and wordless texts have no words and are clean; an
item without words matches nothing; an item of fewer than ``window``
words is one window; items are told apart by item_id, so rows that share
one are one item; a null item_id counts but cannot be listed.
"""

from __future__ import annotations

import hashlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlens.session import shared_root

from . import suffixes
from . import text_batches as tb

SCHEMA = ("doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
          "contaminated boolean, longest_match bigint, spans string, items array<string>")
STATE = "_llm_contamination_state"  # carried between blocks
_STATE_ARROW = pa.struct([("hits", pa.binary()), ("items", pa.list_(pa.string())),
                          ("longest", pa.int64())])
WORD = tb.ALNUM.copy()  # after lower-casing, capitals are gone


def _words(texts: pa.Array):
    data, offs = tb.buffer_of(texts)
    data = tb.LOWER[data] if len(data) else data
    starts, ends, rows = tb.word_bounds(data, offs, WORD)
    return tb.word_digests(data, starts, ends), starts, ends, rows


def test_windows(items: list[tuple[str | None, str | None]], window: int) -> SimpleNamespace:
    """The distinct windows of a block of test items: ``at`` and ``size`` in
    ``words``, and the numbers of the items that have them in ``owners``."""
    texts = pa.array([t or "" for _, t in items], pa.large_string())
    words, _, _, rows = _words(texts)
    n = tb.counts_by_row(rows, len(items))
    first = np.cumsum(n) - n
    seen: dict[bytes, int] = {}
    at, sizes, owners = [], [], []
    for r in range(len(items)):
        size = min(n[r], window)
        for a in range(first[r], first[r] + n[r] - size + 1) if size else ():
            k = seen.setdefault(words[a:a + size].tobytes(), len(seen))
            if k == len(owners):
                owners.append([])
                at.append(a)
                sizes.append(size)
            owners[k].append(r)
    return SimpleNamespace(words=words, rows=rows, ids=[i for i, _ in items], owners=owners,
                           at=np.array(at, np.int64), size=np.array(sizes, np.int64), window=window)


def _search(words: np.ndarray, sa: np.ndarray, test: SimpleNamespace):
    """For each window the range [lo, hi) of ``sa`` that starts with it."""
    out = []
    for above in (False, True):  # lower bound, upper bound
        lo, hi = np.zeros(len(test.at), np.int64), np.full(len(test.at), len(sa), np.int64)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            order = _compare(words, sa[mid], test, open_)
            right = order <= 0 if above else order < 0
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]
        out.append(lo)
    return out


def _compare(words, suffix, test, which):
    """-1, 0, 1: the suffix against the window, word by word."""
    result = np.zeros(len(which), np.int64)
    rest = np.arange(len(which))
    k = 0
    while len(rest):
        rest = rest[k < test.size[which[rest]]]
        w = test.words[test.at[which[rest]] + k]
        at = suffix[rest] + k
        ended = at >= len(words)
        mine = words[np.where(ended, 0, at)]
        less, more = ended | (mine < w), ~ended & (mine > w)
        result[rest[less]], result[rest[more]] = -1, 1
        rest = rest[~less & ~more]
        k += 1
    return result


def _shard_hits(texts: pa.Array, test: SimpleNamespace):
    """Words of each row, hit mask over all words, items and longest match of
    each row, and where the words are."""
    words, starts, ends, rows = _words(texts)
    n = len(texts)
    n_words = tb.counts_by_row(rows, n)
    hit = np.zeros(len(words), bool)
    owners: list[set] = [set() for _ in range(n)]
    longest = np.zeros(n, np.int64)
    if len(words) and len(test.at):
        # word order of the shard's own letters must be the digests' order
        order = np.argsort(words, kind="stable")
        rank = np.empty(len(words), np.int64)
        s = words[order]
        rank[order] = np.cumsum(np.concatenate(([0], (s[1:] != s[:-1]).astype(np.int64))))
        sa = suffix_array(rank, test.window)
        lo, hi = _search(words, sa, test)
        count = hi - lo
        some = np.flatnonzero(count)
        if len(some):
            which = np.repeat(some, count[some])
            first = np.repeat(np.cumsum(count[some]) - count[some], count[some])
            at = sa[np.arange(len(which)) - first + np.repeat(lo[some], count[some])]
            inside = rows[at] == rows[at + test.size[which] - 1]  # within one document
            which, at = which[inside], at[inside]
            size = test.size[which]
            hit = tb.covered(at, size, len(words))
            length = _extend(words, rows, at, size, test, which)
            np.maximum.at(longest, rows[at], length)
            for r, k in set(zip(rows[at].tolist(), which.tolist())):
                owners[r].update(test.owners[k])
    names = [{test.ids[o] for o in x} for x in owners]
    return n_words, hit, names, longest, (starts, ends, rows)


def suffix_array(rank: np.ndarray, depth: int) -> np.ndarray:
    n = len(rank)
    key, size, where = rank, 1, np.arange(n)
    while size < depth:
        key = suffixes.ranks(key * (n + 1) + suffixes.following(key, where, size))
        size *= 2
    return np.argsort(key)


def _extend(words, rows, at, size, test, which):
    """Full verbatim length of each occurrence, to the right."""
    length = size.copy()
    live = np.arange(len(at))
    while len(live):
        x, y = at[live] + length[live], test.at[which[live]] + length[live]
        ok = (x < len(words)) & (y < len(test.words))
        live, x, y = live[ok], x[ok], y[ok]
        ok = (rows[x] == rows[at[live]]) & (test.rows[y] == test.rows[test.at[which[live]]]) \
            & (words[x] == test.words[y])
        live = live[ok]
        length[live] += 1
    return length


def _block_filters(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    """The test items in blocks of bounded size; equal rows share a block."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                             F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // (2 * block_words)))  # a word takes two characters at least
    if n == 1:
        return [items]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [items.filter(part == b) for b in range(n)]


def _state_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(STATE, T.StructType([
        T.StructField("hits", T.BinaryType()), T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("longest", T.LongType())]))])


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13,
                       min_share: float = 0.05, block_words: int = 200_000,
                       keep_clean: bool = False) -> DataFrame:
    """One row per document: words, hit words, items met, verdict, longest
    verbatim match, the hit spans as ``start:end`` word numbers, the items.

    With ``keep_clean`` the result is instead the clean rows of ``docs``
    with all their columns.
    """
    if not keep_clean:
        docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    share = int(round(1 / min_share))
    blocks = _block_filters(benchmark, block_words)
    out = docs
    for k, block in enumerate(blocks):
        test = spark.sparkContext.broadcast(test_windows([tuple(r) for r in block.collect()], window))
        last = k == len(blocks) - 1
        schema = _state_schema(docs.schema) if not last else docs.schema if keep_clean else SCHEMA
        out = out.mapInArrow(_pass(test, len(docs.columns), k > 0, last, share, keep_clean), schema)
        if not last:  # one block in memory at a time
            shared_root(spark)
            out = out.checkpoint()
    return out


def _pass(test, n_columns, carried, last, share, keep_clean):
    """Search one block; merge with what earlier blocks found."""
    def run(batches):
        for batch in batches:
            for rows, texts in tb.chunks(batch):
                n_words, hit, names, longest, where = _shard_hits(texts, test.value)
                if carried:
                    old = rows.column(n_columns).to_pylist()
                    bits = b"".join(x["hits"] for x in old)
                    hit |= np.frombuffer(bits, bool)
                    names = [a | set(x["items"]) for a, x in zip(names, old)]
                    longest = np.maximum(longest, [x["longest"] for x in old])
                own = rows.select(list(range(n_columns)))
                if last:
                    yield _report(own, n_words, hit, names, longest, where, share, keep_clean)
                    continue
                cut = np.concatenate(([0], np.cumsum(n_words)))
                state = [{"hits": hit[a:b].tobytes(), "items": list(x), "longest": int(m)}
                         for a, b, x, m in zip(cut[:-1], cut[1:], names, longest)]
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(state, _STATE_ARROW)], names=[*own.schema.names, STATE])

    return run


def _report(batch, n_words, hit, names, longest, where, share, keep_clean):
    rows = where[2]
    n_hit = tb.counts_by_row(rows[hit], len(n_words))
    bad = (n_hit > 0) & (share * n_hit >= n_words)
    if keep_clean:
        return batch.filter(pa.array(~bad))
    first = np.concatenate(([0], np.cumsum(n_words)))
    spans: list[list[str]] = [[] for _ in n_words]
    start = hit & np.concatenate(([True], ~hit[:-1] | (rows[1:] != rows[:-1])))[:len(hit)]
    stop = hit & np.concatenate((~hit[1:] | (rows[1:] != rows[:-1]), [True]))[-len(hit):]
    for a, b in zip(np.flatnonzero(start).tolist(), np.flatnonzero(stop).tolist()):
        r = rows[a]
        spans[r].append(f"{a - first[r]}:{b + 1 - first[r]}")
    items = [sorted(i for i in x if i is not None) for x in names]
    return pa.RecordBatch.from_arrays(
        [batch.column(0).cast(pa.int64()), pa.array(n_words), pa.array(n_hit),
         pa.array([len(x) for x in names], pa.int64()),
         pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
         pa.array(bad), pa.array(longest), pa.array([",".join(x) for x in spans], pa.string()),
         pa.array(items, pa.list_(pa.string()))],
        names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
               "longest_match", "spans", "items"])
