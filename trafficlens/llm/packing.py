"""Packing of tokenised documents into sequences of a fixed length.

Tasks tokenise the documents, cut those longer than a sequence and number
the pieces of each length. The plan of a packing needs the number of pieces
by length only: pieces of one length are interchangeable, and so are bins of
one pattern (the lengths they hold). The histogram has at most ``capacity``
rows at any size of the corpus. Best fit on it, then a swap-based local
search, give a list of patterns with counts; each piece then finds its place
by its length and its rank among the pieces of that length.

The local search exchanges pieces between two underfull bins: one for
nothing (a move), one for one, two for one or one for two, always so that
the sum of squared fills grows, until no exchange helps; bins that lose
their last piece are gone. An exchange is made for as many pairs of bins of
the two patterns at once as there are.

Defined cases: a null or empty text is the separator id alone, a piece of
length 1; repeated rows and ids and null ids are pieces of their own; an
empty table gives no rows; special tokens written in a text are encoded as
the tokenizer does by default; other columns are ignored.
"""

from __future__ import annotations

import bisect
import gc
import json
import os
import re
import struct
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficlens.session import fresh_path

from . import text_batches as tb

CACHE = 1_200_000  # distinct words, and parts of them, that a Python worker remembers
EFFORT = 200_000  # exchanges the local search may make

Pattern = tuple[tuple[int, int], ...]  # (length, copies), longest first


# ---------------------------------------------------------------- token ids

def drops_space(spec: dict) -> bool:
    """Does the tokenizer cut at white space and leave it out? Then words can
    be encoded one by one."""
    steps = spec.get("pre_tokenizer") or {}
    first = (steps.get("pretokenizers") or [steps])[0]
    if first.get("type") in ("Whitespace", "WhitespaceSplit"):
        clean = True
    else:
        pattern = (first.get("pattern") or {}).get("Regex", r"\s")
        # outside of negated classes the pattern must name no white space
        clean = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") \
            and not re.search(r"\\[sSW]|\.|\x20", re.sub(r"\[\^[^\]]*\\s[^\]]*\]", "", pattern))
    return bool(clean) and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"]
                                   for t in spec.get("added_tokens", []))


# Latin words need no normalising beyond lower case, and fall apart where the pattern says
# (letters run from U+00DF to U+024F, but for the division sign).
_LATIN = "a-z\u00df-\u00f6\u00f8-\u024f"
_PLAIN_WORD = re.compile(f"[!-~{_LATIN}]+")
_PLAIN_PART = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^0-9{_LATIN}]+")
PARTS_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def has_parts(spec: dict) -> bool:
    """Is a word cut by PARTS_PATTERN, after NFC and lower-casing, so that its
    parts can be encoded one by one?"""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    return (steps[0].get("pattern") or {}).get("Regex") == PARTS_PATTERN and kinds == ["NFC", "Replace", "Lowercase"] \
        and [x.get("type") for x in steps[1:]] == ["ByteLevel"] and not steps[1].get("use_regex") \
        and not steps[1].get("add_prefix_space")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers. It remembers
    words, and the parts that words fall into."""

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task a core
        from tokenizers import Tokenizer
        self.core = Tokenizer.from_str(spec)
        self.core.no_truncation()
        self.core.no_padding()
        found = json.loads(spec)
        self.by_word = drops_space(found)
        self.by_part = self.by_word and has_parts(found)
        self.marks = frozenset(t["content"][0].lower() for t in found.get("added_tokens", []))  # of special tokens
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        got = self.core.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(ids)}I", *ids) for e in got for ids in (e.ids,)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._ids(texts)
        if len(self.words) > CACHE:
            self.words.clear()
        split = [t.replace("\n", " ").split(" ") for t in texts]
        gc.disable()  # no cycles here, and many small lists
        self._learn(set().union(*split).difference(self.words))
        gc.enable()
        return [b"".join(map(self.words.__getitem__, s)) for s in split]

    def _learn(self, new: set[str]) -> None:
        whole, apart, parts = [], [], set()
        if len(self.parts) > CACHE:
            self.parts.clear()
        for word in new:
            low = word.lower()
            if self.by_part and _PLAIN_WORD.fullmatch(low) and self.marks.isdisjoint(low):
                found = _PLAIN_PART.findall(low)
                parts.update(found)
                apart.append((word, found))
            else:
                whole.append(word)
        fresh = list(parts.difference(self.parts))
        self.parts.update(zip(fresh, self._ids(fresh)))
        known = self.parts
        for word, found in apart:
            self.words[word] = known[found[0]] if len(found) == 1 else b"".join([known[p] for p in found])
        self.words.update(zip(whole, self._ids(whole)))


# ---------------------------------------------------------------- plan of the bins

def best_fit(lengths: dict[int, int], capacity: int) -> Counter[Pattern]:
    """Best fit, longest first, on counts: each length goes to the fullest
    bins it fits in, as many copies a bin as fit."""
    bins: dict[int, Counter] = defaultdict(Counter)  # gap -> patterns
    gaps: list[int] = []  # sorted

    def put(pattern, n, gap):
        if n:
            if gap not in bins:
                bisect.insort(gaps, gap)
            bins[gap][pattern] += n

    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                pattern, n = bins[gap].popitem()
                if not bins[gap]:
                    del bins[gap], gaps[at]
            else:
                gap, pattern, n = capacity, (), left
            fit = gap // length
            whole = min(n, left // fit)
            put(pattern + ((length, fit),), whole, gap - fit * length)
            left, n = left - whole * fit, n - whole
            if n and left:  # fewer than a bin takes are left
                put(pattern + ((length, left),), 1, gap - left * length)
                left, n = 0, n - 1
            if pattern:
                put(pattern, n, gap)
    return sum(bins.values(), Counter())


@lru_cache(maxsize=100_000)
def _fill(pattern: Pattern) -> int:
    return sum(length * copies for length, copies in pattern)


@lru_cache(maxsize=100_000)
def _pairs(pattern: Pattern) -> dict[int, tuple[int, int]]:
    """Sums of two pieces of a bin, with two pieces that give each."""
    return {a + b: (a, b) for i, (a, copies) in enumerate(pattern)
            for b, _ in pattern[i + (copies == 1):]}


def _swap(pattern: Pattern, out: tuple[int, ...], into: tuple[int, ...]) -> Pattern:
    held = Counter(dict(pattern))
    held.subtract(out)
    held.update(into)
    return tuple(sorted(((a, n) for a, n in held.items() if n), reverse=True))


class _Underfull:
    """Underfull bins by pattern, with the patterns that hold a piece of a
    length, or two of a sum, and bit sets of those lengths and sums."""

    def __init__(self, capacity: int):
        self.capacity, self.bins = capacity, Counter()
        self.holders = (defaultdict(set), defaultdict(set))
        self.bits = [0, 0]

    def _index(self, pattern: Pattern, there: bool) -> None:
        for kind, sums in enumerate((dict(pattern), _pairs(pattern))):
            for total in sums:
                held = self.holders[kind][total]
                (held.add if there else held.discard)(pattern)
                if bool(self.bits[kind] >> total & 1) != bool(held):
                    self.bits[kind] ^= 1 << total

    def change(self, pattern: Pattern, n: int) -> None:
        before = self.bins[pattern]
        self.bins[pattern] += n
        if not before or not self.bins[pattern]:
            self._index(pattern, not before)
        if not self.bins[pattern]:
            del self.bins[pattern]

    def _giver(self, kind: int, total: int, x: Pattern) -> Pattern | None:
        """The emptiest bin, not x's own, that can give total."""
        found = [p for p in self.holders[kind][total] if p != x or self.bins[p] > 1]
        return min(found, key=lambda p: (_fill(p), p), default=None)

    def exchange(self, x: Pattern, emptiest: int) -> tuple[Pattern, tuple[int, ...], tuple[int, ...]] | None:
        """(y, pieces y gives, pieces x gives back) that raise the sum of
        squared fills the most; None if nothing does. A net gift of d from y
        raises it by 2 d (d + fill x - fill y)."""
        full, best, how = _fill(x), 0, None
        gap = self.capacity - full
        backs = [(0, (), (0,)), *((a, (a,), (0, 1)) for a, _ in x), *((t, ab, (0,)) for t, ab in _pairs(x).items())]
        for back, pieces, kinds in backs:
            for kind in kinds:
                hit = self.bits[kind] >> back + 1 & (1 << gap) - 1
                while hit:
                    net = hit.bit_length()
                    if net * (net + full - emptiest) <= best:
                        break
                    y = self._giver(kind, back + net, x)
                    if y is not None and (gain := net * (net + full - _fill(y))) > best:
                        best, how = gain, (y, _pairs(y)[back + net] if kind else (back + net,), pieces)
                    hit ^= 1 << net - 1
        return how


def local_search(bins: Counter[Pattern], capacity: int, effort: int = EFFORT) -> Counter[Pattern]:
    """Exchanges between underfull bins until none raises the squared fill, or
    ``effort`` exchanges are made (the packing is whole at any time)."""
    done, under = Counter(), _Underfull(capacity)
    for pattern, n in bins.items():
        if _fill(pattern) == capacity:
            done[pattern] += n
        else:
            under.change(pattern, n)
    moved = True
    while moved and effort > 0:
        moved = False
        emptiest = min(map(_fill, under.bins), default=0)
        for x in sorted(under.bins, key=lambda p: (-_fill(p), p)):  # the fullest take first
            while under.bins[x] and effort > 0 and (got := under.exchange(x, emptiest)):
                y, give, back = got
                n = under.bins[x] // 2 if x == y else min(under.bins[x], under.bins[y])
                under.change(x, -n)
                under.change(y, -n)
                new_x, new_y = _swap(x, back, give), _swap(y, give, back)
                for new in (new_x, new_y):
                    if _fill(new) == capacity:
                        done[new] += n
                    elif new:
                        under.change(new, n)
                        emptiest = min(emptiest, _fill(new))
                moved, effort = True, effort - 1
    return done + under.bins


class Places:
    """Where the r-th piece of a length goes: for each length, runs of ranks
    over the bins of one pattern."""

    def __init__(self, bins: Counter[Pattern]):
        runs, first, bin_id = [], Counter(), 0
        for pattern, n in sorted(bins.items()):
            offset = 0
            for length, copies in pattern:
                runs.append((length, first[length], bin_id, copies, offset))
                first[length] += n * copies
                offset += length * copies
            bin_id += n
        self.lengths = dict(first)
        self.n_bins = bin_id
        runs.sort()
        self.length, self.first, self.bin, self.copies, self.offset = \
            (np.array(c, np.int64) for c in (zip(*runs) if runs else [[]] * 5))

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence_id, offset) of pieces by length and rank."""
        lo = np.searchsorted(self.length, length, side="left")
        hi = np.searchsorted(self.length, length, side="right")
        while (hi - lo > 1).any():  # the last run that starts at or before the rank
            mid = (lo + hi) // 2
            up = (hi - lo > 1) & (self.first[np.minimum(mid, len(self.first) - 1)] <= rank)
            lo, hi = np.where(up, mid, lo), np.where(up | (hi - lo <= 1), hi, mid)
        bins, slot = np.divmod(rank - self.first[lo], self.copies[lo])
        return self.bin[lo] + bins, self.offset[lo] + slot * length


# ---------------------------------------------------------------- the operator

def cut(docs: DataFrame, tokenizer: str, capacity: int, separator: int = 0, ids: bool = False,
        doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 [, ids], and the piece's task and
    its rank among the task's pieces of that length. Written to the shared
    folder, as ranks must not change once counted."""
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer)  # the vocabulary file
    end = struct.pack("<I", separator)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"] + ["ids"] * ids
    kinds = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, rank bigint"

    def run(batches):
        encoder = tb.of_worker("packing", hash(sent.value), lambda: Encoder(sent.value))
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows, texts in tb.chunks(batch):
                out = []
                for row, data in enumerate(encoder.encode(texts.to_pylist())):
                    data += end
                    for at in range(0, len(data), 4 * capacity):
                        one = data[at:at + 4 * capacity]
                        n = len(one) // 4
                        out.append((row, at // (4 * capacity), at // 4, n, zlib.crc32(one), seen[n],
                                    np.frombuffer(one, "<u4") if ids else None))
                        seen[n] += 1
                row, piece, start, length, crc, rank, held = zip(*out)
                cols = [rows.column(0).cast(pa.int64()).take(pa.array(row)), pa.array(piece, pa.int32()),
                        *(pa.array(c, pa.int64()) for c in (start, length, crc)),
                        pa.array([task] * len(out), pa.int32()), pa.array(rank, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(held, pa.list_(pa.int64()))] * ids, names=names)

    path = fresh_path(docs.sparkSession, "pieces")
    docs.select(doc_id, text).toDF("doc_id", "text").mapInArrow(
        run, kinds + (", ids array<bigint>" if ids else "")).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, separator: int = 0, ids: bool = False,
         effort: int = EFFORT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all documents with their sequence_id and offset, one row
    each; ``tokenizer`` is the text of a tokenizers file."""
    pieces = cut(docs, tokenizer, capacity, separator, ids, doc_id, text)
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    lengths = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    places = Places(local_search(best_fit(lengths, capacity), capacity, effort))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    sent = docs.sparkSession.sparkContext.broadcast(places)

    def run(batches):
        for batch in batches:
            length, rank, first = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank", "first"))
            bins, offset = sent.value.of(length, rank + first)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(bins), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids
    schema = ", ".join(f"{c} {t}" for c, t in pieces.dtypes if c in kept)
    return pieces.join(firsts, ["task", "length"]).select(*kept, "rank", "first").mapInArrow(
        run, f"{schema}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the ids of each sequence, of pieces packed with ids."""
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return held.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"))
