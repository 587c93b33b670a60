"""Alignment of the tokens of two tokenizers over the same text.

Both tokenizers encode a text after a space. The byte offsets where their
tokens end are two increasing lists; a galloping intersection finds the
offsets they share: each end of the shorter list drives an exponential and
then a binary search in the longer one, from where the tokens of its part
start there.
The shared ends cut the tokens into groups, the differences of their ranks
are the ranges of tokens on both sides, and all pairs of an A and a B token
of one group are linked.

Where neither tokenizer can put a token across a space, a text falls apart
there without changing its tokens, and each distinct part of a task is
encoded and aligned once.

How often an id pair is linked is counted over all documents. Chunks of
documents (``CHUNK_BYTES`` of text; a longer document is its own) are the
unit of that exchange: a chunk sends its distinct pairs with the number of
its documents that hold each, and gets the corpus-wide counts of just these
pairs back, so neither the table of all pairs nor the pairs of single
documents ever travel.

Defined cases: null and empty texts, and texts whose tokens do not spell
them out (the marker U+2581 in a text becomes a space), have no tokens:
zeros and empty columns. Strings of special tokens are ordinary text.
Repeated rows and ids and null ids are documents of their own. A group
without inner common ends links the distinct ids of its two sides, however
long it is. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.session import fresh_path

from . import text_batches as tb
from .pieces import MARK, parse, splits_at_marks

CHUNK_BYTES = 4 << 20  # of text
CACHE = 600_000  # distinct parts a task remembers
CACHE_PAIRS = 4_000_000  # and id pairs of them
SLICE = 5_000  # parts encoded at a time
WIDE = 4_096  # pairs of a group from which on its distinct ids are paired
BYTE, SHIFT = 6, 32  # piece type of a byte; an id pair is a << SHIFT | b
_CUT = re.compile(r"(?<=\S) (?=\S)")


# ---------------------------------------------------------------- galloping intersection

def gallop(values: np.ndarray, targets: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """For each target the first index from its ``lo`` on whose value is not
    below it: doubling steps, then a binary search in the last of them. All
    targets step at the same time."""
    lo, hi = lo.copy(), np.full(len(targets), len(values), np.int64)
    active, step = np.arange(len(targets)), 1
    while active.size:
        probe = lo[active] + step - 1
        below = probe < len(values)
        below[below] = values[probe[below]] < targets[active[below]]
        hi[active[~below]] = np.minimum(probe[~below], len(values))
        active = active[below]
        lo[active] += step
        step *= 2
    active = np.flatnonzero(lo < hi)
    while active.size:
        mid = (lo[active] + hi[active]) // 2
        below = values[mid] < targets[active]
        lo[active[below]] = mid[below] + 1
        hi[active[~below]] = mid[~below]
        active = active[lo[active] < hi[active]]
    return lo


def common_ends(a: np.ndarray, b: np.ndarray, start_a: np.ndarray | int = 0,
                start_b: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Indices (in a, in b) of the values that two increasing lists share. The
    shorter list drives; ``start_a`` and ``start_b`` are, for each element of
    the other list, where its search may start."""
    if len(a) > len(b):
        return common_ends(b, a, start_b, start_a)[::-1]
    at = gallop(b, a, np.broadcast_to(np.asarray(start_b, np.int64), a.shape))
    hit = at < len(b)
    hit[hit] = b[at[hit]] == a[hit]
    return np.flatnonzero(hit), at[hit]


# ---------------------------------------------------------------- token bytes

def byte_alphabet() -> dict[str, int]:
    """Character to byte in a byte-level vocabulary: printable Latin-1 stands
    for itself, the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def bytes_a(core) -> list[bytes]:
    letters, size = byte_alphabet(), core.get_vocab_size(with_added_tokens=True)
    out = [b""] * size
    for token, i in core.get_vocab(with_added_tokens=True).items():
        out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return out


def bytes_b(model: bytes) -> list[bytes]:
    return [bytes([int(p.piece[3:-1], 16)]) if p.type == BYTE else p.piece.replace(MARK, " ").encode()
            for p in parse(model).pieces]


def parts_at_spaces(spec: str, model: bytes) -> bool:
    """Do both tokenizers start a new token at a lone space?"""
    a, b = json.loads(spec), parse(model)
    pre, norm = a.get("pre_tokenizer") or {}, b.normalizer_spec
    return not a.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", False) \
        and not pre.get("add_prefix_space") and splits_at_marks(b.pieces) and norm.add_dummy_prefix \
        and norm.escape_whitespaces and not norm.precompiled_charsmap and not norm.remove_extra_whitespaces


def _joined(values: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and how many each list has."""
    lens = np.array([len(v) for v in values], np.int64)
    return np.fromiter(chain.from_iterable(values), np.int64, int(lens.sum())), lens


def _before(lens: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lens)))


class Aligner:
    """Aligned parts of a task. A part (without the space before it) has a
    number; its groups, its four counts and its id pairs (a range of ``codes``
    and ``times``) are kept by that number. New parts are aligned together, as
    one text whose parts have no token in common."""

    def __init__(self, spec: str, model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task a core
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(spec)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_a, self.bytes_b = (pa.array(x, pa.large_binary()) for x in (bytes_a(self.a), bytes_b(model)))
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        # an id with what follows it: inside a side, behind A's, behind B's
        self.atoms = pa.array([f"{i}{c}" for n, cs in ((n_a, ",|"), (n_b, ",;")) for c in cs for i in range(n)], pa.large_string())
        self.atom_of = (0, n_a, 2 * n_a, 2 * n_a + n_b)
        self.apart = parts_at_spaces(spec, model)
        self._clear()

    def _clear(self):
        self.number: dict[str, int] = {}
        self.spelled: list[bytes] = []  # groups, each closed by a semicolon
        self.counts = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, links; -1s if the bytes differ
        self.codes, self.times, self.first = (np.zeros(n, np.int64) for n in (0, 0, 1))

    def _learn(self, new: list[str]) -> None:
        encoded = []
        for lo in range(0, len(new), SLICE):  # the library's results are large
            encoded += [e.ids for e in self.a.encode_batch_fast([" " + p for p in new[lo:lo + SLICE]], add_special_tokens=False)]
        a, n_a = _joined(encoded)
        b, n_b = _joined(self.b.encode(new, num_threads=1))
        good = self._spell_alike(new, a, n_a, b, n_b)
        part_a, part_b = np.repeat(np.arange(len(new)), n_a), np.repeat(np.arange(len(new)), n_b)
        a, part_a, b, part_b = a[good[part_a]], part_a[good[part_a]], b[good[part_b]], part_b[good[part_b]]
        n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        ends_a, ends_b = (np.cumsum(pc.binary_length(t.take(pa.array(x))).to_numpy()) for t, x in ((self.bytes_a, a), (self.bytes_b, b)))
        i, j = common_ends(ends_a, ends_b, _before(n_a)[part_b], _before(n_b)[part_a])
        part, size_a, size_b = part_a[i], np.diff(i, prepend=-1), np.diff(j, prepend=-1)
        counts = np.stack([n_a, n_b, np.bincount(part, minlength=len(new)), np.zeros(len(new), np.int64)], axis=1)
        np.add.at(counts[:, 3], part, size_a * size_b)
        counts[~good] = -1
        codes, times, n_pairs = self._links(a, b, i + 1 - size_a, j + 1 - size_b, size_a, size_b, part, len(new))
        data, ends = self._spell(a, b, i, j, size_a, size_b, n_a + n_b)
        self.number.update(zip(new, range(len(self.spelled), len(self.spelled) + len(new))))
        self.spelled += [data[x:y] for x, y in zip(ends, ends[1:])]
        self.counts = np.concatenate([self.counts, counts])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(n_pairs)])
        self.codes, self.times = np.concatenate([self.codes, codes]), np.concatenate([self.times, times])

    def _spell_alike(self, new, a, n_a, b, n_b) -> np.ndarray:
        """Which parts both sides spell as they are."""
        text = pa.array([" " + p for p in new], pa.large_string())
        size = pc.binary_length(text).to_numpy()
        good, sides = np.ones(len(new), bool), []
        for table, ids, n in ((self.bytes_a, a, n_a), (self.bytes_b, b, n_b)):
            spelled = table.take(pa.array(ids))
            ends = _before(pc.binary_length(spelled).to_numpy())[_before(n)]
            good &= np.diff(ends) == size
            sides.append((tb.buffer_of(spelled)[0], ends[:-1]))
        whole, starts = tb.buffer_of(text)
        at, lens = np.flatnonzero(good), size[good]
        want = whole[_spread(starts[:-1][good], lens)]
        for data, begins in sides:
            same = data[_spread(begins[at], lens)] == want
            if not same.all():
                good[at[np.unique(np.searchsorted(_before(lens), np.flatnonzero(~same), side="right") - 1)]] = False
        return good

    @staticmethod
    def _links(a, b, from_a, from_b, size_a, size_b, part, n):
        """codes, times (part by part) and how many each part has."""
        wide = size_a * size_b > WIDE
        some = np.flatnonzero(~wide)
        lens = size_a[some] * size_b[some]
        group = np.repeat(some, lens)
        within = np.arange(len(group)) - np.repeat(np.cumsum(lens) - lens, lens)
        codes = a[from_a[group] + within // size_b[group]] << SHIFT | b[from_b[group] + within % size_b[group]]
        times, owner = np.ones(len(codes), np.int64), part[group]
        if wide.any():  # by distinct ids: bounded by the vocabularies
            more = [(part[g], x << SHIFT | y, p * q) for g in np.flatnonzero(wide)
                    for right in [Counter(b[from_b[g]:from_b[g] + size_b[g]].tolist()).items()]
                    for x, p in Counter(a[from_a[g]:from_a[g] + size_a[g]].tolist()).items() for y, q in right]
            extra = np.array(more, np.int64)
            owner, codes, times = (np.concatenate([x, extra[:, k]]) for k, x in enumerate((owner, codes, times)))
            order = np.argsort(owner, kind="stable")
            owner, codes, times = owner[order], codes[order], times[order]
        return codes, times, np.bincount(owner, minlength=n)

    def _spell(self, a, b, i, j, size_a, size_b, tokens) -> tuple[bytes, list[int]]:
        """The groups of all parts as text, and where each part's begins."""
        group_a, group_b = np.repeat(np.arange(len(i)), size_a), np.repeat(np.arange(len(j)), size_b)
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[i], last_b[j] = True, True
        inside_a, behind_a, inside_b, behind_b = self.atom_of
        atoms = np.empty(len(a) + len(b), np.int64)
        atoms[np.arange(len(a)) + (_before(size_b))[group_a]] = a + np.where(last_a, behind_a, inside_a)
        atoms[np.arange(len(b)) + (_before(size_a))[group_b + 1]] = b + np.where(last_b, behind_b, inside_b)
        data, ends = tb.buffer_of(self.atoms.take(pa.array(atoms)))
        return data.tobytes(), ends[_before(tokens)].tolist()

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """The numbers of the parts of each text."""
        if len(self.number) > CACHE or len(self.codes) > CACHE_PAIRS:
            self._clear()
        split = [(_CUT.split(t) if self.apart else [t]) if t else [] for t in texts]
        new = set(chain.from_iterable(split)).difference(self.number)
        if new:
            self._learn(list(new))
        return [list(map(self.number.__getitem__, s)) for s in split]

    def groups_of(self, numbers: list[int]) -> bytes:
        return b"".join(map(self.spelled.__getitem__, numbers))[:-1]


def _spread(first: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The concatenated ranges first .. first + len."""
    ends = np.cumsum(lens)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - lens), lens)


def _pairs(aligner: Aligner, rows: np.ndarray, parts: np.ndarray):
    """The distinct id pairs of a chunk, and of each (row, pair) the row, the
    pair's index among them and how many links it stands for."""
    codes, times, first = aligner.codes, aligner.times, aligner.first
    used = np.unique(parts)
    held = _spread(first[used], first[used + 1] - first[used])
    distinct = np.unique(codes[held])
    index = np.zeros(len(codes), np.int64)
    index[held] = np.searchsorted(distinct, codes[held])
    lens = first[parts + 1] - first[parts]
    at = _spread(first[parts], lens)
    key = np.repeat(rows, lens) * max(len(distinct), 1) + index[at]
    order = np.argsort(key, kind="stable")
    key, weight = key[order], times[at][order]
    start = np.flatnonzero(np.diff(key, prepend=-1)) if len(key) else np.zeros(0, np.int64)
    row, pair = np.divmod(key[start], max(len(distinct), 1))
    return distinct, row, pair, np.add.reduceat(weight, start) if len(start) else weight


# ---------------------------------------------------------------- the operator

def align(docs: DataFrame, spec: str, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the groups of its tokens, in order: the ids of A and of B.
    ``spec`` is the text of a tokenizers file, ``model`` a sentencepiece model."""
    sent = docs.sparkSession.sparkContext.broadcast((spec, model))

    def run(batches):
        aligner = Aligner(*sent.value)
        for batch in batches:
            for rows, texts in tb.chunks(batch):
                out = []
                for numbers in aligner.numbers(texts.to_pylist()):
                    said = "" if (aligner.counts[numbers, 0] < 0).any() else aligner.groups_of(numbers).decode()
                    out.append([dict(zip("ab", ([int(i) for i in side.split(",")] for side in g.split("|"))))
                                for g in said.split(";") if g])
                kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
                yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), pa.array(out, kind)],
                                                 names=["doc_id", "groups"])

    return docs.select(doc_id, text).toDF("doc_id", "text").mapInArrow(
        run, "doc_id bigint, groups array<struct<a array<int>, b array<int>>>")


STAGED = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
          "groups_sha256": pa.string(), "chunk": pa.int64(), "pairs": pa.list_(pa.int32()), "times": pa.list_(pa.int64()),
          "codes": pa.list_(pa.int64()), "docs": pa.list_(pa.int64())}
STAGED_SQL = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, chunk bigint, "
              "pairs array<int>, times array<bigint>, codes array<bigint>, docs array<bigint>")


def _chunk(aligner: Aligner, chunk: int, ids: pa.Array, texts: list[str]) -> list[pa.RecordBatch]:
    """Rows of the documents of a chunk, and one row with its pairs."""
    numbers = aligner.numbers(texts)
    n, lens = len(texts), np.array([len(x) for x in numbers], np.int64)
    parts = np.fromiter(chain.from_iterable(numbers), np.int64, int(lens.sum()))
    rows = np.repeat(np.arange(n), lens)
    counts = aligner.counts
    good = np.ones(n, bool)
    good[rows[counts[parts, 0] < 0]] = False
    keep = good[rows]
    rows, parts = rows[keep], parts[keep]
    sums = np.zeros((n, 4), np.int64)
    np.add.at(sums, rows, counts[parts])
    sha = [hashlib.sha256(aligner.groups_of(x)).hexdigest() if ok and x else "" for ok, x in zip(good, numbers)]
    codes, row, pair, times = _pairs(aligner, rows, parts)
    offsets = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())

    def batch(length, **cols):
        return pa.RecordBatch.from_arrays([cols[c] if c in cols else pa.nulls(length, t) for c, t in STAGED.items()],
                                          schema=pa.schema(list(STAGED.items())))

    return [batch(n, doc_id=ids.cast(pa.int64()), n_a=pa.array(sums[:, 0]), n_b=pa.array(sums[:, 1]),
                  n_groups=pa.array(sums[:, 2]), n_links=pa.array(sums[:, 3]), groups_sha256=pa.array(sha, pa.string()),
                  chunk=pa.array([chunk] * n, pa.int64()), pairs=pa.ListArray.from_arrays(offsets, pa.array(pair, pa.int32())),
                  times=pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))),
            batch(1, chunk=pa.array([chunk], pa.int64()), codes=pa.array([codes], pa.list_(pa.int64())),
                  docs=pa.array([np.bincount(pair, minlength=len(codes))], pa.list_(pa.int64())))]


def _stage(docs: DataFrame, spec: str, model: bytes, doc_id: str, text: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((spec, model))

    def run(batches):
        aligner, chunk = Aligner(*sent.value), TaskContext.get().partitionId() << SHIFT
        for batch in batches:
            for rows, texts in tb.chunks(batch, limit=CHUNK_BYTES):
                yield from _chunk(aligner, chunk, rows.column(0), texts.to_pylist())
                chunk += 1

    path = fresh_path(docs.sparkSession, "alignment")
    docs.select(doc_id, text).toDF("doc_id", "text").mapInArrow(run, STAGED_SQL).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def pair_counts(staged: DataFrame) -> DataFrame:
    """code, n: how many documents hold an id pair linked."""
    return _pair_rows(staged).groupBy("code").agg(F.sum("docs").alias("n"))


def _pair_rows(staged: DataFrame) -> DataFrame:
    return staged.filter("codes is not null").select("chunk", F.inline(F.arrays_zip("codes", "docs"))) \
        .withColumnRenamed("codes", "code")


OUT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
       "groups_sha256 string")


def _finish(docs: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of a chunk with the corpus-wide counts of its pairs."""
    order = np.argsort(known["code"].to_numpy())
    n, best = known["n"].to_numpy()[order], known["best"].to_numpy()[order]
    pairs, times = docs["pairs"].combine_chunks(), docs["times"].combine_chunks()
    row = np.repeat(np.arange(len(docs)), np.diff(pairs.offsets.to_numpy()))
    pair, times = pairs.flatten().to_numpy(), times.flatten().to_numpy()
    out = np.zeros((2, len(docs)), np.int64)
    np.add.at(out[0], row, np.where(best[pair], times, 0))
    np.add.at(out[1], row, times * n[pair])
    got = {"n_best": pa.array(out[0]), "count_sum": pa.array(out[1])}
    names = [c.split()[0] for c in OUT.split(", ")]
    return pa.table([got.get(c, docs[c] if c not in got else None) for c in names], names=names)


def align_digests(docs: DataFrame, spec: str, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best (links whose pair is
    the most frequent of its A id), count_sum (of the pairs' document counts
    over the links) and the digest of its groups."""
    staged = _stage(docs, spec, model, doc_id, text)
    counts = pair_counts(staged).withColumn("a", F.shiftright("code", SHIFT))
    top = counts.groupBy("a").agg(F.max("n").alias("top"))  # at most a row for each id of A's vocabulary
    known = _pair_rows(staged).select("chunk", "code").join(counts, "code") \
        .join(F.broadcast(top), "a").select(F.col("chunk").alias("of"), "code", "n", (F.col("n") == F.col("top")).alias("best"))
    mine = staged.filter("codes is null").drop("codes", "docs")
    return mine.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(_finish, OUT)
