"""SentencePiece encoding and decoding on the tokenizers library.

The model protobuf is parsed and rebuilt: its normaliser, the meta-space
marker, unigram scores or the merges that BPE scores stand for, and byte
fallback. If no piece of the vocabulary crosses into a marker, a text
falls apart at the markers without changing its pieces; each distinct part
of a task is then encoded once, in multithreaded batches, decoded again
and compared with the sentencepiece library.

Defined cases: null and empty texts have no pieces and decode to the empty
text; control symbols written in a text are ordinary characters; a text
that holds the marker itself decodes with a space in its place (as the
sentencepiece library does) and is flagged ``round_trip = false``; repeated
rows encode alike; other columns are ignored. A text that spells out the
name of a byte symbol ("<0x41>") may differ under a unigram model, whose
library form knows byte symbols by name: ``parity`` then says so.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text_batches as tb

MARK = "▁"
NORMAL, CONTROL, UNIGRAM, BPE = 1, 3, 1, 2
CACHE = 400_000  # distinct parts a task remembers


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def parse(model: bytes):
    from sentencepiece import sentencepiece_model_pb2 as proto
    got = proto.ModelProto()
    got.ParseFromString(model)
    return got


def _merges(pieces) -> list[tuple[str, str]]:
    """BPE merges, best first: every way to make a piece of two pieces."""
    rank = {p.piece: i for i, p in enumerate(pieces)}
    found = []
    for p in pieces:
        if p.type == NORMAL:
            for k in range(1, len(p.piece)):
                a, b = p.piece[:k], p.piece[k:]
                if a in rank and b in rank:
                    found.append((-p.score, rank[a], rank[b], a, b))
    return [(a, b) for *_, a, b in sorted(found)]


def splits_at_marks(pieces) -> bool:
    return not any(MARK in p.piece.lstrip(MARK) for p in pieces if p.type == NORMAL)


def build(model: bytes, normalise: bool = True):
    """A tokenizers.Tokenizer with the behaviour of the model; without
    ``normalise`` it takes parts that are already normalised."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    m = parse(model)
    unk = m.pieces[m.trainer_spec.unk_id].piece
    if m.trainer_spec.model_type == UNIGRAM:
        # control symbols are never found in a text: their names are put out of reach
        core = models.Unigram([(f"\U0010ffff{i}" if p.type == CONTROL else p.piece, p.score)
                               for i, p in enumerate(m.pieces)], m.trainer_spec.unk_id,
                              m.trainer_spec.byte_fallback)
    elif m.trainer_spec.model_type == BPE:
        core = models.BPE(vocab={p.piece: i for i, p in enumerate(m.pieces)}, merges=_merges(m.pieces),
                          unk_token=unk, fuse_unk=True, byte_fallback=m.trainer_spec.byte_fallback)
    else:
        raise ValueError(f"model type {m.trainer_spec.model_type} is neither unigram nor BPE")
    out = Tokenizer(core)
    spec, steps = m.normalizer_spec, []
    if spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK if spec.escape_whitespaces else " "))
    if spec.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    if normalise and steps:
        out.normalizer = normalizers.Sequence(steps)
    if normalise and splits_at_marks(m.pieces):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
    tail = [decoders.Strip(" ", 1, 0)] if spec.add_dummy_prefix else []
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(),
                                     decoders.Fuse(), *tail])
    return out


class Codec:
    """Encoder of a task. ``parts`` maps a part (a word and the spaces that
    follow the one before it) to its ids, comma-joined; the parts on which the
    sentencepiece library differs are ``odd``, those that do not decode to
    themselves ``lossy``."""

    def __init__(self, model: bytes, threads: int):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        import sentencepiece
        self.whole, self.core = build(model), build(model, normalise=False)
        self.theirs = sentencepiece.SentencePieceProcessor(model_proto=model)
        m = parse(model)
        plain = m.normalizer_spec
        # parts can be checked one by one if normalising only marks spaces
        self.by_part = splits_at_marks(m.pieces) and plain.add_dummy_prefix and plain.escape_whitespaces \
            and not plain.precompiled_charsmap and not plain.remove_extra_whitespaces
        self.parts: dict[str, str] = {}
        self.odd: set[str] = set()
        self.lossy: set[str] = set()

    def _learn(self, new: list[str]) -> None:
        # their encoder puts the first marker itself
        ids = [e.ids for e in self.core.encode_batch_fast([MARK + p.replace(" ", MARK) for p in new],
                                                          add_special_tokens=False)]
        theirs = self.theirs.encode(new, num_threads=1)
        back = self.core.decode_batch(ids, skip_special_tokens=False)
        for p, i, t, b in zip(new, ids, theirs, back):
            self.parts[p] = ",".join(map(str, i))
            if p and i != t:  # a first marker alone has no text for their encoder to see
                self.odd.add(p)
            if b != p:
                self.lossy.add(p)

    @staticmethod
    def split(text: str) -> list[str]:
        """The parts of a text, each without its first marker."""
        words = text.replace(MARK, " ").split(" ")
        if "" not in words:
            return words
        return _PART.findall(" " + " ".join(words)) if text else []

    def encode(self, texts: list[str]) -> list[tuple[str, bool, bool]]:
        """(comma-joined ids, parity, round trip) of each text."""
        if not self.by_part:
            ids = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
            theirs = self.theirs.encode(texts, num_threads=1)
            back = self.whole.decode_batch(ids, skip_special_tokens=False)
            return [(",".join(map(str, i)), i == t, b == x) for i, t, b, x in zip(ids, theirs, back, texts)]
        if len(self.parts) > CACHE:
            for known in (self.parts, self.odd, self.lossy):
                known.clear()
        split = [self.split(x) for x in texts]
        new = set().union(*split).difference(self.parts)
        if new:
            self._learn(list(new))
        return [(",".join(map(self.parts.__getitem__, s)), self.odd.isdisjoint(s),
                 MARK not in x and self.lossy.isdisjoint(s)) for x, s in zip(texts, split)]


_PART = re.compile(" ( *[^ ]*)")


def numbers(ids: str) -> np.ndarray:
    return np.fromstring(ids, np.int32, sep=",") if ids else np.zeros(0, np.int32)


def encode(docs: DataFrame, model: bytes, threads: int = 2) -> DataFrame:
    """doc_id, ids, n_tokens, parity (with the sentencepiece library),
    round_trip (decoding gives the text back), one row per document."""
    return _encoded(docs, model, threads, digest=False)


def encode_digests(docs: DataFrame, model: bytes, threads: int = 2) -> DataFrame:
    """As encode(), with the SHA-256 of the comma-joined ids for the ids."""
    return _encoded(docs, model, threads, digest=True)


def _encoded(docs, model, threads, digest):
    sent = docs.sparkSession.sparkContext.broadcast(model)  # the vocabulary file

    def run(batches):
        codec = Codec(sent.value, threads)
        for batch in batches:
            for rows, texts in tb.chunks(batch):
                got = codec.encode(texts.to_pylist())
                ids = pa.array([hashlib.sha256(g[0].encode()).hexdigest() for g in got], pa.string()) if digest \
                    else pa.array([numbers(g[0]) for g in got], pa.list_(pa.int32()))
                count = [g[0].count(",") + 1 if g[0] else 0 for g in got]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), ids, pa.array(count, pa.int64()),
                     pa.array([g[1] for g in got]), pa.array([g[2] for g in got])],
                    names=["doc_id", "ids_sha256" if digest else "ids", "n_tokens", "parity", "round_trip"])

    kind = "ids_sha256 string" if digest else "ids array<int>"
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id bigint, {kind}, n_tokens bigint, parity boolean, round_trip boolean")


def decode(encoded: DataFrame, model: bytes, ids: str = "ids", into: str = "text") -> DataFrame:
    """The frame with the text that each row's ids stand for (null: null)."""
    sent = encoded.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def texts(column):
        codec = build(sent.value)
        some = column.notna()
        out = column.astype(object).copy()
        if some.any():
            out[some] = codec.decode_batch([[int(i) for i in x] for x in column[some]],
                                           skip_special_tokens=False)
        return out

    return encoded.withColumn(into, texts(F.col(ids)))
