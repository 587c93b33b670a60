"""PII: base patterns and information-theoretic sanitisation.

Base spans (email, ip, card, phone) are found in every whole text and name
the protected entities. Over the whole corpus, N documents, the information
that a term t gives about an entity e is PMI(e; t) = log2(P(e | t) / P(e)),
by documents that hold both, the term outside of base spans; its share of
the entity's own information -log2 P(e) is the disclosure. P(e | t) enters
by its lower confidence bound (Wilson), and documents count as evidence only
as far as they are independent: copies and near copies share a sketch, and
n documents weigh n**2 / sum of squares of the groups that share one. A pair
needs ``min_support`` such documents. A term is generalised from
``generalise_at`` on and removed from ``remove_at`` on, by its highest
disclosure: at every place of every document, with or without the entity,
for there it tells of it.

Defined cases: a null text is empty and has no spans; repeated rows and
copies support no disclosure beyond one document's; an entity that all
documents hold discloses nothing; a very long text is a chunk of its own;
other columns are ignored by find_pii and kept by sanitise.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from trafficlens.session import fresh_path

from . import text_batches as tb

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
PART_TERMS = 150_000  # distinct words a task counts, or remembers, at a time
# The contract's patterns; possessive repeats keep each linear in the text.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")
_MAYBE = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost: the local part is all that can stand before an @ with a domain."""
    out, last = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            last = m.end()
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and then by start."""
    if not _MAYBE.search(text):
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(_octet(p) for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def entity(kind: str, value: str) -> str:
    """What makes two mentions the same entity."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else re.sub('[^0-9]', '', value)}"


def _number(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little", signed=True)


def _terms(text: str) -> set[str]:
    return {w.lower() for w in set(_WORD.findall(text))}


def _outside(text: str, spans) -> list[tuple[int, int]]:
    """Places of the words that no base span touches."""
    inside, out, at = sorted((a, b) for _, a, b in spans), [], 0
    end = 0  # of the spans that start before the word's end
    for m in _WORD.finditer(text):
        s, t = m.span()
        while at < len(inside) and inside[at][0] < t:
            end = max(end, inside[at][1])
            at += 1
        if end <= s:
            out.append((s, t))
    return out


# ---------------------------------------------------------------- corpus statistics

_STATS = {"m": pa.int64(), "es": pa.list_(pa.int64()), "ts": pa.list_(pa.int64()), "sketch": pa.int64(),
          "ct": pa.list_(pa.int64()), "cn": pa.list_(pa.int64()), "docs": pa.int64()}
_STATS_SQL = "m bigint, es array<bigint>, ts array<bigint>, sketch bigint, ct array<bigint>, cn array<bigint>, docs bigint"


def _sketch(terms: list[int]) -> int:
    """The two smallest digests of a document's terms: near copies share them,
    documents of their own hardly ever."""
    return hash(tuple(heapq.nsmallest(2, terms)))


def corpus_statistics(docs: DataFrame) -> DataFrame:
    """One pass over the texts, written to the shared folder. Rows of documents
    with an entity: m, entities es, terms ts, sketch. Rows of a part of a task:
    the numbers cn of documents that hold the terms ct, and of documents."""
    def run(batches):
        m, seen, n_docs = TaskContext.get().partitionId() << 32, {}, 0
        number: dict[str, int] = {}

        def rows(**cols):
            n = len(next(iter(cols.values())))
            return pa.RecordBatch.from_arrays([pa.array(cols[c], t) if c in cols else pa.nulls(n, t) for c, t in _STATS.items()],
                                              schema=pa.schema(list(_STATS.items())))

        def counts():
            return rows(ct=[list(map(_number, seen))], cn=[list(seen.values())], docs=[n_docs])

        for batch in batches:
            for _, texts in tb.chunks(batch):
                found = {"m": [], "es": [], "ts": [], "sketch": []}
                for text in texts.to_pylist():
                    spans = base_spans(text)
                    terms = {text[a:b].lower() for a, b in _outside(text, spans)} if spans else _terms(text)
                    for w in terms:
                        seen[w] = seen.get(w, 0) + 1
                    if spans:
                        ts = [number.get(w) or number.setdefault(w, _number(w)) for w in terms]
                        for name, value in zip(found, (m, [_number(e) for e in {entity(k, text[a:b]) for k, a, b in spans}],
                                                       ts, _sketch(ts))):
                            found[name].append(value)
                        m += 1
                n_docs += len(texts)
                yield rows(**found)
                if len(seen) > PART_TERMS or len(number) > PART_TERMS:
                    yield counts()
                    n_docs = 0
                    seen.clear()
                    number.clear()
        yield counts()

    path = fresh_path(docs.sparkSession, "disclosure")
    docs.select("text").mapInArrow(run, _STATS_SQL).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _independent(n, squares):
    """How many documents of their own a group of n amounts to, by the sum of
    squared sizes of the groups that share a sketch (an inverse Simpson index)."""
    return F.col(n) * F.col(n) / F.col(squares)


def _lower_bound(p, n, z: float):
    """The Wilson bound of a share p seen in n trials."""
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def telling_terms(stats: DataFrame, min_support: float = 3, generalise_at: float = 0.8, z: float = 1.96) -> DataFrame:
    """t, share: the terms that disclose an entity, by their highest share."""
    mentions = stats.filter("m is not null")
    total = stats.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("total"))
    # entities that enough sketches hold; a pair cannot have more sketches than its entity
    holds = mentions.select("sketch", F.explode("es").alias("e")).groupBy("e", "sketch").agg(F.count("*").alias("n")) \
        .groupBy("e").agg(F.sum("n").alias("n_e"), F.count("*").alias("sketches")) \
        .filter(F.col("sketches") >= min_support).drop("sketches")
    # to each mention its supported entities, a few a row, so that a page of many entities is dealt out with its terms
    slices = mentions.select("m", F.explode("es").alias("e")).join(holds, "e") \
        .withColumn("slice", F.pmod(F.xxhash64("e"), F.lit(1024))).groupBy("m", "slice") \
        .agg(F.collect_list(F.struct("e", "n_e")).alias("held")).withColumnRenamed("m", "of")
    pairs = mentions.select("m", "ts", "sketch").join(slices, F.col("m") == F.col("of")) \
        .select("ts", "sketch", F.inline("held")).select("e", "n_e", "sketch", F.explode("ts").alias("t")) \
        .groupBy("e", "t", "sketch").agg(F.count("*").alias("n"), F.first("n_e").alias("n_e")) \
        .groupBy("e", "t").agg(F.sum("n").alias("n_et"), F.sum(F.col("n") * F.col("n")).alias("squares"),
                               F.first("n_e").alias("n_e")) \
        .withColumn("support", _independent("n_et", "squares")).filter(F.col("support") >= min_support)
    counts = stats.filter("ct is not null").select(F.inline(F.arrays_zip("ct", "cn"))) \
        .groupBy(F.col("ct").alias("t")).agg(F.sum("cn").alias("n_t"))
    own = F.log2(F.lit(total.scalar()).cast("double") / F.col("n_e"))
    p = F.least(F.lit(1.0), F.col("n_et") / F.col("n_t"))
    share = F.when(own > 0, F.least(F.lit(1.0), 1 + F.log2(_lower_bound(p, F.col("support") / p, z)) / own)).otherwise(0.0)
    return pairs.join(counts, "t").select("t", share.alias("share")) \
        .groupBy("t").agg(F.max("share").alias("share")).filter(F.col("share") >= generalise_at)


# ---------------------------------------------------------------- masking

class Telling:
    """Disclosing terms as a sorted array; a task remembers its words."""

    def __init__(self, t: np.ndarray, removed: np.ndarray):
        order = np.argsort(t)
        self.t, self.removed, self.known = t[order], removed[order], {}

    def __getstate__(self):
        return self.t, self.removed

    def __setstate__(self, state):
        (self.t, self.removed), self.known = state, {}

    def state(self, word: str) -> bool | None:
        """Removed, generalised (False) or not disclosing (None)."""
        if word not in self.known:
            if len(self.known) > PART_TERMS:
                self.known.clear()
            t = _number(word)
            at = int(np.searchsorted(self.t, t))
            self.known[word] = bool(self.removed[at]) if at < len(self.t) and self.t[at] == t else None
        return self.known[word]

    def spans(self, text: str, base) -> list[dict]:
        """Every place of disclosing terms outside the base spans."""
        if not len(self.t):
            return []
        hit = {w for w in _terms(text) if self.state(w) is not None}
        if not hit:
            return []
        return [{"a": a, "b": b, "removed": self.known[w]} for a, b in _outside(text, base)
                if (w := text[a:b].lower()) in hit]


class Sieve:
    """A Bloom filter of disclosing terms: words of bits, four of them a term."""

    WORDS = 1 << 21  # 16 MB, whatever the number of terms

    def __init__(self, at: np.ndarray, bits: np.ndarray):
        self.words = np.zeros(self.WORDS, np.int64)
        self.words[at] = bits

    @classmethod
    def positions(cls):
        """(word, bits) of a term's four bits, as a Spark column."""
        places = [F.pmod(F.xxhash64("t", F.lit(i)), F.lit(cls.WORDS * 64)) for i in range(4)]
        return F.array(*(F.struct(F.shiftright(x, 6).alias("word"), F.expr("1L").alias("one"), (x % 64).cast("int").alias("bit"))
                         for x in places))

    @classmethod
    def of(cls, telling: DataFrame) -> Sieve:
        bits = telling.select(F.inline(cls.positions())).groupBy("word") \
            .agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits")).toArrow()
        return cls(bits["word"].to_numpy(), bits["bits"].to_numpy())

    def may_hold(self, t: int) -> bool:
        for i in range(4):
            x = _xxhash64(t, i) % (self.WORDS * 64)
            if not int(self.words[x >> 6]) >> (x & 63) & 1:
                return False
        return True


def _xxhash64(t: int, i: int) -> int:
    """Spark's xxhash64(bigint t, int i), unsigned modulo as pmod gives it."""
    seed = xxhash.xxh64_intdigest(struct.pack("<q", t), 42)
    return xxhash.xxh64_intdigest(struct.pack("<i", i), seed)


_ROW, _MAYBE_TERMS = "_llm_row", "_llm_maybe"


def _masked(docs: DataFrame, finish, schema, min_support: float = 3, generalise_at: float = 0.8, remove_at: float = 0.95,
            z: float = 1.96, broadcast_bytes: int = 8 << 20) -> DataFrame:
    """finish(batch, base spans, term spans) of all batches of ``docs``.

    The disclosing terms are broadcast where their table is measured to be
    small: no text moves. Beyond that, documents meet a Bloom filter of fixed
    size, and only those that may hold a disclosing term meet the table."""
    clash = {_ROW, _MAYBE_TERMS} & set(docs.columns)
    if clash:
        raise ValueError(f"the documents have columns of the operator's own names: {sorted(clash)}")
    spark = docs.sparkSession
    path = fresh_path(spark, "telling")
    telling_terms(corpus_statistics(docs), min_support, generalise_at, z) \
        .select("t", (F.col("share") >= remove_at).alias("removed")).write.parquet(path)
    telling = spark.read.parquet(path)

    def exact(sent):
        def run(batches):
            for batch in batches:
                for rows, texts in tb.chunks(batch):
                    texts = texts.to_pylist()
                    base = list(map(base_spans, texts))
                    yield finish(rows, base, [sent.value.spans(x, s) for x, s in zip(texts, base)])
        return run

    if 9 * telling.count() <= broadcast_bytes:
        held = telling.toArrow()
        known = Telling(held["t"].to_numpy(), held["removed"].to_numpy())
        return docs.mapInArrow(exact(spark.sparkContext.broadcast(known)), schema)

    sieve = spark.sparkContext.broadcast(Sieve.of(telling))
    names = docs.columns

    def sift(batches):
        row, known = TaskContext.get().partitionId() << 32, {}
        for batch in batches:
            for rows, texts in tb.chunks(batch):
                maybe = []
                for text in texts.to_pylist():
                    if len(known) > PART_TERMS:
                        known.clear()
                    words = _terms(text)
                    for w in words - known.keys():
                        known[w] = t if sieve.value.may_hold(t := _number(w)) else None
                    maybe.append([t for w in words if (t := known[w]) is not None])
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(range(row, row + len(maybe)), pa.int64()), pa.array(maybe, pa.list_(pa.int64()))],
                    names=[*names, _ROW, _MAYBE_TERMS])
                row += len(maybe)

    path = fresh_path(spark, "sifted")
    extra = StructType(docs.schema.fields + [StructField(_ROW, LongType()), StructField(_MAYBE_TERMS, ArrayType(LongType()))])
    docs.mapInArrow(sift, extra).write.parquet(path)
    sifted = spark.read.parquet(path)
    found = sifted.select(_ROW, F.explode(_MAYBE_TERMS).alias("t")).join(telling, "t") \
        .groupBy(F.col(_ROW).alias("row")).agg(F.collect_list(F.struct("t", "removed")).alias("found"))

    def one_by_one(batches):
        for batch in batches:
            for rows, texts in tb.chunks(batch):
                texts = texts.to_pylist()
                base, terms = list(map(base_spans, texts)), []
                for x, s, f in zip(texts, base, rows.column(len(names)).to_pylist()):
                    mine = Telling(np.array([y["t"] for y in f or ()], np.int64), np.array([y["removed"] for y in f or ()], bool))
                    terms.append(mine.spans(x, s))
                yield finish(rows.select(range(len(names))), base, terms)

    nothing = spark.sparkContext.broadcast(Telling(np.zeros(0, np.int64), np.zeros(0, bool)))
    clear = sifted.filter(F.size(_MAYBE_TERMS) == 0).select(*names).mapInArrow(exact(nothing), schema)
    some = sifted.filter(F.size(_MAYBE_TERMS) > 0).join(found, F.col(_ROW) == F.col("row"), "left") \
        .select(*(sifted[c] for c in names), "found").mapInArrow(one_by_one, schema)
    return clear.unionAll(some)


def _merged_terms(terms) -> list[tuple[int, int, bool]]:
    """One entry per span; removal wins over generalising."""
    out: dict = {}
    for x in terms or ():
        out[(x["a"], x["b"])] = out.get((x["a"], x["b"]), False) or x["removed"]
    return [(a, b, r) for (a, b), r in sorted(out.items())]


def find_pii(docs: DataFrame, **parameters) -> DataFrame:
    """One row per document: counts by kind, the digest of the base spans,
    and all spans; terms come after the kinds, as ``term:start:end``."""
    def finish(batch, base, terms):
        rows = []
        for spans, extra in zip(base, terms):
            count = dict.fromkeys(KINDS, 0)
            for k, _, _ in spans:
                count[k] += 1
            rows.append([*count.values(), hashlib.sha256(joined(spans).encode()).hexdigest(),
                         joined(spans + [(TERM, x["a"], x["b"]) for x in extra])])
        columns = list(zip(*rows)) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), *[pa.array(c, pa.int64()) for c in columns[:4]],
             *[pa.array(c, pa.string()) for c in columns[4:]]],
            names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return _masked(docs.select("doc_id", "text"), finish,
                   "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                   "base_sha256 string, spans string", **parameters)


def redact(text: str, terms, base=None) -> str:
    """Base spans become [KIND], generalised terms [TERM], removed terms go.
    Spans that overlap become the mark of the first, longest one."""
    pieces = [(a, -b, f"[{k.upper()}]") for k, a, b in (base_spans(text) if base is None else base)]
    pieces += [(a, -b, "" if r else "[TERM]") for a, b, r in _merged_terms(terms)]
    out, at = [], 0
    for a, b, mark in sorted(pieces):
        if a >= at:
            out += [text[at:a], mark]
            at = -b
        else:
            at = max(at, -b)
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs``, all columns, with redacted texts (null stays
    null); n_chars, where there is one, follows the new text."""
    schema, names = docs.schema, docs.columns
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def finish(batch, base, terms):
        col = batch.column(at)
        new = [None if x is None else redact(x, t, s) for x, s, t in zip(col.to_pylist(), base, terms)]
        columns = list(batch.columns)
        columns[at] = pa.array(new, col.type)
        if chars is not None and pa.types.is_integer(columns[chars].type):
            old = columns[chars].to_pylist()
            columns[chars] = pa.array([n if x is None else len(x) for x, n in zip(new, old)], columns[chars].type)
        return pa.RecordBatch.from_arrays(columns, names=names)

    return _masked(docs, finish, schema, **parameters)
