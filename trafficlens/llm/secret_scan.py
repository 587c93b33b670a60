"""Secret scans with character Markov models, in DataFrame functions only.

Base spans (assign, access, hex) come from regular expressions; their
positions are the running lengths of the pieces between matches. Long
tokens are cut where base spans stand in them, and what is left of
``LEAST`` characters or more is a candidate.

Two first-order character models are counted over the whole corpus, each
distinct string once: one of the strings that base matches label as
secrets, one of the candidates that are shaped like ordinary identifiers
(words of one case or camel case or single letters, joined by separators,
a short number behind; or digits and separators alone). Candidates of mixed shape train
neither, so unmarked keys do not teach the ordinary model. A candidate of
any shape whose log-likelihood ratio reaches ``min_ratio`` is added as
``markov``.

Defined cases: a null text is empty and has no spans; without a single
labelled string a model is uniform; repeated rows have
equal results and count once; other columns are ignored. Spans are ordered
by start, then by kind as listed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlens.session import shared_root

KINDS = ("assign", "access", "hex", "markov")
# Fixed patterns. Runs of a character class are found with their least
# length at once, from their first character on; an assignment is matched
# first and measured afterwards.
ASSIGN = r"""(?=[AaPpSsTt])(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
LEAST = 12  # characters of a candidate
TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST},}}"
# what base spans of the other kinds take of a token, and a cheap sign of it
CUT = r"AKIA[A-Z0-9]{14,}[0-9a-f]*+|(?<![0-9a-f])[0-9a-f]{16,}"
# shapes of ordinary tokens; possessive, so that each is read once
ORDINARY = r"^[-+/_=]*+(?:(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[A-Za-z](?![A-Za-z0-9]))[-+/_=]*+)++[0-9]{0,4}+[-+/_=]*+$|^[-+/_=0-9]*+$"
LETTERS = 67  # of TOKEN's alphabet, for smoothing
PRIOR = 8.0  # pairs by which a first letter's distribution leans on that of all letters
GRID = 128  # a pair of ASCII letters is a cell of GRID x GRID


BLOCK = 256  # matches whose positions are added up together


def _let(value: Column, body) -> Column:
    """body(value) with the value worked out once, also inside a lambda."""
    return F.transform(F.array(value), body)[0]


def _running(parts: Column, at: Column, out: Column, width, item) -> Column:
    """The items of ``parts`` with the running total of widths before each;
    null items are left out."""
    return F.aggregate(parts, F.struct(at.alias("at"), out.alias("out")), lambda acc, x: F.struct(
        (acc["at"] + width(x)).alias("at"),
        F.concat(acc["out"], F.array_compact(F.array(item(acc["at"], x)))).alias("out")), lambda acc: acc["out"])


def matches(text: Column, pattern: str, may: Column | None = None) -> Column:
    """array<struct<a, b, m>>: start, end (code points) and text of every
    leftmost non-overlapping match; ``may`` is a cheap necessary condition.

    Running totals copy what they have so far, so they are taken over blocks
    and then within each: a text of many matches stays cheap."""
    rx = F.lit(pattern)
    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, rx, F.lit(0)),
                       lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("m")))
    empty = F.array().cast("array<struct<a:int,b:int,m:string>>")
    width = lambda x: x["gap"] + F.coalesce(F.length(x["m"]), F.lit(0))
    span = lambda at, x: F.when(x["m"].isNotNull(), F.struct(
        (at + x["gap"]).alias("a"), (at + x["gap"] + F.length(x["m"])).alias("b"), x["m"].alias("m")))
    total = lambda block: F.aggregate(block, F.lit(0), lambda s, x: s + width(x))
    blocks = lambda p: F.transform(F.sequence(F.lit(1), F.size(p), F.lit(BLOCK)),
                                   lambda i: F.slice(p, i, F.lit(BLOCK)))
    begins = lambda b: _running(F.transform(b, total), F.lit(0), F.array().cast("array<int>"),
                                lambda w: w, lambda at, w: at)
    found = _let(parts, lambda p: _let(blocks(p), lambda b: F.flatten(F.zip_with(
        b, begins(b), lambda block, at: _running(block, at, empty, width, span)))))
    some = text.rlike(pattern)
    return F.when(some if may is None else may & some, found).otherwise(empty)


def _gaps(text: Column, pattern: str, found: Column) -> Column:
    """array<struct<at, t>>: the pieces of the text between its matches."""
    at = F.concat(F.array(F.lit(0)), F.transform(found, lambda x: x["b"]))
    return F.zip_with(F.split(text, pattern, -1), at, lambda t, a: F.struct(a.alias("at"), t.alias("t")))


def _candidates(text: Column, assigned: Column) -> Column:
    """array<struct<a, b, m>>: what base spans leave of long tokens. Assignments
    are cut out of the text, then hex and access spans, which lie within one
    token, out of each token: nothing is compared with all spans."""
    def within(piece):
        """Tokens of a piece of text, moved to their place."""
        return F.transform(matches(piece["t"], TOKEN), lambda x: F.struct((x["a"] + piece["at"]).alias("at"), x["m"].alias("t")))

    def left(token):
        rest = _let(matches(token["t"], CUT), lambda cuts: F.transform(
            _gaps(token["t"], CUT, cuts), lambda g: F.struct((g["at"] + token["at"]).alias("at"), g["t"].alias("t"))))
        return F.when(token["t"].rlike(CUT), rest).otherwise(F.array(token))

    pieces = F.when(F.size(assigned) > 0, _gaps(text, ASSIGN, assigned)) \
        .otherwise(F.array(F.struct(F.lit(0).alias("at"), text.alias("t"))))
    tokens = F.flatten(F.transform(pieces, within))
    some = F.filter(F.flatten(F.transform(tokens, left)), lambda x: F.length(x["t"]) >= LEAST)
    out = F.transform(some, lambda x: F.struct(x["at"].alias("a"), (x["at"] + F.length(x["t"])).alias("b"), x["t"].alias("m")))
    return F.when(text.rlike(TOKEN), out).otherwise(F.array().cast("array<struct<a:int,b:int,m:string>>"))


def _found(docs: DataFrame) -> DataFrame:
    """doc_id, the match arrays of every kind, and the candidates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    value = lambda m: F.regexp_extract(m, ASSIGN, 2)
    got = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", matches(F.col("text"), ASSIGN, F.col("text").contains(":") | F.col("text").contains("=")).alias("all"),
        matches(F.col("text"), ACCESS, F.col("text").contains("AKIA")).alias("access"),
        matches(F.col("text"), HEX).alias("hex"))
    return got.select("doc_id", F.filter("all", lambda x: F.length(value(x["m"])) >= LEAST).alias("assign"), "access", "hex",
                      _candidates(F.col("text"), F.col("all")).alias("token"))


def _pairs(token: Column) -> Column:
    """The cells of the token's letter pairs."""
    return _let(F.transform(F.split(token, "(?<=.)(?=.)"), F.ascii), lambda codes: F.zip_with(
        F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1),
        lambda x, y: x * GRID + y))


def markov_ratios(found: DataFrame) -> list[float]:
    """log P(b | a, secret) - log P(b | a, ordinary) by cell.

    Counted over all rows, a distinct string once; one number a letter pair
    reaches the driver."""
    secret = F.transform(F.concat(F.transform("assign", lambda x: F.regexp_extract(x["m"], ASSIGN, 2)),
                                  F.transform("access", lambda x: x["m"]), F.transform("hex", lambda x: x["m"])),
                         lambda m: F.struct(F.lit(1).alias("secret"), m.alias("m")))
    plain = F.transform(F.filter("token", lambda x: x["m"].rlike(ORDINARY)),
                        lambda x: F.struct(F.lit(0).alias("secret"), x["m"].alias("m")))
    counts = found.select(F.explode(F.concat(secret, plain)).alias("s")).select("s.secret", "s.m").distinct() \
        .select("secret", F.explode(_pairs(F.col("m"))).alias("cell")) \
        .groupBy("cell").agg(F.sum("secret").alias("k1"), F.sum(1 - F.col("secret")).alias("k0"))
    found_cells = counts.collect()  # at most a row a cell
    models = [transition_logs({r.cell: n for r in found_cells if (n := r[k])}) for k in ("k1", "k0")]
    return [x - y for x, y in zip(*models)]


def transition_logs(cells: dict[int, int]) -> list[float]:
    """log P(b | a) by cell from counts of letter pairs: ``PRIOR`` pairs of each
    first letter are spread like the letters of all pairs, which count one more
    each."""
    first, second = [0] * GRID, [0] * GRID
    for cell, n in cells.items():
        first[cell // GRID] += n
        second[cell % GRID] += n
    total = sum(second) + LETTERS
    return [math.log((cells.get(cell, 0) + PRIOR * (second[cell % GRID] + 1) / total) / (first[cell // GRID] + PRIOR))
            for cell in range(GRID * GRID)]


def scan_secrets(docs: DataFrame, min_ratio: float = 12.0) -> DataFrame:
    """doc_id, counts by base kind, digest of the base spans, all spans and
    the added tokens with their ratios."""
    shared_root(docs.sparkSession)
    found = _found(docs).checkpoint()  # a few long tokens a document; the texts are read once
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in markov_ratios(found))), ",").cast("array<double>")
    ratio = lambda m: F.aggregate(_pairs(m), F.lit(0.0), lambda s, c: s + F.element_at(table, c + 1))
    scored = F.filter(F.transform("token", lambda x: F.struct(x["a"], x["b"], ratio(x["m"]).alias("ratio"))),
                      lambda x: x["ratio"] >= min_ratio)
    tagged = lambda c, k: F.transform(c, lambda x: F.struct(
        x["a"].alias("a"), F.lit(k).alias("kind"), x["b"].alias("b")))
    written = lambda spans: F.concat_ws(",", F.transform(F.array_sort(spans), lambda x: F.concat(
        F.element_at(F.array(*map(F.lit, KINDS)), x["kind"]), F.lit(":"), x["a"].cast("string"),
        F.lit(":"), x["b"].cast("string"))))
    base = F.concat(tagged("assign", 1), tagged("access", 2), tagged("hex", 3))
    return found.withColumn("added", scored).select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.concat(base, tagged("added", 4))).alias("spans"), "added")
