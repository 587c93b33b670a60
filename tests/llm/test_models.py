"""Classifiers on held-out rows, secret scan, pieces, registered queries."""

import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

from tests.oracle_compare import compare, duck
from trafficlens.llm import pieces as P
from trafficlens.llm import queries as Q
from trafficlens.llm.quality import quality_model, score_quality
from trafficlens.llm.secret_scan import HEX, matches, scan_secrets
from trafficlens.llm.toxicity import drop_toxic, score_toxicity, toxicity_model
from trafficlens.sources.bindings import table

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.01")
ODD = [(-1, None), (-2, ""), (-3, " \n"), (-4, "é" * 40_000), (-5, "the " * 60_000), (None, "no id"), (-6, "twice"), (-6, "twice")]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id bigint, text string").selectExpr("*", "1 as score", "'en' as lang")


@pytest.mark.parametrize("target,fit,score,least", [("toxic", toxicity_model, score_toxicity, 0.75),
                                                    ("quality", quality_model, score_quality, 0.95)])
def test_classifier(spark, target, fit, score, least):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = fit(docs, labels)
    rows = score(docs, model).join(labels, "doc_id").filter("held_out").select("score", target).collect()
    good, bad = [r.score for r in rows if r[target] == 1], [r.score for r in rows if r[target] == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc >= least, auc
    got = score(odd(spark), model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    assert len({r.score for r in got if r.doc_id == -6}) == 1
    assert score(odd(spark).limit(0), model).count() == 0
    assert score(odd(spark), fit(docs, labels.limit(0))).count() == len(ODD)  # nothing to learn from
    if target == "toxic":
        assert drop_toxic(odd(spark), model).columns == ["doc_id", "text", "score", "lang"]


def test_secrets(spark):
    digests = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(240)]
    hexes = [f"token = '{h.upper() if i % 2 else h}'" for i, h in enumerate(digests)]
    ordinary = [(i, f"the ordinary_identifier_name_{'abcdefgh'[i % 8]} of SomeLongClassNameHere {h}") for i, h in enumerate(hexes)]
    rows = ordinary + [(1000, "key 9F3A77C01BD2E84455AA0F6E7D81C3B2 é"), (1001, None), (1002, ""), (1003, "AKIA" + "Z9" * 8),
                       (1003, "AKIA" + "Z9" * 8), (None, "é password:abcdefghijkl Secret= 'short' api_key"), (1004, "x" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as token", "2 as hex")
    kinds = ("assign", "access", "hex")
    found = scan_secrets(df).collect()
    by = {r.doc_id: r for r in found}
    for doc_id, text in rows:
        t, r = text or "", by[doc_id]
        spans = [(m.start(), 0, m.end()) for m in re.finditer(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A)
            if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        want = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == q for _, k, _ in spans) for q in range(3)]
    assert by[1000].spans == "markov:4:36" and by[0].n_assign == by[0].n_hex == 1
    assert all("markov" not in by[i].spans for i in range(240))
    assert scan_secrets(df.limit(0)).count() == 0


def keys(n, length=32, seed=5):
    import random
    rng = random.Random(seed)
    return ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=length)) for _ in range(n)]


IDENTIFIERS = [f"{a}{b}{c}" for a in ("get", "user_account_", "HTTP", "max-", "Parse", "on") for b in ("Request", "handler_", "Connection", "value-")
               for c in ("Factory", "count", "Listener", "per_second", "index2", "Exception")] + ["2024-05-12-10-30-59", "123-456-789-012", "200000000000"]


@pytest.mark.parametrize("unmarked,marked", [(30, 300), (600, 300)])
@pytest.mark.parametrize("length", [32, 20])
def test_unmarked_keys_are_found(spark, unmarked, marked, length):
    """Recall of random keys without a marker, and false spans on identifiers."""
    loose, known = keys(unmarked, length, 1), keys(marked, length, 2)
    rows = [(i, f"use {k} here") for i, k in enumerate(loose)] + [(10_000 + i, f"api_key = '{k}'") for i, k in enumerate(known)]
    rows += [(20_000 + i, f"call {w} now then") for i, w in enumerate(IDENTIFIERS)]
    got = {r.doc_id: r for r in scan_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    found = sum(f"markov:4:{4 + length}" in got[i].spans for i in range(unmarked))
    assert found >= 0.9 * unmarked
    assert all("markov" not in got[10_000 + i].spans for i in range(marked))
    wrong = sum("markov" in got[20_000 + i].spans for i in range(len(IDENTIFIERS)))
    assert wrong <= 0.01 * len(IDENTIFIERS)


def test_the_part_outside_base_spans_is_scored(spark):
    """A hex digest with a key behind it, keys around an assignment; the models
    recomputed from the definition."""
    key = keys(1, 32)[0]
    digest = hashlib.sha1(b"x").hexdigest()[:17]
    marked = [f"password: {k}" for k in keys(100, 24, 3)]
    words = [f"{w} and {w}_again" for w in IDENTIFIERS]
    texts = [f"{digest}-{key}", f"{key}_token={keys(1, 20, 4)[0]}", f"é {key[:14]} {key[:11]}", f"AKIA{'Q7' * 8}{digest}"] + marked + words
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in scan_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0].spans == f"hex:0:17,markov:17:{17 + 33}" and got[1].spans == f"markov:0:33,assign:33:{33 + 26}"
    assert got[2].spans == "markov:2:16" and got[3].spans.startswith("access:0:") and "markov" not in got[3].spans
    # ratios by the definition
    import math
    from collections import Counter
    secret = {digest, keys(1, 20, 4)[0], *keys(100, 24, 3)} | {
        m for t in texts for kind in (r"AKIA[A-Z0-9]{14,}", r"[0-9a-f]{16,}") for m in re.findall(kind, t)}
    shape = re.compile(r"[-+/_=]*((?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[A-Za-z](?![A-Za-z0-9]))[-+/_=]*)+[0-9]{0,4}[-+/_=]*|[-+/_=0-9]*")
    plain = {m for t in words for m in re.findall(r"[A-Za-z0-9+/_=-]{12,}", t) if shape.fullmatch(m)}
    models = []
    for strings in (secret, plain):
        pairs = Counter(x for s in strings for x in zip(s, s[1:]))
        first, second = (Counter(x[k] for s in strings for x in zip(s, s[1:])) for k in (0, 1))
        total = sum(second.values()) + 67
        models.append(lambda a, b, p=pairs, f=first, s=second, t=total: math.log((p[a, b] + 8 * (s[b] + 1) / t) / (f[a] + 8)))
    want = sum(models[0](a, b) - models[1](a, b) for a, b in zip("-" + key, key))
    assert abs(got[0].added[0].ratio - want) < 1e-3


def test_many_assignments_in_one_text(spark):
    import time
    text = " ".join(f"token={k} and_some_identifier" for k in keys(8000, 20))
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    scan_secrets(df.limit(0)).count()
    began = time.time()
    r = scan_secrets(df).first()
    assert r.n_assign == 8000 and "markov" not in r.spans and time.time() - began < 60


def test_positions_of_many_matches(spark):
    """More matches than a block of running totals."""
    text = "é ".join(hashlib.sha1(str(i).encode()).hexdigest() for i in range(700))
    got = spark.createDataFrame([(text,), ("",)], "text string").select(matches(F.col("text"), HEX).alias("s")).collect()
    assert [(x.a, x.b, x.m) for x in got[0].s] == [(*m.span(), m[0]) for m in re.finditer("[0-9a-f]{16,}", text)]
    assert got[1].s == []


def unigram_model():
    """A small unigram model put together by hand."""
    from sentencepiece import sentencepiece_model_pb2 as proto
    m = proto.ModelProto()
    for piece, score, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [(f"<0x{b:02X}>", 0, 6) for b in range(256)] + [
            ("▁", -3, 1), ("▁the", -1, 1), ("t", -5, 1), ("h", -5, 1), ("e", -4, 1), ("he", -3.5, 1), ("▁▁", -4, 1)]:
        m.pieces.add(piece=piece, score=score, type=kind)
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback, m.trainer_spec.unk_id = 1, True, 0
    m.normalizer_spec.add_dummy_prefix = m.normalizer_spec.escape_whitespaces = True
    m.normalizer_spec.remove_extra_whitespaces = False
    return m.SerializeToString()


@pytest.mark.parametrize("model", [P.read_model(Q.MODEL), unigram_model()], ids=["bpe", "unigram"])
def test_pieces(spark, model):
    import sentencepiece
    theirs = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = ["the het the", "  a  b ", "<s> x </s>", "a\0b", "日本語 😀", "\n\n\t x", "▁x", "", None, "e" * 30_000, "the", "the"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "1 as ids")
    enc = P.encode(df, model)
    got = {r.doc_id: r for r in enc.collect()}
    for i, t in enumerate(texts):
        assert got[i].ids == theirs.encode(t or "") and got[i].n_tokens == len(got[i].ids) and got[i].parity
        assert got[i].round_trip == ("▁" not in (t or ""))
    back = {r.doc_id: r.text for r in P.decode(enc, model).collect()}
    assert all(back[i] == theirs.decode(theirs.encode(t or "")) for i, t in enumerate(texts))
    assert P.encode(df.limit(0), model).count() == 0


@pytest.mark.parametrize("key", sorted(Q.ORACLE))
def test_oracle(spark, key):
    sf = "/root/testdata/sf0.001"
    df = Q.QUERIES[key](spark, sf)
    res = duck(sf).execute(Q.ORACLE[key])
    verdict = compare([tuple(r) for r in df.collect()], df.columns, res.fetchall(), [d[0] for d in res.description])
    assert verdict.startswith("ok"), verdict


def test_stages_on_odd_rows(spark):
    """Nulls, empty and long texts, repeated rows, clashing columns, stage by stage."""
    import corpus_pipeline as C
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    strange = [(-1, None, "en", None, None), (-2, "", None, "s", 0), (-3, " \n", "en", "s", 2), (-4, "é wort " * 20_000, "de", "s", 140_000),
               (None, "no id at all, call +1 (555) 123-4567", "en", "s", 36), (-6, "twice the very same words here", "en", "s", 30),
               (-6, "twice the very same words here", "en", "s", 30), (None, None, None, None, None)]
    odd_docs = spark.createDataFrame(strange, docs.schema).unionByName(docs) \
        .selectExpr("*", "1 as score", "'x' as fp", "2 as spans", "doc_id as row", "3 as component_id").checkpoint()
    model = toxicity_model(odd_docs, table(spark, sf, "labels"))
    kept = C.toxicity(spark, odd_docs, sf)
    assert kept.columns == odd_docs.columns
    scored = [(r.doc_id, r.predicted) for r in score_toxicity(odd_docs, model).collect()]
    left = [r.doc_id for r in kept.collect()]
    assert sorted(left, key=str) == sorted((i for i, bad in scored if not bad), key=str)  # what is judged toxic goes
    one = C.near_duplicates(spark, odd_docs, sf)
    got = one.collect()
    assert one.columns == odd_docs.columns and sum(r.doc_id == -6 for r in got) == 1
    assert sum(not (r.text or "").strip() for r in got if (r.doc_id or -1) < 0) == 1  # the group of fingerprint zero
    clean = C.decontamination(spark, odd_docs, sf)
    assert clean.columns == odd_docs.columns and {r.doc_id for r in clean.collect()} >= {-1, -2, -3, -4, -6, None}
    masked = C.pii(spark, odd_docs, sf)
    by = {(r.doc_id, r.lang): r for r in masked.collect()}
    assert masked.columns == odd_docs.columns and masked.count() == odd_docs.count()
    assert by[None, "en"].text == "no id at all, call [PHONE]" and by[-1, "en"].text is None and by[None, None].n_chars is None
    assert by[-4, "de"].n_chars == 140_000 and by[-4, "de"].score == 1
    pieces = C.sentencepiece(spark, odd_docs, sf)
    assert pieces.count() == odd_docs.count() and pieces.filter("doc_id < 0 and n_tokens = 0").count() == 2


def test_pipeline(spark):
    import corpus_pipeline as C
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    out = C.run(spark, sf)
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "sentencepiece"]
    assert 0 < out.count() <= docs.count() and out.filter("not parity").count() == 0
    empty = docs.limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, empty, sf).count() == 0
