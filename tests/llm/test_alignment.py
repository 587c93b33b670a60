"""Alignment against a plain version on whole texts, galloping against sets."""

import hashlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from trafficlens.llm import alignment as A
from trafficlens.llm import queries as Q
from trafficlens.llm.pieces import read_model

SPEC, MODEL = read_model(Q.BYTE_TOKENIZER).decode(), read_model(Q.MODEL)
ODD = [(1, "The quick brown fox,  jumps over.\n\nA line"), (2, None), (3, ""), (4, " "), (5, "a "), (6, "  a   b \t c"),
       (7, "▁marker here"), (8, "some ▁ marker"), (9, "<|endoftext|> and <s> </s> <0x41> <unk>"), (10, "日本語 😀 naïve ñandú"),
       (11, "x" * 20_000), (12, "the the the"), (12, "the the the"), (None, "no id the"), (13, "a\x1cb \x85 　c\0d"),
       (14, "ab" * 3000 + " " + "the " * 3000)]


def plain(texts):
    """groups string, counts and links of whole texts, token by token."""
    core = Tokenizer.from_str(SPEC)
    core.encode_special_tokens = True
    theirs = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    letters = A.byte_alphabet()
    out = []
    for text in texts:
        want = b" " + (text or "").encode()
        a = core.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = theirs.encode(text) if text else []
        spell_a = [bytes(letters[c] for c in core.id_to_token(i)) for i in a]
        spell_b = [bytes([int(theirs.id_to_piece(i)[3:5], 16)]) if theirs.is_byte(i)
                   else theirs.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(spell_a) == b"".join(spell_b) == want:
            out.append(("", [], 0, 0))
            continue
        ends_a, ends_b = list(accumulate(map(len, spell_a))), list(accumulate(map(len, spell_b)))
        cuts = sorted(set(ends_a) & set(ends_b))
        slices, i, j = [], 0, 0
        for c in cuts:
            i2, j2 = ends_a.index(c) + 1, ends_b.index(c) + 1
            slices.append((a[i:i2], b[j:j2]))
            i, j = i2, j2
        out.append((";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in slices), slices, len(a), len(b)))
    return out


def expected(rows):
    found = plain([t for _, t in rows])
    n = Counter()
    for _, slices, *_ in found:
        n.update({(x, y) for a, b in slices for x in a for y in b})
    top = defaultdict(int)
    for (x, _), v in n.items():
        top[x] = max(top[x], v)
    out = []
    for (doc_id, _), (said, slices, n_a, n_b) in zip(rows, found):
        links = Counter()
        for a, b in slices:
            for x, k in Counter(a).items():
                for y, m in Counter(b).items():
                    links[x, y] += k * m
        out.append((doc_id, n_a, n_b, len(slices), sum(links.values()), sum(k for (x, y), k in links.items() if n[x, y] == top[x]),
                    sum(k * n[p] for p, k in links.items()), hashlib.sha256(said.encode()).hexdigest() if said else ""))
    return out


def key(rows):
    return sorted(map(tuple, rows), key=repr)


def test_alphabet():
    assert set(A.byte_alphabet()) == set(ByteLevel.alphabet()) and sorted(A.byte_alphabet().values()) == list(range(256))


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 200)), st.sets(st.integers(1, 200)), st.integers(0, 5))
def test_galloping(x, y, back):
    a, b = np.array(sorted(x), np.int64), np.array(sorted(y), np.int64)
    i, j = A.common_ends(a, b)
    want = sorted(x & y)
    assert a[i].tolist() == want == b[j].tolist()
    targets = np.arange(0, 203)
    first = np.searchsorted(a, targets)
    assert (A.gallop(a, targets, np.maximum(first - back, 0)) == first).all()


def test_defined_cases(spark):
    df = spark.createDataFrame(ODD, "doc_id bigint, text string").selectExpr("*", "1 as chunk", "2 as codes", "3 as pairs")
    want = key(expected(ODD))
    assert key(A.align_digests(df.repartition(3), SPEC, MODEL).collect()) == want
    assert key(A.align_digests(df.coalesce(1), SPEC, MODEL).collect()) == want
    assert A.align_digests(df.limit(0), SPEC, MODEL).count() == 0
    got = {r.doc_id: [(list(g.a), list(g.b)) for g in r.groups] for r in A.align(df, SPEC, MODEL).collect()}
    assert all(got[i] == slices for (i, _), (_, slices, *_) in zip(ODD, plain([t for _, t in ODD])))


def test_small_chunks_and_caches(spark, monkeypatch):
    """Many chunks of one task and a cache that is emptied between them."""
    rows = [(i, t) for i, t in enumerate([t for _, t in ODD] * 2)]
    batch = __import__("pyarrow").RecordBatch.from_pydict({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    monkeypatch.setattr(A, "CACHE", 3)
    aligner, seen = A.Aligner(SPEC, MODEL), []
    for part, texts in A.tb.chunks(batch, limit=100):
        for out in A._chunk(aligner, 0, part.column(0), texts.to_pylist()):
            seen += [r for r in out.to_pylist() if r["codes"] is None]
    want = {r[0]: r for r in expected(rows)}
    assert all(want[r["doc_id"]][1:5] == (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) and
               want[r["doc_id"]][7] == r["groups_sha256"] for r in seen) and len(seen) == len(rows)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert key(Q.op11_alignment(spark, sf).collect()) == key(expected(rows))
