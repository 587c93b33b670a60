"""Packing: pieces against the tokenizer library, the plan against its rules."""

import struct
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from trafficlens.llm import packing as K
from trafficlens.llm import queries as Q

SPEC = open(Q.WORD_TOKENIZER).read()
TEXTS = [(1, "Hello, it's 12 o'clock\n\t\x1cÉcole  ǅ é fi"), (2, None), (3, ""), (4, "  "), (5, "a <|endoftext|> b<|startoftext|>c"),
         (6, "word " * 5000), (6, "word " * 5000), (None, "no id"), (7, "x" * 30_000), (8, "日本語 😀"), (9, " ".join(map(str, range(1500))))]


def expected(texts, capacity):
    core = Tokenizer.from_str(SPEC)
    out = []
    for doc_id, text in texts:
        ids = core.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = ids[k:k + capacity]
            out.append((doc_id, k // capacity, k, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    return out


def check_places(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at  # gapless from 0
            at += length
        assert at <= capacity
    return len(bins)


def key(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("capacity", [2048, 7])
def test_defined_cases(spark, capacity):
    df = spark.createDataFrame(TEXTS, "doc_id bigint, text string").selectExpr("*", "1 as piece", "2 as length").repartition(3)
    rows = K.pack(df, SPEC, capacity, ids=True).collect()
    assert key([tuple(r)[:5] for r in rows]) == key(expected(TEXTS, capacity))
    n = check_places(rows, capacity)
    total = sum(r.length for r in rows)
    assert -(-total // capacity) <= n <= -(-total // capacity) + 1
    whole = {r.sequence_id: list(r.ids) for r in K.sequences(spark.createDataFrame(rows)).collect()}
    assert all(whole[r.sequence_id][r.offset:r.offset + r.length] == list(r.ids) for r in rows)
    assert K.pack(df.limit(0), SPEC).count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = Q.op12_packing(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert key([tuple(r)[:5] for r in rows]) == key(expected(docs, 2048))
    total = sum(r.length for r in rows)
    assert check_places(rows, 2048) <= -(-total // 2048) + 1


def held(bins):
    out = Counter()
    for pattern, n in bins.items():
        for length, copies in pattern:
            out[length] += copies * n
    return out


def gains(bins, capacity):
    """Exchanges between two bins that raise the squared fill, by trying all."""
    flat = [[length for length, copies in p for _ in range(copies)] for p, n in bins.items() if K._fill(p) < capacity
            for _ in range(min(n, 2))]
    for i, x in enumerate(flat):
        for j, y in enumerate(flat):
            if i == j:
                continue
            ones = lambda b: [(a,) for a in b]
            for give, back in [(g, b) for g in ones(y) for b in [(), *ones(x), *combinations(x, 2)]] + \
                    [(g, b) for g in combinations(y, 2) for b in ones(x)]:
                net = sum(give) - sum(back)
                if 0 < net <= capacity - sum(x) and net > sum(y) - sum(x):
                    return x, y, give, back
    return None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_plan(lengths):
    want = Counter(lengths)
    first = K.best_fit(want, 40)
    bins = K.local_search(first, 40)
    assert held(first) == held(bins) == want and all(K._fill(p) <= 40 for p in bins)
    assert sum(bins.values()) <= sum(first.values())
    assert gains(bins, 40) is None  # a local optimum under the three kinds of exchange
    places = K.Places(bins)
    seen = defaultdict(list)
    for length, n in want.items():
        import numpy as np
        b, o = places.of(np.full(n, length), np.arange(n))
        for x, y in zip(b.tolist(), o.tolist()):
            seen[x].append((y, length))
    for at in seen.values():
        assert [o for o, _ in sorted(at)] == [sum(n for _, n in sorted(at)[:i]) for i in range(len(at))]


def test_search_empties_bins():
    """Best fit needs 3 bins of 10 for 6 5 | 4 3 | 2 ..., exchanges save one."""
    bins = Counter({((6, 1), (3, 1)): 1, ((5, 1), (4, 1)): 1, ((2, 1),): 1})
    assert sum(K.local_search(bins, 10).values()) == 2


def test_word_by_word_needs_a_tokenizer_that_drops_space():
    import json
    assert K.drops_space(json.loads(SPEC))
    assert not K.drops_space(json.load(open("/opt/tokenizers/byte_bpe_50k.json")))
