"""Contamination against brute force, with one and with several blocks."""

import hashlib
import re

import numpy as np
import pytest

from trafficlens.llm.contamination import find_contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        q = words(t)
        size = min(len(q), window)
        grams = {tuple(q[i:i + size]) for i in range(len(q) - size + 1)} if size else set()
        for i in range(len(w)):
            if tuple(w[i:i + size]) in grams and size and i + size <= len(w):
                hit |= set(range(i, i + size))
                found.add(item)
    ids = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
    return len(w), len(hit), len(found), ids, bool(hit) and 20 * len(hit) >= len(w)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    say = lambda n: " ".join(rng.choice(["A", "b", "Ça", "9", "d"], n))
    items = [(k, say(rng.integers(3, 9))) for k in range(12)] + [(3, "b 9"), (20, None), (21, "- !"), (22, "b 9")]
    docs = [(i, say(rng.integers(0, 40))) for i in range(80)]
    docs += [(90, None), (91, ""), (92, items[0][1]), (92, items[0][1]), (None, items[1][1]),
             (93, "z " * 60_000 + (items[2][1] or ""))]
    return docs, items


@pytest.mark.parametrize("block", [200_000, 8])
def test_matches_brute_force(spark, rows, block):
    docs, items = rows
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as n_hit", "2 as items")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = find_contamination(df, bench, window=4, block_words=block).collect()
    have = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got)
    assert have == sorted((str(i), *brute(t, items, 4)) for i, t in docs)
    kept = find_contamination(df, bench, window=4, block_words=block, keep_clean=True)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(x[0] for x in have if not x[5])


def test_empty_tables(spark, rows):
    docs = spark.createDataFrame(rows[0], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert find_contamination(docs, none).filter("n_hit > 0 or contaminated").count() == 0
    assert find_contamination(docs.limit(0), none).count() == 0
