"""SimHash groups, line dedup and the repetition rules against brute force."""

import re

import numpy as np
import pytest
import xxhash

from trafficlens.llm import suffixes
from trafficlens.llm.simhash import ball_masks, keep_one, near_duplicates
from trafficlens.llm.unit_dedup import remove_repeats


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def brute_print(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints, ids, distance=2):
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    low = {g: min((x for x, h in zip(ids, group) if h == g and x is not None), default=None) for g in group}
    return [low[g] for g in group]


def corpus(seed=3, n=120):
    rng = np.random.default_rng(seed)
    base = [" ".join(rng.choice(["Aa", "b,", "c", "dé", "e", "F", "g\t", "h"], rng.integers(3, 9))) for _ in range(n // 4)]
    rows = [(i, base[rng.integers(len(base))] + (" x" if rng.random() < .3 else "")) for i in range(n)]
    return rows + [(500, None), (501, ""), (502, " \n\t "), (503, "one"), (504, "ONE"), (503, "one"),
                   (None, "lone words here"), (505, "word " * 70_000)]


def test_groups_match_brute_force(spark):
    rows = corpus()
    df = docs(spark, rows).selectExpr("*", "'z' as fp", "1 as component_id", "2 as root")
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in near_duplicates(df).collect()), key=str)
    prints = [brute_print(t) for _, t in rows]
    want = sorted(zip([i for i, _ in rows], prints, brute_groups(prints, [i for i, _ in rows])), key=str)
    assert got == want


def test_chain_of_links_is_one_group():
    """Fingerprints two bits apart, end to end, reach each other."""
    masks = set(ball_masks(2))
    assert len(masks) == 65 and 0 in masks and all(bin(m % 2**64).count("1") <= 1 for m in masks)


@pytest.mark.parametrize("limit", [0, 8 << 20])
def test_keep_one_keeps_one_of_each_group(spark, limit):
    rows = corpus()
    df = docs(spark, rows).selectExpr("*", "doc_id as n_chars")
    kept = keep_one(df, broadcast_bytes=limit).collect()
    prints = [brute_print(t) for _, t in rows]
    group = brute_groups(prints, [i for i, _ in rows])
    assert kept[0].asDict().keys() == {"doc_id", "text", "n_chars"}
    assert sorted((r.doc_id for r in kept), key=str) == sorted(set(group), key=str)


def test_no_documents(spark):
    assert near_duplicates(docs(spark, [])).count() == 0
    assert keep_one(docs(spark, [])).count() == 0
    assert remove_repeats(docs(spark, [])).count() == 0


def brute_dedup(rows, min_run):
    """The rows in rank order, one unit after the other."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        parts, at = [], 0
        for m in re.finditer(r"(?s).*?(?:[.!?]+['\")\]]*[ \t]+|\n|\Z)[ \t-\r]*", text or ""):
            if m.end() > at:
                parts.append((at, m.end()))
                at = m.end()
        norm = [tuple(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text[x:y]))) for x, y in parts]
        later = []
        for words in norm:
            later.append(bool(words) and words in seen)
            seen.add(words)
        gone, n = set(), 0
        while n < len(parts):
            end = n
            while end < len(parts) and later[end]:
                end += 1
            if sum(map(len, norm[n:end])) >= min_run:
                gone |= set(range(n, end))
            n = max(end, n + 1)
        out.append((str(doc_id), "".join(text[x:y] for i, (x, y) in enumerate(parts) if i not in gone), len(parts), len(gone),
                    ",".join(f"{x}:{y}" for i, (x, y) in enumerate(parts) if i in gone)))
    return sorted(out)


def test_unit_dedup(spark):
    one, two, three = "A line of six  whole words. ", "quite another sentence\twith é words! ", 'He said "go." '
    rows = [(1, f"{two}{three}short\na  LINE of six\twhole words.\n"), (2, f"x\n{one}{two}{three}\n\n tail 3.5 e.g.no"),
            (3, f"{one}{two}"), (3, f"{one}{two}"), (3, f"{one}{two}"), (4, None), (5, ""), (None, two + one), (None, two + one),
            (6, "w " * 50_000 + "\nend"), (7, "\n\n" + one + "new " + two + "Single. " * 40), (8, " \n "), (9, "same. " * 9)]
    rng = np.random.default_rng(2)
    pool = [" ".join(rng.choice(list("abcdefgh"), rng.integers(1, 6))) + rng.choice([". ", "\n", "! "]) for _ in range(25)]
    rows += [(100 + i, "".join(rng.choice(pool, rng.integers(0, 12)))) for i in range(60)]
    df = docs(spark, rows).selectExpr("*", "1 as row", "2 as later", "3 as h", "4 as words").repartition(4)
    for least in (1, 8, 30):
        got = sorted((str(r.doc_id), r.text, r.n_units, r.n_removed, r.removed_spans) for r in remove_repeats(df, least).collect())
        assert got == brute_dedup(rows, least)


def test_suffix_repeats_match_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(60):
        rows = np.sort(rng.integers(0, 3, rng.integers(0, 90)))
        words = rng.integers(0, rng.integers(1, 4), len(rows)).astype(np.uint64)
        pos, length = suffixes.longest_repeats(words, rows, 4)
        want = {}
        for i in range(len(words)):
            best = 0
            for j in range(len(words)):
                k = 0
                while i != j and max(i, j) + k < len(words) and rows[i + k] == rows[j + k] == rows[i] == rows[j] \
                        and words[i + k] == words[j + k]:
                    k += 1
                best = max(best, k)
            if best >= 4:
                want[i] = best
        assert dict(zip(pos.tolist(), length.tolist())) == want
