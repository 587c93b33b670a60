"""PII spans against the plain patterns; disclosure by co-occurrence."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from trafficlens.llm import disclosure as D
from trafficlens.llm.disclosure import base_spans, find_pii, joined, luhn, redact, sanitise

CARD = "4111 1111 1111 1111"


def brute(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_spans_match_the_plain_patterns():
    rng = random.Random(4)
    parts = ["a.b@c.de", "@", "x@y", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", CARD, "4111-1111-1111-1112", "+1 (555) 123-4567",
             "+12", " ", "é", ".", "-", "9", "@d.e@f.g", "%+", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert base_spans(text) == brute(text), text


def test_long_runs_stay_linear():
    for text in ("1" * 200_000, "a" * 200_000, "@" * 100_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000):
        base_spans(text)


def filler(i, n=40):
    """Words of a document's own, so that documents are no copies of each other."""
    rng = random.Random(i)
    return " ".join("".join(rng.choices("bcdfglmnoprstuw", k=9)) for _ in range(n))


def corpus(spark):
    rows = [(i, f"call Zorblax now at zor@bax.example please, {'odd' if i % 2 else 'even'} day. {filler(i)}") for i in range(40)]
    rows += [(100 + i, f"please call me now, it is an {'odd' if i % 2 else 'even'} day. {filler(100 + i)}") for i in range(800)]
    rows += [(60, None), (61, ""), (62, f"card {CARD} alone"), (62, f"card {CARD} alone"), (None, "+1 (555) 123-4567"),
             (63, "word " * 60_000 + "8.8.8.8")]
    rows += [(2000 + i, f"copied words of gruntig@copy.example {filler(9999)}{' x' * (i % 5)}") for i in range(60)]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), dict(rows)


def test_find_pii(spark):
    df, text = corpus(spark)
    got = {}
    for r in find_pii(df.selectExpr("*", "1 as key", "'x' as spans")).collect():
        want = brute(text[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        assert r.spans.startswith(joined(want))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == q for k, _, _ in want)
                                                           for q in ("email", "ip", "card", "phone")]
        got[r.doc_id] = r.spans
    # every document of Zorblax holds the address; "call", "now", "please" are common
    assert all("term:5:12" in got[i] and "term:0:4" not in got[i] for i in range(40))
    assert "term" not in got[100] and got[60] == got[61] == ""
    assert all("term" not in got[2000 + i] for i in range(60))  # copies are one piece of evidence
    assert find_pii(df.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [0, 8 << 20])
def test_sanitise(spark, limit):
    df, text = corpus(spark)
    df = df.selectExpr("*", "length(text) as n_chars", "1 as lang")
    got = {r.doc_id: r for r in sanitise(df, broadcast_bytes=limit).collect()}
    assert got[0].text == f"call  now at [EMAIL] please, even day. {filler(0)}" and got[0].n_chars == len(got[0].text)
    assert got[62].text == "card [CARD] alone"  # repeated rows are one piece of evidence
    assert got[None].text == "[PHONE]" and got[60].text is None
    assert got[100].text == text[100] and got[63].text.endswith("[IP]") and got[0].lang == 1
    assert sanitise(df.limit(0)).count() == 0


def test_overlapping_spans():
    assert redact("x 1.2.3.4 y", [{"a": 2, "b": 5, "removed": False}]) == "x [IP] y"


@pytest.mark.parametrize("limit", [0, 8 << 20])
def test_a_disclosing_term_is_masked_wherever_it_stands(spark, limit):
    rows = [(i, f"Quibbly wrote\nzor@bax.example for Zorblax{' again' * (i % 2)}\n\nzorblax it is\n{filler(i)}") for i in range(60)]
    rows += [(100, "only Zorblax, without the address"), (101, "nobody here")]
    rows += [(200 + i, f"wrote again for it, only without the address here {filler(200 + i, 5)}") for i in range(2000)]
    df, text = spark.createDataFrame(rows, "doc_id bigint, text string"), dict(rows)
    got = {r.doc_id: r.text for r in sanitise(df, broadcast_bytes=limit).collect()}
    # 61 documents hold Zorblax, 60 of them the address; Quibbly stands on the line above it
    assert got[0] == f" wrote\n[EMAIL] for \n\n it is\n{filler(0)}"
    assert got[100] == "only , without the address" and got[101] == "nobody here" and got[200] == text[200]
    spans = {r.doc_id: r.spans for r in find_pii(df, broadcast_bytes=limit).collect()}
    assert spans[0] == "email:14:29,term:0:7,term:34:41,term:43:50" and spans[100] == "term:5:12"
    assert spans[101] == spans[200] == ""
    # between the two bounds a term is generalised
    got = {r.doc_id: r.text for r in sanitise(df, broadcast_bytes=limit, remove_at=0.999).collect()}
    assert got[100] == "only [TERM], without the address"


def plain_terms(texts, min_support, at, z):
    """Telling terms by the definition, in plain Python."""
    held, pairs, total = Counter(), defaultdict(list), len(texts)
    n_e = Counter()
    for t in texts:
        base = brute(t)
        words = {m[0].lower() for m in re.finditer(r"[^\W\d_]{3,}", t)
                 if not any(a < m.end() and m.start() < b for _, a, b in base)}
        held.update(words)
        entities = {D.entity(k, t[a:b]) for k, a, b in base}
        n_e.update(entities)
        sketch = tuple(sorted(map(D._number, words))[:2])
        for e in entities:
            for w in words:
                pairs[e, w].append(sketch)
    out = set()
    for (e, w), sketches in pairs.items():
        n, own = len(sketches), math.log2(total / n_e[e])
        support = n * n / sum(c * c for c in Counter(sketches).values())
        if support >= min_support and own > 0:
            p = min(1, n / held[w])
            m = support / p
            low = (p + z * z / (2 * m) - z * math.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)
            if 1 + math.log2(low) / own >= at:
                out.add(w)
    return out


@pytest.mark.parametrize("limit", [0, 8 << 20])
def test_terms_match_the_definition(spark, limit):
    rng = random.Random(11)
    mails = [f"user{c}@mail.example" for c in "abcdef"]
    names = ["anton", "berta", "caesar", "dora", "emil", "fritz"]
    common = [filler(1000 + i, 1) for i in range(300)]
    texts = []
    for i in range(700):
        words = rng.sample(common, 25)
        if rng.random() < 0.3:
            k = rng.randrange(6)
            words += [mails[k], names[k] if rng.random() < 0.7 else names[rng.randrange(6)], mails[rng.randrange(6)]]
        elif rng.random() < 0.02:
            words.append(rng.choice(names))
        rng.shuffle(words)
        texts += [" ".join(words)] * (3 if rng.random() < 0.05 else 1)
    for at in (0.3, 0.5):
        want = plain_terms(texts, 3, at, 1.96)
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
        got = find_pii(df, generalise_at=at, broadcast_bytes=limit).collect()
        assert 0 < len(want) < 20
        for r in got:
            t = texts[r.doc_id]
            base = brute(t)
            terms = [("term", *m.span()) for m in re.finditer(r"[^\W\d_]{3,}", t) if m[0].lower() in want
                     and not any(a < m.end() and m.start() < b for _, a, b in base)]
            assert r.spans == joined(base + terms)


def test_many_entities_in_one_text(spark):
    """A directory page costs its entities and its terms, not their product."""
    page = " ".join(f"u{i}@mail.example {filler(i, 1)}" for i in range(4000))
    got = find_pii(spark.createDataFrame([(1, page), (2, page)], "doc_id bigint, text string")).collect()
    assert [r.n_email for r in got] == [4000, 4000] and all("term" not in r.spans for r in got)


def test_sieve(spark):
    t = [D._number(str(i)) for i in range(3000)]
    sieve = D.Sieve.of(spark.createDataFrame([(x,) for x in t[:1000]], "t bigint"))
    assert all(map(sieve.may_hold, t[:1000])) and not any(map(sieve.may_hold, t[1000:]))
