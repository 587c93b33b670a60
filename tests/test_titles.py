"""Title cleaning and line parsing: the hand-checked cases of FIXTURES C1."""

import pytest
from pyspark.sql import functions as F

from trafficlens.functions import titles as X

# (line, expected (title, views) or None when rejected)
CASES = [
    ("en Facebook 12 3456", ("Facebook", 12)),
    ("en Facebook%23Website 3 10", ("Facebook", 3)),
    ("en Mexico 5 50", None),
    ("en Silicon_Valley 9 9", None),
    ("en File.jpg 1 1", None),
    ("en Special:Search 4 4", None),
    ("en User_talk:X 4 4", None),
    ("en Talk:Y 1 1", None),
    ("en Template:Facebook 1 1", None),
    ("en Module:X 1 1", ("Module:X", 1)),
    ("en iPhone 4 4", None),
    ("en %41bc 7 7", ("Abc", 7)),
    ("en Main_Page 9 9", None),
    ("en Searches 1 1", ("Searches", 1)),
    ("en Foo Bar 3 4", None),
    ("en Foo 1 2 3", None),
    ("en Foo 12x 40", None),
    ("en Foo 12 x 3", None),
    ("en Foo -- --", None),
    ("en.b Foo 1 2", None),
    ("de Foo 1 2", None),
    ("en Caf%C3%A9 2 20", ("Café", 2)),
    ("en 100%_Pure 2 20", ("100%_Pure", 2)),
    ("en F%zz 1 2", ("F%zz", 1)),
    ("en A+B 2 20", ("A B", 2)),
    ("en A%7CB 1 1", ("A|B", 1)),
    ("en #frag 1 1", None),
    ("en %23 1 1", None),
]


def _parse(spark, lines, **kw):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, value string")
    return {r["i"]: r for r in X.parse_lines(df, keep=["i"], **kw).collect()}


def test_fixture_lines(spark):
    got = _parse(spark, [c[0] for c in CASES])
    for i, (line, want) in enumerate(CASES):
        r = got[i]
        if want is None:
            assert r["status"] != "ok", line
        else:
            assert r["status"] == "ok", (line, r)
            assert (r["title"], r["views"]) == want, line


def test_reject_reasons(spark):
    got = _parse(spark, ["de Foo 1 2", "en Talk:Y 1 1", "en #frag 1 1", "en Foo 12x 40"])
    assert [got[i]["status"] for i in range(4)] == ["shape", "title", "empty", "count"]


def test_strict_extension_keeps_mexico(spark):
    got = _parse(spark, ["en Mexico 5 50", "en File.jpg 1 1"], strict_ext=True)
    assert got[0]["status"] == "ok" and got[0]["title"] == "Mexico"
    assert got[1]["status"] == "title"


def test_keyword_and_user_rule(spark):
    got = _parse(spark, ["en Facebook 1 1", "en Twitter 1 1"], keyword="facebook")
    assert got[0]["status"] == "ok" and got[1]["status"] == "keyword"
    got = _parse(spark, ["en Short 1 1", "en Much_Longer 1 1"],
                 extra_rule=lambda p: F.length(p) <= 6)
    assert got[0]["status"] == "ok" and got[1]["status"] == "title"


def test_next_line_char_matches_like_python(spark):
    got = _parse(spark, ["en Foo\u0085Bar 3 4"])
    assert got[0]["status"] == "ok" and got[0]["title"] == "Foo\u0085Bar"


@pytest.mark.parametrize("line", ["en  5 7", "en A  B 1 2", "en X 1 2 3 4"])
def test_fast_path_agrees_with_regex(spark, line):
    """Lines outside the 4-field fast path use the regex; both give the
    groups Python's re would."""
    import re
    m = re.match("en (.*) ([0-9].*) ([0-9].*)", line)
    got = _parse(spark, [line])[0]
    assert got["page"] == (m.group(1) if m else "")


def test_split_line(spark):
    df = spark.createDataFrame([("en Foo_Bar 12 345",)], "value string")
    r = X.split_line(df).collect()[0]
    assert (r.project, r.page, r.views, r.bytes) == ("en", "foo_bar", 12, 345)
