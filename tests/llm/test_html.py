"""Main text: landmarks, the site style tree, odd input."""

import math
import time
from collections import Counter, defaultdict

import pytest

from trafficlens.llm import style_tree as ST
from trafficlens.llm.html_text import parse
from trafficlens.llm.style_tree import Page, main_text


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def test_landmarks_references_and_unclosed_tags(spark):
    html = ("<!DOCTYPE html><html><head><title>T</title><script>var t='</p>';</script></head><body>"
            "<nav><ul><li><a href='/x'>menu</a></li></ul></nav><div class='ad'>buy</div><header>top</header>"
            "<article><h1>A &amp; B</h1><p><b>one\n  two<br><p>thr&eacute;e <i>f</i>our</p><aside>side</aside>"
            "<form>send</form><section id='comments'><p>reader</p></section><ul><li>x<li>y</ul></article>"
            "<footer>&copy; z</footer></body></html>")
    got = texts(main_text(pages(spark, [(1, "http://a.example/1", html)])))
    assert got[1] == "A & B\n\none two\n\nthrée four\n\nx\n\ny"


def test_style_tree_drops_what_a_site_repeats(spark):
    page = ("<html><body><div class='top'>Welcome to the site</div><div class='story'><p>Story {i}</p>"
            "<p>All about {i} and {j}</p></div><div class='low'><p>Always the same line</p></div></body></html>")
    rows = [(i, f"http://site.example/{i}", page.format(i=i, j=i * 7)) for i in range(8)]
    rows.append((99, "http://lone.example/", page.format(i=1, j=2)))  # one page: nothing is repeated
    got = texts(main_text(pages(spark, rows)))
    for i in range(8):
        assert got[i] == f"Story {i}\n\nAll about {i} and {i * 7}"
    assert got[99] == "Welcome to the site\n\nStory 1\n\nAll about 1 and 2\n\nAlways the same line"
    # by the join instead of the broadcast
    assert texts(main_text(pages(spark, rows), broadcast_bytes=0)) == got


def test_null_empty_repeated_and_extra_columns(spark):
    rows = [(1, None, None), (2, "http://b.example", ""), (3, "odd", "just text"), (3, "odd", "just text"),
            (None, "http://c.example/", "<article>" + "<p>long</p>" * 3000 + "</article>")]
    df = pages(spark, rows).selectExpr("*", "1 as key", "'h' as host", "2 as low", "'t' as text")
    got = sorted((r.page_id or -1, r.url, r.text, r.n_chars) for r in main_text(df).collect() if r.page_id != 1)
    assert got[0][3] == 3000 * 4 + 2999 * 2
    assert got[1:] == [(2, "http://b.example", "", 0), (3, "odd", "just text", 9), (3, "odd", "just text", 9)]
    assert main_text(pages(spark, [])).count() == 0


def test_stray_markup_is_text():
    assert Page("a < b <p>c</div>d").text(set()) == "a < b\n\nc d".replace("c d", "cd")


def test_pages_with_an_article_count_in_the_tree(spark):
    bar, low = "<div class='top'>Welcome to the site</div>", "<div class='low'>Always the same line</div>"
    rows = [(i, f"http://site.example/{i}", f"{bar}<article><p>Story {i}</p></article><div class='note'>Beside {i}"
                                            f"</div>{low}") for i in range(8)]
    rows.append((99, "http://site.example/99", f"{bar}<div class='story'><p>No article here</p></div>{low}"))
    got = texts(main_text(pages(spark, rows)))
    assert got[99] == "No article here"
    # beside an article the tree decides as well
    assert all(got[i] == f"Story {i}\n\nBeside {i}" for i in range(8))


def test_names_inside_an_article_are_hints(spark):
    lone = ("<article><h2 id='related-work'>Related</h2><h2 id='search-and-rescue'>Rescue</h2><p class='notice'>Note"
            "</p><p id='header-files'>Files</p><header class='entry'><h1>Title</h1></header><pre>x <span "
            "class='comment'># y</span></pre><div class='share'>tell</div></article>")
    box = "<article><p>Story {i}, and a story it is</p><div class='widget'>{w}</div></article>"
    rows = [(1, "http://lone.example/", lone)]
    rows += [(10 + i, f"http://same.example/{i}", box.format(i=i, w="Share this")) for i in range(8)]
    rows += [(20 + i, f"http://other.example/{i}", box.format(i=i, w=f"Figure {i}")) for i in range(8)]
    got = texts(main_text(pages(spark, rows)))
    assert got[1] == "Related\n\nRescue\n\nNote\n\nFiles\n\nTitle\n\nx # y"
    assert all(got[10 + i] == f"Story {i}, and a story it is" for i in range(8))
    assert all(got[20 + i] == f"Story {i}, and a story it is\n\nFigure {i}" for i in range(8))


def test_wrappers_and_teasers_hide_nothing(spark):
    form = "<form><div>Go</div><article><p>The story</p></article></form>"
    plain = "<form><p>A long story without any article</p></form><form>Search</form>"
    card = "<div><p>A long story beside a card, told in full</p></div><article>Card</article>"
    got = texts(main_text(pages(spark, [(1, "http://a.example/", form), (2, "http://b.example/", plain),
                                        (3, "http://c.example/", card)])))
    assert got == {1: "Go\n\nThe story", 2: "A long story without any article",
                   3: "A long story beside a card, told in full\n\nCard"}


def test_adverts_and_reader_comments_inside_an_article_go(spark):
    page = ("<article><h1>Story {i}</h1><p>What happened to {i} on that day, told at length</p><div class='ad'><p>Buy product "
            "{i} now</p></div><section class='comments'><p>Reader {i} says so</p></section><form><p>Send {i}</p></form>"
            "<h2 class='comments'>On comments of {i}</h2></article>")
    rows = [(i, f"http://six.example/{i}", page.format(i=i)) for i in range(6)] + [(9, "http://one.example/", page.format(i=9))]
    got = texts(main_text(pages(spark, rows)))
    assert got == {i: f"Story {i}\n\nWhat happened to {i} on that day, told at length\n\nOn comments of {i}" for i in [*range(6), 9]}


def test_a_host_of_one_page(spark):
    html = ("<div class='site-menu'>Home About</div><div><a href='/'>Start</a> <a href='/b'>Blog</a></div>"
            "<div class='story'><p>A story of some length, with <a href='x'>a link</a> in it.</p><p>And more of it.</p></div>"
            "<div class='comment-list'><p>Nice</p></div>")
    got = texts(main_text(pages(spark, [(1, "http://one.example/", html)])))
    assert got[1] == "A story of some length, with a link in it.\n\nAnd more of it."


@pytest.mark.parametrize("html,text", [
    ("<div>" * 100_000 + "deep", "deep"), ("<b>" * 100_000 + "deep", "deep"), ("<b>" * 20_000 + "</i>" * 20_000 + "x", "x"),
    ("<i><div>" + "<b>" * 20_000 + "</i>" * 20_000 + "x", "x"), ("<p><font>" * 30_000 + "x", "x"), ("<ul><li>" * 30_000 + "x", "x"),
    ("<a b " * 200_000, ("<a b " * 200_000).strip()), ("<a b=\"" * 150_000, None), ("<a b='" * 150_001, None), ("<" * 500_000, "<" * 500_000),
    ("<!" * 300_000, ""), ("<!--" * 200_000, ""), ("<script>" * 100_000, ""), ("</p>" * 200_000 + "x", "x"), ("<td>" * 100_000 + "x", "x")],
    ids=range(15))
def test_odd_pages_take_time_in_proportion(html, text):
    began = time.process_time()
    got = ST.Page(html).text(set())
    assert time.process_time() - began < 20 and (text is None or got == text)


def test_quotes_and_stray_signs():
    got = ST.Page("<p title='a > b' class=\"c\">one <em x=\"y>two</em> 3 < 4 <5 & </ p><p class='open>six</p>").text(set())
    assert got == "one two 3 < 4 <5 & </ p>\n\nsix"
    assert parse("<a\nhref='x'>t</a>").children[0].attrs == {"href": "x"}


def test_importance_matches_the_definition(spark):
    """Entropy of styles and share of texts, recomputed page by page."""
    rows = []
    for i in range(12):
        parts = ["<div class='top'>Same bar</div>", f"<div class='mid'><p>Text {i % 5}</p>{'<b>x</b>' * (i % 3)}<p>Tail</p></div>"]
        parts += ["<ul><li>One</li><li>Two</li></ul>"] * (i % 2) + [f"<div class='rare'>only {i}</div>"] * (i < 4)
        rows.append((i, f"http://h{i % 2}.example/{i}", "".join(parts)))
    df = pages(spark, rows)
    nodes = ST._nodes(df)
    got = {(r.key, r.number): r.own for r in ST.importance(nodes).collect()}
    key_of = {r.page_id: (r.key, r.host) for r in ST._keyed(df).collect()}
    looks, seen = defaultdict(Counter), defaultdict(set)
    for i, _, html in rows:
        for _, node, look, text, _ in set(ST.Page(html).nodes):
            place = key_of[i][1], node
            seen[place].add(i)
        for one in {(node, look, text) for _, node, look, text, _ in ST.Page(html).nodes}:
            looks[key_of[i][1], one[0]][one[1:]] += 1
    n = 0
    for i, _, html in rows:
        key, host = key_of[i]
        for number, (_, node, look, text, state) in enumerate(ST.Page(html).nodes):
            if state in (ST.NOISE, ST.MAIN):
                continue
            m, counts = len(seen[host, node]), looks[host, node]
            if m == 1:
                want = 0.0 if state == ST.BOX_HINT else 1.0
            elif text:
                want = 1 - math.log2(counts[look, text]) / math.log2(m)
            else:
                total = sum(counts.values())
                want = min(1.0, -sum(c / total * math.log2(c / total) for c in counts.values()) / math.log2(m))
            if state != ST.OPEN and m > 1:
                want /= 2
            assert abs(got[key, number] - want) < 1e-9
            n += 1
    assert n == len(got) > 50
