"""HTML main text with a site style tree.

The DOMs of a host are merged: an element is known by the chain of its
ancestors' tags and classes and by its own. Every element and text block
of every page counts, also those that a landmark decides, so a bar that a
host repeats is known on a page of any layout. Over the pages of the host
that have it, an element's presentation importance is the entropy of its
styles (the sequence of its children, runs of equal children taken
together), to the base of these pages; a text block's content importance
is 1 minus the share log n / log m of the n among them with its text, so
text that all m pages repeat has 0 and text of one page has 1. An element
on a single page of its host has importance 1.

Landmarks fix the importance where HTML names the role by a tag or by a
whole class, id or role: navigation, headers, footers, sidebars, notices,
adverts, scripts, styles and comments have 0; the article (article, main)
has 1. What no landmark decides, also beside an article, is judged by the
tree: a branch in which no element or text reaches the importance
``least`` is removed. The tree does not overrule a landmark: menus and
adverts differ by page, and an article may be on several.

Inside an article forms and boxes named as adverts, reader comments, menus
or calls to share have 0 as well; any other name there is only a hint, as
are, outside, a form, a role that is a part of a box's name ("site-menu")
and a box of links alone: the branch is judged by the tree with half its
importance. Where the host has the node on one page only, there is nothing
to judge by: a named line (heading, paragraph, item ...) stays, a hinted
box goes. A named box or a form that holds most of the page's text, and
outside of articles the page's article if it has one, wraps the page and
is no hint.

A page's nodes are one row of arrays; counts are pre-aggregated in each
task by (host, node, style or text); nothing is gathered by host alone,
and only the nodes of pages with undecided text are joined.

Defined cases: null and empty html have no text; rows equal in url and
html are one page in each count and each get a row; a null or odd url is
the host ''; very long pages, and any depth of unclosed tags, are parsed
whole, in time that grows with the page; a < that begins no tag is text; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.session import shared_root

from .html_text import BLOCK, Node, parse, squeeze

# Roles by element and by whole class, id and role; fixed values.
NOISE_TAGS = frozenset("nav header footer aside script style noscript template iframe svg head button select "
                       "textarea input dialog menu object".split())
NOISE_WORDS = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie "
                        "cookies consent disqus footer header masthead menu modal nav navbar navigation newsletter "
                        "notice notices popup promo related reply replies share sharing sidebar social sponsor "
                        "sponsored subscribe toolbar widget contentinfo complementary search".split())
# Boxes of these names are no part of an article they stand in.
ALIEN_WORDS = frozenset("ad ads advert adverts advertisement breadcrumb breadcrumbs comment comments cookie cookies "
                        "consent disqus menu modal nav navbar navigation newsletter popup promo reply replies share "
                        "sharing sidebar social sponsor sponsored subscribe".split())
MAIN_TAGS = frozenset(("article", "main"))
LINES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre table tr td th caption figcaption".split())
NOISE, MAIN, OPEN, LINE_HINT, BOX_HINT = range(5)


def _number(*parts) -> int:
    text = "\x00".join(map(str, parts))
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _tokens(node: Node) -> set[str]:
    """The whole id, and each class and role."""
    text = " ".join((node.attrs.get("class", ""), node.attrs.get("role", ""))).lower()
    return {*text.split(), node.attrs.get("id", "").strip().lower()}


def _main(node: Node) -> bool:
    return node.tag in MAIN_TAGS or "main" in node.names()[-1:]


_NO_SIZE = (0, False, 0, 0)


def _sizes(root: Node) -> dict[int, tuple[int, bool, int, int]]:
    """By element: characters outside noise tags, whether a main element is
    inside, characters in links, links."""
    order = [(root, -1)]
    for k, (node, _) in enumerate(order):  # grows on the way: parents come first
        order += [(c, k) for c in node.children if isinstance(c, Node) and (c.tag not in NOISE_TAGS or c.tag == "header")]
    found = [[0, False, 0, 0] for _ in order]
    for k in range(len(order) - 1, -1, -1):
        node, parent = order[k]
        mine = found[k]
        mine[0] += sum(len(c.strip()) for c in node.children if not isinstance(c, Node))
        if parent >= 0:
            up, link = found[parent], node.tag == "a"
            up[0] += mine[0]
            up[1] = up[1] or mine[1] or _main(node)
            up[2] += mine[0] if link else mine[2]
            up[3] += 1 if link else mine[3]
    return {id(node): tuple(x) for (node, _), x in zip(order, found) if node.children}


class Page:
    """A page's blocks in order and its nodes.

    ``blocks`` has (text, node or None): None is decided and kept. ``nodes``
    has (parent, key, look, is text, state) of every element and text block:
    its place in the merged tree, what it looks like on this page and what
    landmarks say of it.
    """

    def __init__(self, page: str):
        self.blocks: list[tuple[str, int | None]] = []
        self.nodes: list[tuple[int, int, int, bool, int]] = []
        self._run: list[str] = []
        root = parse(page)
        self._sizes = _sizes(root)
        self._all = self._sizes.get(id(root), _NO_SIZE)
        self._walk(root)

    def _flush(self, parent: int, key: int, state: int) -> None:
        text = squeeze("".join(self._run))
        self._run = []
        if not text:
            return
        self.nodes.append((parent, _number(key, "#text"), _number("text", text), True, state))
        if state != NOISE:
            self.blocks.append((text, None if state == MAIN else len(self.nodes) - 1))

    def _wraps(self, node: Node, inside: bool) -> bool:
        """Holds most of the page's text, and its main element if outside one."""
        chars, main, _, _ = self._sizes.get(id(node), _NO_SIZE)
        return 2 * chars > self._all[0] and (inside or main or not self._all[1])

    def _hinted(self, node: Node) -> bool:
        """A box whose name holds a role as a part, or that is made of links."""
        if node.tag not in BLOCK or node.tag in LINES or self._wraps(node, False):
            return False
        chars, main, linked, links = self._sizes.get(id(node), _NO_SIZE)
        if main:
            return False
        return bool(node.attrs) and not NOISE_WORDS.isdisjoint(node.names()) or links > 1 and 5 * linked >= 4 * chars

    def _state(self, node: Node, state: int) -> int:
        """The state of an element in a branch of ``state``."""
        if state == NOISE or node.tag in ("html", "body"):
            return state
        if node.tag in NOISE_TAGS and not (node.tag == "header" and state != OPEN):
            return NOISE
        named = bool(node.attrs) and not NOISE_WORDS.isdisjoint(tokens := _tokens(node))
        if state != OPEN and (node.tag == "form" or named and node.tag not in LINES and node.tag in BLOCK
                              and not ALIEN_WORDS.isdisjoint(tokens)) and not self._wraps(node, True):
            return NOISE
        if state in (LINE_HINT, BOX_HINT):
            return state
        if state == MAIN:
            if named and node.tag in BLOCK and not self._wraps(node, True):
                return LINE_HINT if node.tag in LINES else BOX_HINT
            return MAIN
        if node.tag == "form":
            holds = self._sizes.get(id(node), _NO_SIZE)[1]
            return OPEN if holds or self._wraps(node, False) else BOX_HINT
        if named and not self._wraps(node, False):
            return NOISE
        return MAIN if _main(node) else BOX_HINT if self._hinted(node) else OPEN

    def _enter(self, node: Node, state: int, parent: int, key: int) -> list:
        """The node of a block, and a frame to walk its children in."""
        looks = [c.signature() if isinstance(c, Node) else "#text" for c in node.children
                 if isinstance(c, Node) or c.strip()]
        style = _number("style", *[s for i, s in enumerate(looks) if not i or looks[i - 1] != s])
        self.nodes.append((parent, key, style, False, state))
        return [iter(node.children), len(self.nodes) - 1, key, state, True]

    def _walk(self, root: Node) -> None:
        """Blocks and nodes in page order. A frame is a block, or an inline
        element inside one (whose text belongs to the block around it)."""
        frames = [self._enter(root, OPEN, -1, _number("#root"))]
        while frames:
            children, mine, key, state, block = frames[-1]
            c = next(children, None)
            if c is None:
                frames.pop()
                if block:
                    self._flush(mine, key, state)
                continue
            if not isinstance(c, Node):
                self._run.append(c)
                continue
            role = self._state(c, state)
            if c.tag == "br":
                self._run.append(" ")
            elif c.tag in BLOCK or block and role == MAIN != state:
                self._flush(mine, key, state)
                inner = (key, c.signature()) if block else (key, "inline", c.signature())
                frames.append(self._enter(c, role, mine, _number(*inner)))
            elif role == state if block else role != NOISE or state == NOISE:
                frames.append([iter(c.children), mine, key, state, False])

    def undecided(self) -> bool:
        return any(n is not None for _, n in self.blocks)

    def text(self, low: set[int]) -> str:
        """The blocks that stay when the branches at ``low`` are removed."""
        gone = set(low)
        for k, (parent, _, _, _, state) in enumerate(self.nodes):  # parents come before children
            if parent in gone and state != MAIN:
                gone.add(k)
        return "\n\n".join(t for t, n in self.blocks if n is None or n not in gone)


def _keyed(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
                        F.xxhash64("url", "html").alias("key"), host.alias("host"))


_NODE = pa.struct([("parent", pa.int32()), ("node", pa.int64()), ("look", pa.int64()), ("text", pa.bool_()),
                   ("state", pa.int32()), ("first", pa.bool_()), ("new", pa.bool_())])


def _nodes(pages: DataFrame) -> DataFrame:
    """One row a page: every node, ``first`` of its key on the page, ``new``
    with its look; ``undecided``: a text needs the tree."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                rows, ends, undecided = [], [0], []
                for html in part.column(2).to_pylist():
                    page, keys, looks = Page(html), set(), set()
                    for parent, key, look, text, state in page.nodes:
                        one = (key, look, text)
                        rows.append((parent, key, look, text, state, key not in keys, one not in looks))
                        keys.add(key)
                        looks.add(one)
                    ends.append(len(rows))
                    undecided.append(page.undecided())
                nodes = pa.StructArray.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(_NODE), _NODE)],
                    fields=list(_NODE))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(undecided, pa.bool_()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), nodes)],
                    names=["key", "host", "undecided", "nodes"])

    return _keyed(pages).select("key", "host", "html").mapInArrow(
        run, "key bigint, host string, undecided boolean, nodes array<struct<parent:int,node:bigint,look:bigint,"
             "text:boolean,state:int,first:boolean,new:boolean>>").dropDuplicates(["key"])  # a page counts once


def importance(nodes: DataFrame) -> DataFrame:
    """key, number, parent and own importance of the undecided nodes."""
    each = nodes.select("host", F.explode("nodes").alias("x")).filter("x.new").select("host", "x.*")
    looks = each.groupBy("host", "node", "look", "text").agg(
        F.count("*").alias("n"), F.sum(F.col("first").cast("long")).alias("pages"))
    tree = looks.groupBy("host", "node").agg(
        F.sum("pages").alias("m"), F.sum("n").alias("total"), F.sum(F.col("n") * F.log2("n")).alias("nlogn"))
    open_ = nodes.filter("undecided").select("key", "host", F.posexplode("nodes").alias("number", "x")) \
        .filter(F.col("x.state") != NOISE).filter(F.col("x.state") != MAIN) \
        .select("key", "host", "number", "x.parent", "x.node", "x.look", "x.text", "x.state")
    hint = F.col("state") != OPEN
    m, total = F.col("m").cast("double"), F.col("total").cast("double")
    # a text: 1 - log n / log m; styles: entropy to the base m, a page may have several
    own = F.when(m <= 1, F.when(F.col("state") == BOX_HINT, 0.0).otherwise(1.0)) \
        .when(F.col("text"), 1 - F.log2("n") / F.log2(m)) \
        .otherwise(F.least(F.lit(1.0), (F.log2(total) - F.col("nlogn") / total) / F.log2(m)))
    own = F.when(hint & (m > 1), own / 2).otherwise(own)
    known = open_.join(looks, ["host", "node", "look", "text"]).join(tree, ["host", "node"])
    return known.select("key", "number", "parent", own.alias("own"))


def low_branches(nodes: DataFrame, least: float) -> DataFrame:
    """key, low: the roots of the branches to remove, one row a page."""
    def run(frame):
        frame = frame.drop_duplicates("number").sort_values("number")
        number, parent = frame["number"].tolist(), frame["parent"].tolist()
        own, child = dict(zip(number, frame["own"])), {}
        best = {}
        for k, p in zip(reversed(number), reversed(parent)):  # children before parents
            best[k] = max([own[k], *child.get(k, ())])
            child.setdefault(p, []).append(best[k])
        low = [k for k in number if best[k] < least]
        return frame.iloc[:1][["key"]].assign(low=[low])

    # one group is one page
    return importance(nodes).groupBy("key").applyInPandas(run, "key bigint, low array<int>").filter("size(low) > 0")


def main_text(pages: DataFrame, least: float = 0.3, broadcast_bytes: int = 8 << 20) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    shared_root(pages.sparkSession)
    low = low_branches(_nodes(pages).checkpoint(), least).checkpoint()
    rows, spans = low.agg(F.count("*"), F.coalesce(F.sum(F.size("low")), F.lit(0))).first()
    if 64 * rows + 16 * spans <= broadcast_bytes:  # measured, else Spark shuffles both sides
        low = F.broadcast(low)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [Page(h).text(set(x or ())) for h, x in
                         zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(1), pa.array(texts, pa.string()),
                     pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return _keyed(pages).join(low, "key", "left").select("page_id", "url", "html", "low") \
        .mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
