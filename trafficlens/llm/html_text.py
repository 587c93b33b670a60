"""A small HTML tree: enough of the parsing rules to find blocks of text."""

from __future__ import annotations

import bisect
import html
import re
from collections import defaultdict

_NAME = re.compile(r"/?[A-Za-z][^\s/>]*+")
# What follows a tag's name, up to its end; a < outside of quotes ends no tag.
_REST = re.compile(r"[^<>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^<>\"']*+)*+>")
_BARE = re.compile(r"[^<>]*+>")
_ATTR = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
# Fixed names of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
                  "nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCK - {"body", "head", "html", "option", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend"}
# An opening tag that ends an open sibling, looked for up to a boundary.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
            "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}


class Node:
    """An element; ``children`` holds nodes and strings (decoded text)."""
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []

    def names(self) -> list[str]:
        """Words of the element's class, id and role."""
        text = " ".join((self.attrs.get("class", ""), self.attrs.get("id", ""), self.attrs.get("role", "")))
        return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]

    def signature(self) -> str:
        return ".".join([self.tag, *sorted(self.attrs.get("class", "").lower().split())])


class _Open:
    """The stack of open elements, with the places of each name and of blocks:
    no tag has to search it."""

    def __init__(self, root: Node):
        self.stack, self.at, self.blocks = [root], defaultdict(list), []

    def push(self, node: Node) -> None:
        self.at[node.tag].append(len(self.stack))
        if node.tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def cut(self, k: int) -> None:
        """Close all elements from place k on."""
        while len(self.stack) > k:
            self.at[self.stack.pop().tag].pop()
        while self.blocks and self.blocks[-1] >= k:
            self.blocks.pop()

    def close(self, tag: str) -> None:
        places = self.at.get(tag)
        if places and (tag in BLOCK or not self.blocks or self.blocks[-1] < places[-1]):
            self.cut(places[-1])  # an inline end tag does not close a block

    def before(self, tag: str) -> None:
        """Close what the opening tag ends."""
        if tag in ENDS_P and self.blocks and self.stack[self.blocks[-1]].tag == "p":
            self.cut(self.blocks[-1])
        if tag in SIBLINGS:
            ends, stop = SIBLINGS[tag]
            limit = max((self.at[t][-1] for t in stop if self.at.get(t)), default=0)
            inside = [p[k] for t in ends if (p := self.at.get(t)) and (k := bisect.bisect_right(p, limit)) < len(p)]
            if inside:
                self.cut(min(inside))


def _tag(page: str, at: int) -> tuple[str, str, int] | None:
    """(name, rest, behind) of the tag whose < stands before ``at``."""
    name = _NAME.match(page, at)
    if not name:
        return None
    end = _REST.match(page, name.end()) or _BARE.match(page, name.end())
    return (name[0], page[name.end():end.end() - 1], end.end()) if end else None


def parse(page: str) -> Node:
    """The tree of a page, in one pass. Unclosed and misnested tags are closed
    as browsers do in the common cases; a < that begins no whole tag is text."""
    root = Node("#root")
    open_, at, text = _Open(root), 0, 0

    def flush(to: int) -> None:
        if text < to:
            open_.stack[-1].children.append(html.unescape(page[text:to]))

    while (lt := page.find("<", at)) >= 0:
        after = page[lt + 1:lt + 2]
        if after and after in "!?":
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                end = len(page) if end < 0 else end + 3
            else:
                end = page.find(">", lt)
                end = len(page) if end < 0 else end + 1
            flush(lt)
            text = at = end
            continue
        found = _tag(page, lt + 1)
        if not found:
            at = lt + 1
            continue
        flush(lt)
        tag, rest, at = found[0].lower(), found[1], found[2]
        text = at
        if tag[0] == "/":
            open_.close(tag[1:])
            continue
        open_.before(tag)
        node = Node(tag, {a[0].lower(): html.unescape(a[1] or a[2] or a[3]) for a in _ATTR.findall(rest)} if rest else None)
        open_.stack[-1].children.append(node)
        if tag in RAW:
            if tag not in _RAW_END:
                _RAW_END[tag] = re.compile(rf"</{re.escape(tag)}\s*>", re.I)
            end = _RAW_END[tag].search(page, at)
            if tag in ("title", "textarea"):
                node.children.append(html.unescape(page[at:end.start() if end else len(page)]))
            text = at = end.end() if end else len(page)
        elif tag not in VOID:
            open_.push(node)
    flush(len(page))
    return root


_RAW_END: dict[str, re.Pattern] = {}


def squeeze(text: str) -> str:
    return _SPACE.sub(" ", text).strip()
