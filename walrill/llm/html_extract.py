"""Main text of web pages by tree scoring.

A page becomes a tree; what is boilerplate by its element, role or name is cut off. Every paragraph then gives points, one and
one for each comma and hundred characters, to its parent in full, to the grandparent by half and to the next by a third, and a
container's points shrink by the share of its text that is in links. The best container stays with those of its siblings that
have points enough; if it is part of an article element, the whole article stays.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from walrill.llm.common import frugal

#: Elements without content, elements whose content is not markup, elements that are dropped whole (fixed values).
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
DROPPED = frozenset(
    "script style noscript template textarea title head iframe noembed noframes object applet embed svg math canvas audio video map "
    "nav footer aside form fieldset button select option datalist input label dialog menu menuitem".split()
)
#: Elements that begin and end a block of text (fixed values).
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open paragraph; open elements that a like start tag ends, up to the elements that hold them.
ENDS_P = BLOCKS - {"body", "html", "caption", "legend", "li", "dd", "dt", "tbody", "thead", "tfoot", "tr"}
#: What an open paragraph outside of is not ended by a start tag inside; what an end tag of an inline element doesn't reach beyond.
HOLDS_P = ("td", "th", "table", "button", "li", "article", "section", "div", "blockquote")
CELLS = ("td", "th", "table")
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "tbody": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tr", "td", "th", "tbody", "thead"}, {"table"})}
#: Parts of class names and ids that say boilerplate; those that say reader comments; roles likewise (fixed values).
NEGATIVE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted banner banners cookie "
    "cookies consent gdpr notice notices notification alert popup popover modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended recommendations more-stories breadcrumb breadcrumbs pagination pager paging nav "
    "navbar navigation menu menus menubar topbar toolbar sidebar sidebars aside widget widgets footer footnav masthead header "
    "skip search searchbox form copyright legal disclaimer paywall outbrain taboola hidden teaser teasers tags byline".split()
)
COMMENTS = frozenset("comment comments commentlist commentary-list disqus respond reply replies discussion".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar status note".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_QUOTE = re.compile("[\"']")
_LONG_NUMBER = re.compile(r"&#0*([0-9]*)(?<=[0-9]{20});?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
#: The least points of a sibling that stays, and the least share of the best container's.
SIBLING_POINTS, SIBLING_SHARE = 8.0, 0.2


class Node:
    __slots__ = ("tag", "attrs", "parent", "items", "points", "length", "linked", "commas", "dropped")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items: list[Node | str] = []
        self.points, self.length, self.linked, self.commas, self.dropped = 0.0, 0, 0, 0, False


def _tag_end(html: str, at: int, none_left: set[str]) -> int:
    """Place of the > that ends the tag whose name ends at ``at``; quoted values may hold others. -1 if there is none.

    ``none_left`` remembers quotes that the rest of the page lacks, so that many broken tags take no quadratic time."""
    end = html.find(">", at)
    while end >= 0:
        quote = _QUOTE.search(html, at, end)
        if quote is None:
            return end
        # Only a quote behind = opens a value.
        if quote[0] in none_left or not html[max(at - 1, 0) : quote.start()].rstrip().endswith("="):
            at = quote.end()
            continue
        close = html.find(quote[0], quote.end())
        if close < 0:
            none_left.add(quote[0])
            continue
        at = close + 1
        if at > end:
            end = html.find(">", at)
    return end


def _decoded(text: str) -> str:
    """``text`` with its character references decoded. Numbers of very many digits are no characters, unless most are leading zeros."""
    return unescape(_LONG_NUMBER.sub(lambda m: f"&#{m[1]}" if len(m[1]) < 20 else "\ufffd", text) if "&#" in text else text)


class _Open:
    """The open elements, outermost first, and at which depths each tag is open, so that no look-up walks up the tree."""

    def __init__(self, root: Node):
        self.path, self.depths = [root], defaultdict(list)

    def now(self) -> Node:
        return self.path[-1]

    def push(self, node: Node) -> None:
        self.depths[node.tag].append(len(self.path))
        self.path.append(node)

    def close(self, depth: int) -> None:
        """Ends the element at ``depth`` and all inside."""
        while len(self.path) > depth:
            self.depths[self.path.pop().tag].pop()

    def last(self, *tags: str) -> int:
        """Depth of the innermost open element with one of ``tags``, 0 if none is open."""
        return max((d[-1] for t in tags if (d := self.depths.get(t))), default=0)

    def first_below(self, depth: int, tags: set[str]) -> int:
        """Depth of the outermost open element with one of ``tags`` inside the one at ``depth``, 0 if none is."""
        found = [d[i] for t in tags if (d := self.depths.get(t)) and (i := bisect_right(d, depth)) < len(d)]
        return min(found, default=0)


def parse(html: str) -> Node:
    """The tree of a page; anything goes: what is never closed ends with its parent, what was never opened is passed over."""
    root = Node("html", "", None)
    opened, at, n, none_left = _Open(root), 0, len(html), set()
    while at < n:
        now, lt = opened.now(), html.find("<", at)
        if lt < 0:
            now.items.append(_decoded(html[at:]))
            break
        if lt > at:
            now.items.append(_decoded(html[at:lt]))
        two = html[lt + 1 : lt + 2]
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4) if not html.startswith("<!-->", lt) else lt + 2
            at = n if end < 0 else end + 3
            continue
        if two in ("!", "?"):
            end = html.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        closing = two == "/"
        m = _NAME.match(html, lt + 1 + closing)
        if not m:
            if closing:
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                now.items.append("<")
                at = lt + 1
            continue
        tag = m[0].lower()
        end = _tag_end(html, m.end(), none_left)
        if end < 0:
            break
        attrs, at = html[m.end() : end], end + 1
        if closing:
            if tag == "br":
                now.items.append(" ")
                continue
            depth = opened.last(tag)
            if depth and (tag in BLOCKS or depth >= opened.last(*CELLS)):
                opened.close(depth)
            continue
        if tag in ("html", "body"):
            if tag == "body" and now is root:
                now.items.append(body := Node("body", attrs, root))
                opened.push(body)
            continue
        if tag in ENDS_P and (depth := opened.last("p")) > opened.last(*HOLDS_P):
            opened.close(depth)
        if tag in ENDS:
            likes, holds = ENDS[tag]
            if depth := opened.first_below(opened.last(*holds), likes):
                opened.close(depth)
        now = opened.now()
        child = Node(tag, attrs, now)
        now.items.append(child)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(html, at)
            end = html.find(">", close.end()) if close else -1
            at = n if end < 0 else end + 1
        elif tag not in VOID and not (attrs.endswith("/") and tag in ("svg", "path")):
            opened.push(child)
    return root


def _is_dropped(node: Node, in_article: bool) -> bool:
    if node.tag in DROPPED:
        return True
    if node.tag in ("html", "body"):
        return False
    if node.tag == "header":
        return not in_article
    if not node.attrs or node.attrs.isspace():
        return False
    names, role = [], ""
    for m in _ATTRIBUTE.finditer(node.attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            names.append(value)
        elif name == "role":
            role = value.lower().strip()
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
    if role in ROLES:
        return True
    parts = {p.lower() for p in _PARTS.findall(" ".join(names))}
    if parts & COMMENTS:
        return True
    if node.tag in ("main", "article") or role == "main":
        return False
    return bool(parts & NEGATIVE) and not (node.tag in HEADINGS or in_article and parts & NEGATIVE <= {"header"})


def _measure(root: Node) -> list[Node]:
    """Marks boilerplate, measures text and links from the leaves up, passes points; the nodes that stay, parents first."""
    order: list[Node] = []
    stack = [(root, False)]
    while stack:
        node, in_article = stack.pop()
        if node.parent is not None and _is_dropped(node, in_article):
            node.dropped = True
            continue
        order.append(node)
        inside = in_article or node.tag in ("article", "main")
        stack += [(x, inside) for x in node.items if isinstance(x, Node)]
    for node in reversed(order):
        own = sum(len(x.strip()) for x in node.items if isinstance(x, str))
        kids = [x for x in node.items if isinstance(x, Node) and not x.dropped]
        node.length = own + sum(x.length for x in kids)
        node.linked = node.length if node.tag == "a" else sum(x.linked for x in kids)
        node.commas = sum(x.count(",") for x in node.items if isinstance(x, str)) + sum(x.commas for x in kids)
    for node in order:
        direct = "".join(x for x in node.items if isinstance(x, str))
        paragraph = node.tag in ("p", "pre", "blockquote", "td", "li", "dd") or node.tag in ("div", "section", "article", "main", "body") and len(direct.split()) >= 5
        if not paragraph or node.length < 2 or node.parent is None:
            continue
        commas = node.commas if node.tag not in ("div", "section", "article", "main", "body") else direct.count(",")
        given = (1 + commas + min(node.length / 100, 3)) * (1 - node.linked / node.length)
        holder = node.parent if node.tag not in ("div", "section", "article", "main", "body") else node
        for share in (1.0, 0.5, 1 / 3):
            if holder is None:
                break
            holder.points += given * share
            holder = holder.parent
    return order


def _blocks(node: Node, out: list[str]) -> None:
    """Adds the blocks of text of ``node`` in page order."""
    held: list[str] = []

    def close() -> None:
        if text := " ".join("".join(held).split()):
            out.append(text)
        held.clear()

    stack: list[tuple[Node | str | None, bool]] = [(node, False)]
    while stack:
        x, ends = stack.pop()
        if isinstance(x, str):
            held.append(x)
        elif ends:
            close()
        elif x.dropped:
            # What is cut off parts the words around it, as its place on the page does.
            held.append(" ")
        elif x.tag == "br" or x.tag in ("td", "th"):
            held.append(" ")
            stack += [(y, False) for y in reversed(x.items)]
        else:
            block = x.tag in BLOCKS
            if block:
                close()
                stack.append((x, True))
            stack += [(y, False) for y in reversed(x.items)]
    close()


def _final(node: Node) -> float:
    return node.points * (1 - node.linked / node.length) if node.length else 0.0


def main_text(html: str | None) -> str:
    """The article's blocks joined by two line feeds; empty for null, empty or text-free pages."""
    if not html:
        return ""
    root = parse(html)
    order = _measure(root)
    if not root.length:
        return ""
    holders = [x for x in order if x.points > 0]
    if not holders:
        out: list[str] = []
        _blocks(root, out)
        return "\n\n".join(out)
    best = max(holders, key=_final)
    whole = best
    node = best
    while node is not None:
        if node.tag == "article":
            whole = node
        node = node.parent
    if whole.tag == "article":
        kept = [whole]
    elif best.parent is None:
        kept = [best]
    else:
        least = max(SIBLING_POINTS, SIBLING_SHARE * _final(best))
        kept = []
        for x in best.parent.items:
            if not isinstance(x, Node) or x.dropped:
                continue
            density = x.linked / x.length if x.length else 0.0
            paragraph = x.tag == "p" and density < 0.25 and x.length > 80
            title = x.tag in ("h1", "h2") and best.parent.tag != "body"
            if x is best or _final(x) >= least or paragraph or title:
                kept.append(x)
    out = []
    for x in kept:
        _blocks(x, out)
    return "\n\n".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(h) for h in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each row of ``pages`` (page_id, url, html); no shuffle.

    Null and empty html give an empty text; null or repeated ids and urls are passed on; other columns are left out."""
    return pages.select("page_id", "url", "html").mapInArrow(frugal(_extract), pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long"))
