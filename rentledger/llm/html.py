"""Main text of web pages by composite text density.

The page becomes a tree of block elements; inline markup belongs to the text around it. For every node the
density is its characters per tag, lowered by the share of link text in it and on the page. The node with the
largest sum of its children's densities holds the main text. The least density on the path from there to the body is the
threshold: other branches that reach it contribute their own largest-sum node; headings go with what they stand before. Densities are those of the whole page. In and
among the chosen subtrees, what its element, role, class or id declares as menu, header, footer, sidebar, notice, advert, form or
comment is left out.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush
from html import unescape
from math import e, log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import text_batches

# Fixed values of the markup language, and words that sites use to name what isn't main text.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title xmp noembed noframes iframe".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_CLOSES_P = set(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul".split()
)
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_DROP = set(
    "head script style noscript template svg math canvas nav footer aside form button select textarea iframe object audio video "
    "dialog menu title".split()
)
# Elements whose content isn't text of the page.
_UNSEEN = set("head script style noscript template svg math canvas select textarea iframe object audio video title xmp noembed noframes".split())
_BARS_P = ("table", "td", "th", "article", "section", "div")
_DROP_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_DROP_NAMES = set(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus respond reply replies cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe signup login share sharing social related "
    "recommended pagination pager toolbar copyright".split()
)
# Of these, the names of what other people wrote or of other pages; they count for article elements as well.
_OTHERS = set("comment comments disqus respond reply replies related recommended".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
# Characters outside links and headings from which text counts as a page's own when no article element holds it.
_PROSE = 60
_WHOLE = {"article", "main"}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_S = r"[ \t\n\f\r]"
# An attribute: name, =, value in double or single quotes or bare. A quote opens only behind =, and only if it is closed.
_ATTRIBUTE = rf"""[ \t\n\f\r/]*+([^ \t\n\f\r/>][^ \t\n\f\r/>=]*+)(?:{_S}*+={_S}*+("[^"]*"|'[^']*'|[^ \t\n\f\r>]*+))?+"""
_TAG_REST = re.compile(rf"(?:{_ATTRIBUTE})*+[ \t\n\f\r/]*+")
_ATTRIBUTE = re.compile(_ATTRIBUTE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("tag", "names", "role", "hidden", "parent", "items", "chars", "link_chars", "tags", "links", "density", "sum", "cut", "unseen")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.parent, self.items = tag, parent, []
        self.names, self.role, self.hidden = (), "", False
        if attributes:
            seen: set[str] = set()
            for m in _ATTRIBUTE.finditer(attributes):
                name, value = m[1].lower(), (m[2] or "").strip("\"'")
                if name in seen or name not in ("class", "id", "role", "hidden", "style"):
                    continue
                seen.add(name)
                if name in ("class", "id"):
                    self.names += tuple(w.lower() for w in _WORD.findall(value))
                elif name == "role":
                    self.role = value.lower()
                else:
                    self.hidden |= name == "hidden" or "display:none" in value.lower().replace(" ", "")
        self.cut = False
        self.unseen = parent is not None and parent.unseen or tag in _UNSEEN


def parse(html: str) -> list[Node]:
    """The block elements in page order; the first is the page. Items of a node: texts, ``(text, in a link)``, and nodes."""
    page = Node("#page", "", None)
    nodes, stack = [page], [page]
    open_at: dict[str, list[int]] = defaultdict(list)  # where elements of a name stand on the stack
    links = 0  # open links

    def innermost(*tags: str) -> int:
        return max((open_at[t][-1] for t in tags if open_at[t]), default=0)

    def shut(k: int) -> None:
        for x in stack[k:]:
            open_at[x.tag].pop()
        del stack[k:]

    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            stack[-1].items.append((html[at:lt], links > 0))
        if lt >= n:
            break
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        closing = html.startswith("</", lt)
        name = _NAME.match(html, lt + 1 + closing)
        if not name:
            if html.startswith(("<!", "<?", "</"), lt):
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                stack[-1].items.append(("<", links > 0))
                at = lt + 1
            continue
        gt = _TAG_REST.match(html, name.end()).end()
        gt = gt if gt < n else -1
        at = n if gt < 0 else gt + 1
        tag, attributes = name[0].lower(), html[name.end() : n if gt < 0 else gt]
        if tag == "br":
            stack[-1].items.append(None)
        elif tag == "a":
            links = 0 if closing else 1
            if not closing:
                stack[-1].items.append(True)
        elif tag in _INLINE or (tag in _VOID and tag != "hr"):
            continue
        elif closing:
            if k := innermost(tag):
                shut(k)
        else:
            if tag in _CLOSES_P and (k := innermost("p")) > innermost(*_BARS_P):
                shut(k)
            if tag in _CLOSED_BY and (k := innermost(*_CLOSED_BY[tag])) > innermost(*_SCOPE[tag]):
                shut(k)
            node = Node(tag, attributes, stack[-1])
            stack[-1].items.append(node)
            nodes.append(node)
            if tag in _RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                stop = end.start() if end else n
                node.items.append((html[at:stop], False))
                close = html.find(">", stop) if end else -1
                at = n if close < 0 else close + 1
            elif tag not in _VOID and not (attributes.endswith("/") and tag in ("path", "circle", "rect")):
                open_at[tag].append(len(stack))
                stack.append(node)
    return nodes


def _others(nodes: list[Node]) -> set[int]:
    """Nodes that their own names declare as comments or related posts.

    If the page has no text of its own outside them, the largest is a wrapper and doesn't count, and so on inside it, until
    text of its own is found.
    """
    named = {id(x) for x in nodes if x.parent is not None and x.tag not in ("html", "body") and not _OTHERS.isdisjoint(x.names)}
    if not named:
        return named
    # By region, which is the nearest named ancestor: own characters, whether an article holds some, regions inside.
    region, inner, size, articles, whole, dead = {}, {}, {}, set(), set(), set()
    for x in nodes:
        up = id(x.parent) if x.parent is not None else None
        if up in dead or x.tag in _DROP - {"form"} or x.role in _DROP_ROLES - {"form"}:
            dead.add(id(x))
            continue
        region[id(x)] = mine = id(x) if id(x) in named else region.get(up)
        if id(x) in named:
            inner.setdefault(region.get(up), []).append(id(x))
        if x.tag in _WHOLE or x.role == "main" or up in whole and id(x) not in named:
            whole.add(id(x))
        if x.tag not in _HEADINGS:
            own = sum(len(" ".join(i[0].split())) for i in x.items if type(i) is tuple and not i[1])
            size[mine] = size.get(mine, 0) + own
            if own and id(x) in whole:
                articles.add(mine)
    total = dict(size)
    for x in reversed(nodes):
        if id(x) in named and id(x) in region:
            up = region.get(id(x.parent))
            total[up] = total.get(up, 0) + total.get(id(x), 0)
    opened, todo, at = set(), [], None
    while at not in articles and size.get(at, 0) < _PROSE:
        for k in inner.get(at, ()):
            heappush(todo, (-total.get(k, 0), len(todo) + len(opened), k))
        if not todo:  # nowhere enough: what stands outside is the page, if there is anything
            return named if size.get(None) else set()
        at = heappop(todo)[2]
        opened.add(at)
    return named - opened


def _cut_off(nodes: list[Node]) -> None:
    """Mark what isn't main text by its own declaration.

    Comments and related posts are cut wherever the page has text beside them. Other names, and being a form or hidden, don't count
    for a node that holds an article or most of the rest of the page.
    """
    others = _others(nodes)
    holds, chars = set(), {}
    for node in reversed(nodes):
        own = sum(len(i[0]) for i in node.items if type(i) is tuple) + chars.get(id(node), 0)
        chars[id(node)] = own
        if node.parent is not None and id(node) not in others:
            up = id(node.parent)
            if node.tag not in _DROP or node.tag == "form":
                chars[up] = chars.get(up, 0) + own
            if node.tag in _WHOLE or node.role == "main" or id(node) in holds:
                holds.add(up)
    page, inside = chars[id(nodes[0])], set()
    for node in nodes:
        up = node.parent
        if up is not None and (id(up) in inside or up.tag in _WHOLE or up.role == "main"):
            inside.add(id(node))
        most = id(node) in holds or 2 * chars[id(node)] > page
        if up is not None and up.cut:
            node.cut = True
        elif node.tag in ("html", "body", "#page"):
            node.cut = False
        elif id(node) in others:
            node.cut = True
        elif node.tag in _DROP - {"form"} or node.role in _DROP_ROLES - {"form"}:
            node.cut = True
        elif (node.tag == "form" or node.role == "form" or node.hidden) and not most:
            node.cut = True
        elif node.tag in _WHOLE or node.role == "main" or most:
            node.cut = False
        else:
            header = node.tag == "header" or "header" in node.names and node.tag == "div"
            node.cut = header and id(node) not in inside or not _DROP_NAMES.isdisjoint(node.names)


def density(chars: int, link_chars: int, tags: int, links: int, share: float) -> float:
    """Characters per tag, lowered by link text; ``share`` is the part of the page's text that stands in links."""
    bonus = log(1 + chars / max(1, link_chars) * tags / max(1, links))
    return chars / tags * bonus / log(e + chars * link_chars / max(1, chars - link_chars) + share * chars)


def _densities(nodes: list[Node]) -> None:
    """Density of every node and the sum over its children; a text is a child of its own."""
    for node in reversed(nodes):
        node.chars, node.link_chars, node.tags, node.links = 0, 0, 1, 0
        if node.unseen:
            continue
        for item in node.items:
            if type(item) is tuple:
                size = len(" ".join(item[0].split()))
                node.chars += size
                node.link_chars += size * item[1]
            elif item is True:
                node.links += 1
                node.tags += 1
            elif item is not None and not item.unseen:
                node.chars += item.chars
                node.link_chars += item.link_chars
                node.tags += item.tags
                node.links += item.links
    page = nodes[0]
    share = page.link_chars / max(1, page.chars)
    for node in nodes:
        node.density = 0.0 if node.unseen else density(node.chars, node.link_chars, node.tags, node.links, share)
    for node in nodes:
        node.sum = 0.0
        if not node.unseen:
            for item in node.items:
                if type(item) is tuple:
                    size = len(" ".join(item[0].split()))
                    node.sum += density(size, size * item[1], 1, int(item[1]), share)
                elif item is not None and item is not True:
                    node.sum += item.density


def _blocks(top: Node, out: list[str]) -> None:
    """Append the blocks of a subtree in page order."""
    text: list[str] = []

    def end() -> None:
        if text:
            block = " ".join(unescape("".join(text)).split())
            if block:
                out.append(block)
            text.clear()

    todo: list = [top]
    while todo:
        item = todo.pop()
        if item is None:
            end()
        elif type(item) is tuple:
            text.append(item[0])
        elif item is not True and not item.cut and not item.unseen:
            end()
            todo.append(None)
            todo.extend(reversed(item.items))
    end()


def choose(nodes: list[Node]) -> set[int]:
    """The subtrees that hold the main text: the one with the largest sum, and those of branches that reach the threshold."""
    live = [x for x in nodes if not x.cut and not x.unseen and x.chars]
    if not live:
        return set()
    best = max(live, key=lambda x: x.sum)
    threshold, node = best.density, best
    while node is not None:
        threshold = min(threshold, node.density)
        node = node.parent
    order = {id(x): k for k, x in enumerate(live)}
    most: dict[int, Node] = {}
    for x in reversed(live):  # the node with the largest sum in each subtree; of equal ones the outermost
        top = most.get(id(x), x)
        most[id(x)] = top = x if x.sum >= top.sum else top
        if x.parent is not None:
            up = most.get(id(x.parent))
            if up is None or top.sum > up.sum or top.sum == up.sum and order[id(top)] < order[id(up)]:
                most[id(x.parent)] = top
    return {id(best)} | {id(most[id(x)]) for x in live if x.density >= threshold}


def _headings(nodes: list[Node], chosen: set[int]) -> set[int]:
    """Headings in front of something chosen, with the element around them if that holds nothing else: too short to be dense, they go with it."""
    holds, last = set(chosen), {}
    for x in reversed(nodes):
        if id(x) in holds and x.parent is not None:
            holds.add(id(x.parent))
            last.setdefault(id(x.parent), id(x))
    found, passed = set(), set()  # parents whose last chosen child has come
    for x in nodes:
        if x.tag in _HEADINGS and x.chars and not x.cut and not x.unseen:
            top = x
            while top.parent is not None and top.parent.chars == x.chars and not top.parent.cut:
                top = top.parent
            up = None if top.parent is None else id(top.parent)
            if up in last and up not in passed:
                found.add(id(top))
        if x.parent is not None and last.get(id(x.parent)) == id(x):
            passed.add(id(x.parent))
    return found


def main_text(html: str) -> str:
    """The main text of a page: blocks joined by line feeds, white space in a block single; empty if there is none."""
    nodes = parse(html)
    _cut_off(nodes)
    _densities(nodes)
    chosen = choose(nodes)
    chosen |= _headings(nodes, chosen)
    out: list[str] = []
    covered: set[int] = set()
    for x in nodes:
        if x.cut or x.unseen:
            continue
        if x.parent is not None and id(x.parent) in covered:
            covered.add(id(x))
        elif id(x) in chosen:
            covered.add(id(x))
            _blocks(x, out)
    return "\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    A null html counts as empty and gives an empty text; repeated rows are separate pages; other columns are ignored.
    """

    def run(batches) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for batch in text_batches(whole):
                texts = [main_text(h or "") for h in batch.column(2).to_pylist()]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
