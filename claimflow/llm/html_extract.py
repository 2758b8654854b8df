"""Main text of web pages by scoring the tree of their elements.

A page is read into a tree that forgives open, crossed and cut-off tags. Parts that say what they are by their
tag, role or class (menus, sidebars, adverts, forms, comments, ...) are cut out. Every paragraph of the rest passes
points for its length and its commas to its ancestors, fewer to the farther ones, and a container's sum is
discounted by the share of its text that lies in links. The best container and those siblings that read like
it are kept, block by block in page order.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXTRACTED = "page_id long, url string, text string, n_chars long"

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"""
    r"""|<(?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/"'>]+)""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())  # read as raw text, to the end of the page where they are not closed
CUT = frozenset("noscript iframe noembed noframes xmp template svg".split())  # left out as a whole where they are closed
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# an element that opens closes an open one of these, unless one of the second lies between
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
P_SCOPE = frozenset("td th table button object caption body html".split())

# what a tag, role or class says of a part of a page that is not its article
OTHER_TAGS = frozenset("nav aside footer form button select menu dialog head fieldset input label object applet audio video canvas".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner banners promo promos promotion "
    "sponsor sponsored sponsors sidebar sidebars side aside rail nav navbar navigation menu menus breadcrumb "
    "breadcrumbs footer foot header masthead topbar cookie cookies consent gdpr notice notices alert alerts modal "
    "popup overlay newsletter subscribe subscription signup login signin share sharing social related recommended "
    "recommendations comment comments disqus respond replies reply discussion form search widget widgets pager "
    "pagination toolbar skip hidden".split()
)
LAYOUT = frozenset("has with no is without".split())
# words that say nothing of a part beside one of those above; any other word ("related work") makes it part of an article
NEUTRAL_WORDS = frozenset(
    "area article articles bar block body bottom box button buttons by container content count for global group icon icons "
    "inline inner item items left link links list main media more outer page panel post posts right row section site slot "
    "text title top unit us wrap wrapper".split()
)
GOOD_WORDS = frozenset("article content post entry main body story text page blog".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

WHOLE_POINTS = 25.0  # for a class that names an article
LEAST_POINTS = 1e-6  # what is less is not passed on
CONTAINERS = frozenset("div section article main body html".split())


class Node:
    __slots__ = ("attrs", "children", "links", "main", "parent", "score", "size", "tag")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.score, self.size, self.links, self.main = 0.0, 0, 0, False


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        name = m[1] or m[5]
        out.setdefault(name.lower(), unescape(m[2] or m[3] or m[4] or "") if m[1] else "")
    return out


def _names(attrs: dict[str, str]) -> list[list[str]]:
    return [[w.lower() for w in WORDS.findall(part)] for part in f"{attrs.get('class', '')} {attrs.get('id', '')}".split()]


def _is_other(node: Node) -> bool:
    """Whether the element names itself as something else than the article."""
    tag, attrs = node.tag, node.attrs
    if tag in ("html", "body", "main"):
        return False
    if tag in OTHER_TAGS or (tag == "header" and not _inside(node, ("article", "main"))):
        return True
    if not attrs:
        return False
    if attrs.get("role", "").lower() in OTHER_ROLES or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return True
    for words in _names(attrs):
        if words and words[0] not in LAYOUT and not OTHER_WORDS.isdisjoint(words):
            inside = _inside(node, ("article", "main"))
            # the heading of an article may stand in a "header" of its own
            if inside and OTHER_WORDS.intersection(words) == {"header"}:
                continue
            if inside and any(w.isalpha() and w not in OTHER_WORDS and w not in NEUTRAL_WORDS for w in words):
                continue
            return True
    return False


def _inside(node: Node, tags: tuple[str, ...]) -> bool:
    at = node.parent
    while at is not None:
        if at.tag in tags:
            return True
        at = at.parent
    return False


def parse(html: str) -> Node:
    """The tree of a page, without scripts and other elements that hold no text of it.

    An element of CUT that is never closed is no more than its tag: what follows is read as if it were not there.
    """
    root = Node("html", {}, None)
    stack, at, end = [root], 0, len(html)
    open_: Counter[str] = Counter()
    unclosed: set[str] = set()

    def text(piece: str) -> None:
        if piece:
            stack[-1].children.append(piece)

    def close(tags, barrier) -> None:
        if not any(open_[t] for t in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                open_.subtract(n.tag for n in stack[k:])
                del stack[k:]
                return
            if stack[k].tag in barrier:
                return

    while at < end:
        m = TAG.search(html, at)
        if m is None:
            text(unescape(html[at:]))
            break
        if m.start() > at:
            text(unescape(html[at : m.start()]))
        at = m.end()
        if m["data"]:
            text(m["data"])
        elif m["end"]:
            tag = m["end"].lower()
            if tag not in ("html", "body"):
                close((tag,), ("td", "th", "table") if tag not in BLOCKS else ())
        elif m["start"]:
            tag = m["start"].lower()
            if tag == "html":
                continue
            if tag in RAW or tag in CUT:
                if tag not in unclosed and not m["attrs"].rstrip().endswith("/"):
                    over = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
                    if over:
                        at = over.end()
                    elif tag in RAW:
                        at = end
                    else:
                        unclosed.add(tag)
                text(" ")
                continue
            if tag in BLOCKS:
                close(("p",), P_SCOPE)
            if tag in CLOSES:
                close(*CLOSES[tag])
            if tag in HEADINGS and stack[-1].tag in HEADINGS:
                open_[stack.pop().tag] -= 1
            if tag == "a":
                close(("a",), BLOCKS)
            if tag == "body":
                close(("head",), ())
            node = Node(tag, _attributes(m["attrs"]) if m["attrs"].strip() else {}, stack[-1])
            stack[-1].children.append(node)
            if tag not in VOID and not (m["attrs"].endswith("/") and tag not in BLOCKS):
                stack.append(node)
                open_[tag] += 1
    return root


def _prune(root: Node) -> list[Node]:
    """Cut out what is not the article. An element that holds the article stays, whatever it is called.

    Returns the elements, parents first; those cut out hold no text that counts.
    """
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node)]
    other = {}
    for node in order:
        other[id(node)] = _is_other(node)
        if node.tag in ("article", "main") and not other[id(node)]:
            up = node.parent
            while up is not None and not up.main:
                # comments may be articles of their own, inside a part that says so
                if other[id(up)] and (up.tag in OTHER_TAGS or any("comment" in w or "comments" in w for w in _names(up.attrs))):
                    break
                up.main = True
                up = up.parent
    for node in order:
        node.children = [
            c for c in node.children if not isinstance(c, Node) or c.main or not other[id(c)]
        ]
    return order


def _blocks(node: Node, out: list[tuple[Node, str, int]]) -> None:
    """Append (element, text, characters in links) for every block below, in page order."""
    parts: list[str] = []
    linked = [0]

    def flush(owner: Node) -> None:
        body = " ".join("".join(parts).split())
        if body:
            out.append((owner, body, min(linked[0], len(body))))
        parts.clear()
        linked[0] = 0

    # (element, next child, its block, inside a link)
    stack: list[list] = [[node, 0, node, False]]
    while stack:
        top = stack[-1]
        element, k, owner, link = top
        if k == len(element.children):
            if element.tag in BLOCKS:
                flush(owner)
            stack.pop()
            continue
        top[1] += 1
        child = element.children[k]
        if isinstance(child, str):
            parts.append(child)
            if link:
                linked[0] += len(" ".join(child.split()))
        elif child.tag == "br":
            parts.append(" ")
        elif child.tag in BLOCKS:
            flush(owner)
            stack.append([child, 0, child, link])
        else:
            stack.append([child, 0, owner, link or child.tag == "a"])


def _is_link_list(node: Node) -> bool:
    return node.tag in ("ul", "ol", "div", "section", "table", "dl") and node.size > 0 and node.links > 0.5 * node.size


def main_text(html: str) -> str:
    """The article's blocks, each on one line, joined by blank lines; empty if there is none."""
    root = parse(html)
    order = _prune(root)
    blocks: list[tuple[Node, str, int]] = []
    _blocks(root, blocks)
    if not blocks:
        return ""
    for owner, body, linked in blocks:
        points = (1.0 + body.count(",") + min(len(body) / 100, 3.0)) * (1 - linked / len(body))
        owner.size += len(body)
        owner.links += linked
        # an element that holds text of its own beside blocks is a container itself
        at = owner if owner.tag in CONTAINERS else owner.parent
        while at is not None and points > LEAST_POINTS:
            at.score += points
            points /= 2
            at = at.parent
    containers: dict[int, Node] = {}
    for owner, _, _ in blocks:
        at = owner if owner.tag in CONTAINERS else owner.parent
        while at is not None and id(at) not in containers:
            containers[id(at)] = at
            at = at.parent
    for node in reversed(order):  # children before their parents
        if node.parent is not None:
            node.parent.size += node.size
            node.parent.links += node.links

    def worth(node: Node) -> float:
        named = any(not GOOD_WORDS.isdisjoint(words) for words in _names(node.attrs)) or node.tag in ("article", "main")
        bonus = WHOLE_POINTS if named and node.tag not in ("html", "body") else 0.0
        return (node.score + bonus) * (1 - node.links / max(node.size, 1))

    best = max(containers.values(), key=worth)
    # a section is part of its article: go up to the element that is the whole of it
    up = best.parent
    while up is not None:
        if up.tag in ("article", "main") or up.attrs.get("itemprop", "").lower() == "articlebody":
            best = up
        up = up.parent
    kept, family = {id(best)}, best.parent
    if best.tag not in ("article", "main", "body", "html") and family is not None:
        least = max(10.0, 0.2 * worth(best))
        for sibling in family.children:
            if not isinstance(sibling, Node) or _is_link_list(sibling):
                continue
            reads = sibling.tag in ("p", "pre", "blockquote", *HEADINGS) and sibling.links <= 0.25 * sibling.size
            if reads or (id(sibling) in containers and worth(sibling) >= least):
                kept.add(id(sibling))
    elif best.tag in ("article", "main") and family is not None:
        kept |= {id(s) for s in family.children if isinstance(s, Node) and s.tag == best.tag and s.score >= 0.2 * best.score}

    stays: dict[int, bool] = {}
    for node in order:  # parents first
        if id(node) in kept:
            stays[id(node)] = True
        elif _is_link_list(node) and sum(isinstance(c, Node) for c in node.children) > 1 and not _inside(node, ("article", "main")):
            stays[id(node)] = False
        else:
            stays[id(node)] = node.parent is not None and stays[id(node.parent)]
    return "\n\n".join(body for owner, body, _ in blocks if stays[id(owner)])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of `pages`: page_id, url, text (empty if there is none) and n_chars, its code points.

    A null html counts as empty; null ids and urls are kept. Nothing is cut from long pages. Repeated rows stay rows of
    their own. An empty table gives no rows. Other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1).cast(pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(page_id).cast("long"), F.col(url).cast("string"), F.col(html).cast("string"))
    return rows.mapInArrow(run, EXTRACTED)
