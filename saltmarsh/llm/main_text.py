"""Main text of web pages by composite text density over the DOM."""

from __future__ import annotations

import math
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm.common import slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li link main menu nav ol option p pre section select summary "
    "table tbody td textarea tfoot th thead title tr ul".split())
#: A start tag of the first kind ends an open element of the second.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
CLOSES_P = BLOCK - {"br", "button", "select", "option", "textarea", "title", "link", "legend", "caption", "summary"}
#: Elements that an implied end does not reach across.
WALLS = frozenset("table td th article section main div ul ol dl body html blockquote aside nav footer header form".split())
#: Elements that are never part of an article.
NOISE = frozenset(
    "script style noscript template svg math head title nav footer aside button select option textarea iframe object canvas "
    "dialog menu audio video".split())
#: Words that name what is around an article, in classes, ids and roles.
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments respond disqus consent cookie cookies "
    "gdpr notice notices alert popup modal overlay newsletter subscribe signup login search share sharing social related recommended promo "
    "promoted sponsor sponsored sidebar widget widgets menu nav navbar navigation masthead footer pagination pager toolbar skip".split())
#: Words that make a class a state of the page or a place in it, such as ``with-sidebar``, ``comments-open`` or ``comment-list``.
STATES = frozenset("with without has have no not is are on off open opened closed enabled disabled active ready results".split())
PLACES = frozenset(
    "site page main top bottom left right primary secondary post entry user reader list lists area section box wrapper wrap container bar block "
    "inner outer form link links item items group content body header title text thread global".split())
NOISE_ROLE = frozenset("navigation banner contentinfo complementary search alert dialog menu form".split())
ARTICLE = frozenset(("article", "main"))
HIDDEN, NAMED, HINTED = 3, 2, 1  # never text; named as noise; a hint of it
MOST, NEARLY_ALL = 0.5, 0.9  # of the text of a page outside links


class Node:
    __slots__ = ("tag", "parent", "children", "mark", "noise", "holds", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, mark: int) -> None:
        self.tag, self.parent, self.mark = tag, parent, mark
        self.children: list[Node | str] = []
        self.noise = self.holds = False
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _named(value: str) -> int:
    """What the classes or the id of an element say: a whole name is ``NAMED``, a name among other words only ``HINTED``."""
    found = 0
    for name in value.lower().replace("_", "-").split():
        words = [w.rstrip("0123456789") for w in name.split("-")]
        if NOISE_NAMES.isdisjoint(words) or not STATES.isdisjoint(words):
            continue
        rest = [w for w in words if w and w not in NOISE_NAMES]
        found = max(found, NAMED if PLACES.issuperset(rest) else HINTED)
    return found


def _mark(tag: str, attrs: list[tuple[str, str | None]], inside_article: bool) -> int:
    if tag in NOISE or tag == "header" and not inside_article:
        return HIDDEN
    found = HINTED if tag == "form" else 0
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return HIDDEN
        if not value:
            continue
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return HIDDEN
        if name in ("class", "id") and tag not in ("body", "html", "article", "main"):
            found = max(found, _named(value))
        if name == "role" and value.lower() in NOISE_ROLE:
            found = NAMED
    return found


class Tree(HTMLParser):
    """The DOM of one page; missing end tags are implied, stray ones are ignored, comments are left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("html", None, 0)
        self.articles = 0

    def _leave(self, node: Node) -> None:
        """Everything open down to and including ``node`` ends."""
        while self.here is not node:
            self.articles -= self.here.tag in ARTICLE
            self.here = self.here.parent
        self.articles -= node.tag in ARTICLE
        self.here = node.parent

    def _imply(self, tags: set[str]) -> None:
        node = self.here
        while node.parent is not None and node.tag not in tags:
            if node.tag in WALLS:
                return
            node = node.parent
        if node.parent is not None:
            self._leave(node)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body") and (tag == "html" or any(True for n in self._open() if n.tag == "body")):
            return
        if tag == "body":
            while self.here.parent is not None:
                self._leave(self.here)
        if tag in CLOSES_P:
            self._imply({"p"})
        if tag in ENDS:
            for _ in range(3):
                self._imply(ENDS[tag])
        node = Node(tag, self.here, _mark(tag, attrs, self.articles > 0))
        self.here.children.append(node)
        if tag not in VOID:
            self.here = node
            self.articles += tag in ARTICLE

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML knows no self-closing element but the void ones

    def _open(self) -> Iterator[Node]:
        node = self.here
        while node.parent is not None:
            yield node
            node = node.parent

    def handle_endtag(self, tag: str) -> None:
        if tag in ("body", "html"):
            return
        for node in self._open():
            if node.tag == tag:
                self._leave(node)
                return
            if tag in ("p", "li", "b", "i", "a", "span", "em", "strong") and node.tag in WALLS:
                return

    def handle_data(self, data: str) -> None:
        self.here.children.append(data)


def _ordered(root: Node) -> list[Node]:
    """All nodes, parents before their children, without recursion."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        found.append(node)
        todo.extend(c for c in node.children if isinstance(c, Node))
    return found


def _count(nodes: list[Node]) -> None:
    """Characters and tags of every node, in links and in all; noise has no characters."""
    hidden: set[Node] = set()
    for node in nodes:
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        if node.noise or node.parent in hidden:
            hidden.add(node)
    for node in reversed(nodes):
        if node not in hidden:
            node.chars += sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str))
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        node.holds = node.holds or node.tag in ARTICLE or node.tag == "h1"
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
            up.holds = up.holds or node.holds


def _judge_marks(nodes: list[Node]) -> None:
    """Which marked nodes are noise.  Names are evidence only, and a node with most of the page's text outside links is a wrapper.

    A hinted node is noise up to half of that text.  A named one is noise up to
    nine tenths of it, as comments can be longer than their article; but with
    the headline or an ``article`` inside, half is enough to keep it.
    """
    for node in nodes:
        node.noise = node.mark == HIDDEN
    if any(0 < node.mark < HIDDEN for node in nodes):
        _count(nodes)
        whole = max(nodes[0].chars - nodes[0].link_chars, 1)
        for node in nodes:
            if 0 < node.mark < HIDDEN:
                share = (node.chars - node.link_chars) / whole
                node.noise = share <= (MOST if node.mark == HINTED or node.holds else NEARLY_ALL)


def measure(root: Node) -> None:
    """Composite density and density sum of every node.

    Density is characters per tag, raised where few of the characters and tags
    belong to links; the sum of a node adds the densities of its children.
    """
    nodes = _ordered(root)
    _judge_marks(nodes)
    _count(nodes)
    share = root.link_chars / max(root.chars, 1)
    for node in nodes:
        node.total = 0.0
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, share)
    for node in nodes:
        if node.parent is not None:
            node.parent.total += node.density


def density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters per tag times a logarithm of how few of both are links; ``share`` is that of link characters in the page."""
    if not chars:
        return 0.0
    tags = max(tags, 1)
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + share * chars + math.e)
    links = max(chars / max(link_chars, 1) * tags / max(link_tags, 1), 1.0) + 1e-9
    return max(chars / tags * math.log(links, max(base, 1.0 + 1e-9)), 0.0)


def select(root: Node) -> Node:
    """The subtree with the largest density sum, widened by the body-path threshold.

    The threshold is the least density on the way from that subtree to the
    body.  The choice moves up while the parent has further children at or above
    the threshold.  Then an ``article`` or ``main`` settles where density leaves
    it open: one around the choice that has less than twice its text, or the
    one inside it with nearly all of its text, is taken instead.
    """
    nodes = [n for n in _ordered(root) if n.chars]
    if not nodes:
        return root
    best = max(nodes, key=lambda n: n.total)
    threshold, node = best.density, best
    while node is not None:
        threshold, node = min(threshold, node.density), node.parent
    chosen = best
    while chosen.parent is not None and any(
        isinstance(c, Node) and c is not chosen and c.chars and c.density >= threshold for c in chosen.parent.children
    ):
        chosen = chosen.parent
    around, node = None, chosen
    while node is not None:
        if node.tag in ARTICLE and not node.noise and node.chars < 2 * chosen.chars:
            around = node
        node = node.parent
    if around is not None:
        return around
    inside = [n for n in nodes if n.tag in ARTICLE and n.chars > NEARLY_ALL * chosen.chars and _below(n, chosen)]
    return inside[0] if inside else chosen


def _below(node: Node | None, top: Node) -> bool:
    while node is not None and node is not top:
        node = node.parent
    return node is top


def _link_list(node: Node) -> bool:
    """A block of three or more links with hardly any other text."""
    return node.tag in ("ul", "ol", "div", "table", "section", "dl") and node.link_tags >= 3 and node.link_chars >= 0.8 * node.chars > 0


def text_of(node: Node) -> str:
    """Text of the subtree without its noise; blocks are apart by one space, inline elements are not."""
    out: list[str] = []
    todo: list[Node | str] = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        if item.tag in BLOCK:
            out.append(" ")
        if item is not node and (item.noise or _link_list(item)):
            continue
        if item.tag in BLOCK:
            todo.append(" ")
        todo.extend(reversed(item.children))
    return " ".join("".join(out).split())


def main_text(html: str | None) -> str:
    tree = Tree()
    tree.feed(html or "")
    tree.close()
    measure(tree.root)
    return text_of(select(tree.root))


def extract(pages: DataFrame) -> DataFrame:
    """Per page: ``page_id``, ``url``, ``text`` (empty if there is none) and ``n_chars``.

    Null html counts as empty.  Equal pages give equal texts, an empty table
    gives no rows, and columns other than the three are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text="html"):
            found = [main_text(html) for html in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    plain = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    return plain.mapInArrow(run, "page_id long, url string, text string, n_chars long")
