"""Main text of web pages by composite text density.

Every node of the page's tree gets its characters per tag, adjusted for links (composite text
density); a node's density sum adds up those of its children. The threshold is the smallest density
on the path from the body to the node of the largest sum. The subtree of the largest sum among the
nodes at or above it is the article; nodes in it that are no article by their tag or role (menus,
notices, forms, comments) are left out.

Edge cases: a null or empty page, or one without text, gives an empty text. Unclosed, misnested and
truncated markup is closed as browsers do for paragraphs, list items and cells. Pages are read whole.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import values

#: Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr img math mi mn mo ms mtext mrow msup "
                   "msub msubsup mfrac msqrt mroot mover munder munderover mspace mstyle semantics svg object "
                   "canvas".split())
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre ul ol td th tr tbody table figure dl dt dd".split())
#: Elements that end an svg or math left open.
BREAKS = frozenset("p div h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol table dl select div article section main body".split())
DROPPED = RAW | frozenset("head nav footer aside form button select option dialog menu input svg object "
                          "canvas".split())
#: Classes, ids and roles, as whole tokens, that name what is no part of an article.
NOTICES = re.compile(
    r"(?:ads?|adverts?|advertisement|advertising|banner|breadcrumbs?|comments?|cookies?|consent|disclaimer|"
    r"footer|gdpr|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|overlay|"
    r"pagination|pager|popup|promo|promoted|related|respond|replies|share|sharing|sidebar|signup|social|"
    r"sponsor|sponsored|subscribe|subscription|toolbar|widget|discussion|contentinfo|complementary|search|"
    r"alert)", re.I)
#: Tokens of several words whose words all are such names or say no more than where or how many.
COMPOUND = re.compile(rf"(?:{NOTICES.pattern}|area|bar|block|box|container|links?|list|main|page|posts?|section|"
                      r"site|left|right|top|bottom|wrap|wrapper|inner|\d+)", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
                   r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I | re.S)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
BLANK = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "attrs", "parent", "items", "chars", "tags", "link_chars", "link_tags", "density", "sum",
                 "holds")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent, self.items = tag, attrs, parent, []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0
        self.holds = False


class Open:
    """The open elements: `here` is the innermost, counts by name tell what is open without a walk.

    Names are counted in all, and since the innermost element of SCOPES.
    """

    def __init__(self, root: Node):
        self.root = self.here = root
        self.names: Counter[str] = Counter()
        self.scopes: list[Counter[str]] = [Counter()]

    def push(self, node: Node) -> None:
        self.here = node
        self.names[node.tag] += 1
        if node.tag in SCOPES:
            self.scopes.append(Counter())
        else:
            self.scopes[-1][node.tag] += 1

    def close(self, names: Iterable[str]) -> None:
        """Close up to the innermost open element of `names` and that one too."""
        while True:
            node = self.here
            self.here = node.parent
            self.names[node.tag] -= 1
            if node.tag in SCOPES:
                self.scopes.pop()
            else:
                self.scopes[-1][node.tag] -= 1
            if node.tag in names:
                return

    def close_in_scope(self, names: set[str]) -> None:
        if any(self.scopes[-1][n] for n in names):
            self.close(names)


def parse(page: str) -> Node:
    """The page's tree; `items` of a node are child nodes and decoded strings in page order."""
    root = Node("html", "", None)
    open_, at, size = Open(root), 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        stop = m.start() if m else size
        if stop > at:
            open_.here.items.append(html.unescape(page[at:stop]))
        if not m:
            break
        at, name = m.end(), m[2] and m[2].lower()
        if not name or name == "html" and not m[1] and open_.here is not root:
            continue
        if m[1]:
            if open_.names[name]:
                open_.close({name})
            continue
        if name in BREAKS and not open_.names["foreignobject"]:
            open_.close_in_scope({"svg", "math"})
        if name == "p" or name not in INLINE and name not in VOID and name not in RAW:
            open_.close_in_scope({"p"})
        if name in CLOSES:
            open_.close_in_scope(CLOSES[name])
        node = Node(name, m[3] or "", open_.here)
        open_.here.items.append(node)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
        elif name not in VOID and not (m[3] or "").endswith("/"):
            open_.push(node)
    return root


def _names_notice(token: str) -> bool:
    """Whether a class, id or role is a notice's: its first or last word names one, the others no other part."""
    words = [w for w in re.split(r"[_-]+", token) if w]
    if len(words) < 2:
        return bool(words) and bool(NOTICES.fullmatch(words[0]))
    if words[0].lower() in ("entry", "section", "article", "post", "content", "has", "no", "with", "without"):
        return False
    return all(COMPOUND.fullmatch(w) for w in words) and any(NOTICES.fullmatch(w) for w in words)


def _is_notice(node: Node) -> bool:
    """Whether a node is left out by its element, by being hidden, or by a name that its content bears out."""
    if node.tag in DROPPED:
        return True
    if not node.attrs:
        return False
    if HIDDEN.search(node.attrs):
        return True
    if node.tag in ("html", "body", "article", "main") or node.holds:
        return False
    names = [t for _, a, b, c in ATTRIBUTE.findall(node.attrs) for t in (a or b or c).split()]
    return any(_names_notice(t) for t in names)


def _mark_holders(root: Node) -> None:
    """Set `holds` where a name cannot make a node a notice.

    Such a node holds an article and lies in none; or, in a page without one, it holds nine tenths of
    the plain text, so that little would be left.
    """
    order, stack, inside = [], [(root, False)], set()
    while stack:
        node, within = stack.pop()
        order.append(node)
        if within:
            inside.add(id(node))
        within = within or node.tag in ("article", "main")
        stack.extend((c, within) for c in node.items if isinstance(c, Node) and c.tag not in DROPPED)
    plain: dict[int, int] = {}
    above: set[int] = set()
    for node in reversed(order):
        own = sum(len(BLANK.sub(" ", i).strip()) if isinstance(i, str) else plain.get(id(i), 0) for i in node.items)
        plain[id(node)] = 0 if node.tag == "a" else own
        if any(isinstance(c, Node) and (id(c) in above or c.tag in ("article", "main")) for c in node.items):
            above.add(id(node))
    for node in order:
        if above:
            node.holds = id(node) in above and id(node) not in inside
        else:
            node.holds = 10 * plain[id(node)] >= 9 * plain[id(root)] > 0
    if not above:
        _hold_largest(root, plain)


def _hold_largest(root: Node, plain: dict[int, int]) -> None:
    """Where one named node has nine times the plain text that is outside named ones, its name does not count."""
    named, stack = [], [root]
    while stack:
        node = stack.pop()
        for c in node.items:
            if isinstance(c, Node) and c.tag not in DROPPED:
                (named if _is_notice(c) else stack).append(c)
    most = max(named, key=lambda n: plain[id(n)], default=None)
    if most is not None and plain[id(most)] > 9 * (plain[id(root)] - sum(plain[id(n)] for n in named)):
        while most is not None:
            most.holds = True
            most = most.parent


def _outside_article(node: Node) -> bool:
    """A page's header; within an article a header holds its title."""
    if node.tag != "header":
        return False
    while node.parent is not None:
        node = node.parent
        if node.tag in ("article", "main"):
            return False
    return True


def _post_order(root: Node) -> list[Node]:
    """Nodes that may be part of an article, children first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.items if isinstance(c, Node)
                     and not (_is_notice(c) or _outside_article(c)))
    return order[::-1]


def _measure(root: Node) -> list[Node]:
    """Fill in characters, tags, densities and sums; what is left out counts as a tag without text."""
    _mark_holders(root)
    order = _post_order(root)
    for node in order:
        for item in node.items:
            if isinstance(item, str):
                node.chars += len(BLANK.sub(" ", item).strip())
            else:
                node.chars += item.chars
                node.tags += item.tags + 1
                node.link_chars += item.link_chars
                node.link_tags += item.link_tags
        if node.tag in ("a", "button"):
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
    body = root.chars or 1
    for node in order:
        node.density = _composite(node, root.link_chars / body)
        node.sum = sum(c.density for c in node.items if isinstance(c, Node)) or node.density
    return order


def _composite(node: Node, body_ratio: float) -> float:
    """Characters per tag times the logarithm of the characters over the links, base by link share."""
    if not node.chars:
        return 0.0
    tags, links = max(node.tags, 1), max(node.link_chars, 1)
    plain = max(node.chars - node.link_chars, 1)
    base = math.log(node.chars / plain * node.link_chars + body_ratio * node.chars + math.e)
    inner = node.chars / links * tags / max(node.link_tags, 1)
    return node.chars / tags * math.log(max(inner, 1.0) + 1) / max(math.log(base + 1), 1e-9)


def main_node(root: Node) -> Node:
    """The node of the largest density sum whose density reaches the threshold of the body's path."""
    order = _measure(root)
    best = max(order, key=lambda n: n.sum)
    threshold, node = best.density, best
    while node is not None and node.tag != "body":
        threshold, node = min(threshold, node.density), node.parent
    dense = [n for n in order if n.density >= threshold and n.tag not in INLINE]
    found = max(dense, key=lambda n: n.sum, default=best)
    # A block alone is a part of its article, and so is a section beside others as dense: step out.
    while found.parent is not None and found.tag not in ("body", "html") and (
            found.tag in INLINE | PARTS or _has_equal(found, threshold)):
        found = found.parent
    node = found
    while node is not None and node.tag not in ("article", "main"):
        node = node.parent
    return node or found


def _has_equal(node: Node, threshold: float) -> bool:
    """Whether a sibling is prose too: few links, and as dense or, below the body's top level, of the same kind."""
    inner = node.parent.tag not in ("body", "html")
    return any(isinstance(c, Node) and c is not node and c.chars and c.link_chars < c.chars / 3
               and (c.density >= threshold or inner and c.tag == node.tag) for c in node.parent.items)


def _blocks(root: Node) -> Iterable[str]:
    """Texts of the blocks below `root`, in page order; inline elements do not part them."""
    line: list[str] = []
    stack: list = [iter(root.items)]
    opened: list[Node] = [root]
    while stack:
        item = next(stack[-1], None)
        if item is None:
            stack.pop()
            if opened.pop().tag not in INLINE:
                yield "".join(line)
                line = []
        elif isinstance(item, str):
            line.append(item)
        elif item.tag in ("br", "hr"):
            yield "".join(line)
            line = []
        elif not (_is_notice(item) or _outside_article(item)):
            if item.tag not in INLINE:
                yield "".join(line)
                line = []
            stack.append(iter(item.items))
            opened.append(item)
    yield "".join(line)


def extract(page: str | None) -> str:
    """The main text: blocks with single spaces inside, joined by a space."""
    if not page:
        return ""
    blocks = (BLANK.sub(" ", b).strip() for b in _blocks(main_node(parse(page))))
    return " ".join(b for b in blocks if b)


def with_main_text(pages: DataFrame) -> DataFrame:
    """`pages` (html) with the string `main_text`."""
    @F.arrow_udf("string")
    def main_text(column: pa.Array) -> pa.Array:
        return pa.array([extract(p) for p in values(column)], pa.string())

    return pages.withColumn("main_text", main_text("html"))
