"""Main text of web pages by tree scoring.

A page becomes a tree of elements. Elements that are never article text by their tag, role or being
hidden (scripts, menus, headers, footers, asides, forms) are left out. Every run of text between block
boundaries is a block. A paragraph passes points for its length and its commas to its parent, half of
them to the next ancestor and so on; a container's points shrink by the share of its text that is
links. The best container is kept, widened to the ``article`` or ``main`` element around it, along with
siblings that score a fifth of it or read like running text. Their blocks, in page order, are the text.

A class or id leaves an element out only where one of its tokens names boilerplate as a whole: every
part of the token is a word for boilerplate or for layout (``ad``, ``site-footer``, ``related-posts``,
but not ``has-sidebar``, ``related-work`` or ``notice-period``). On a page without an ``article`` or ``main``
element elsewhere, an element that holds most of the running text is kept in spite of its name, unless
that is one of adverts, consent or reader comments.

Nothing is cut: pages of any size and depth are walked without recursion, in time linear in the page.
Defined results: a null or empty page, or one with boilerplate alone, gives an empty text; repeated rows
and ids give a row each; null ids and addresses stay null; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import quoted
from .common import by_slice

# Element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes")
DROPPED = frozenset((
    *RAW, *"head nav header footer aside form button select svg math canvas template dialog object menu "
    "datalist audio video map".split(),
))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output q rp "
    "rt ruby s samp small span strike strong sub sup time tt u var wbr img picture".split()
)
# A start tag of the key closes an open element of the value, up to the nearest of its scope.
CLOSES = {
    "li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)), "tr": (("tr",), ("table",)),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)), "option": (("option",), ("select",)),
}
P_SCOPE = ("table", "td", "th", "button", "object")
CONTAINERS = frozenset(("article", "main"))
WHOLE = frozenset(("html", "body", "article", "main", "#root"))

# Words of a class or id, and roles, of parts that are not article text; words for layout.
NEVER = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr "
    "comment comments disqus reply replies respond".split()
)
UNLIKELY = NEVER | frozenset(
    "banner notice notices alert sidebar nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead "
    "share sharing social related recommended newsletter subscribe subscription signup login popup modal "
    "overlay promo promotion toolbar pager pagination widget copyright hidden skip teaser".split()
)
LAYOUT = frozenset(
    "site page main global top bottom left right center inner outer box block list item items area section "
    "container wrapper wrap bar panel column col row primary secondary header button buttons link links content "
    "text body post posts article articles user reader form title label icon icons inline mobile desktop sticky "
    "fixed thread slot unit zone".split()
)
PAGE_HEADERS = frozenset(("header", "site-header", "page-header", "siteheader", "pageheader", "top-bar", "topbar"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())

_RAW_NAMES = "|".join(RAW)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW_NAMES})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>"
    r"|<[/!?a-z][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


# How sure a name is that an element is not article text.
LIKELY, NAMED, CERTAIN = range(3)
PARAGRAPHS = frozenset(("p", "pre", "blockquote"))


class Node:
    """An element. ``up`` is the nearest block element around it; ``named`` what its class or id says."""

    __slots__ = ("tag", "up", "skip", "named", "in_link", "inside", "chars", "linked", "points", "gone", "kept")

    def __init__(self, tag: str, parent: Node | None, skip: bool, named: int):
        self.tag, self.skip, self.named = tag, skip, named
        self.up = None if parent is None else parent.up if parent.tag in INLINE else parent
        self.in_link = tag == "a" or parent is not None and parent.in_link
        self.inside = tag in CONTAINERS or parent is not None and parent.inside
        self.chars = self.linked = 0
        self.points = 0.0
        self.gone = self.kept = False


class Block:
    """A run of text between two block boundaries."""

    __slots__ = ("owner", "parts", "linked", "text")

    def __init__(self, owner: Node):
        self.owner, self.parts, self.linked, self.text = owner, [], 0, ""


def token_names(token: str) -> int:
    """Whether a class or id token as a whole names boilerplate, and how surely."""
    parts = [w.lower() for w in _PART.findall(token)]
    if not parts or not all(w in UNLIKELY or w in LAYOUT or w.isdigit() for w in parts):
        return LIKELY
    return CERTAIN if NEVER.intersection(parts) else NAMED if UNLIKELY.intersection(parts) else LIKELY


def _judged(tag: str, attrs: str, inside: bool) -> tuple[bool, int]:
    """Whether an element is left out for good, and what its class and id name it."""
    named = LIKELY
    if tag in DROPPED:
        return True, named
    if not attrs or attrs.isspace():
        return False, named
    for name, *values in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), next(filter(None, values), "")
        if name in ("class", "id"):
            if tag in WHOLE and tag != "article":
                continue
            tokens = value.split()
            named = max([named, *map(token_names, tokens)])
            if not inside and tag != "article" and PAGE_HEADERS.intersection(t.lower() for t in tokens):
                named = max(named, NAMED)
        elif name == "role" and value.lower() in ROLES:
            return True, named
        elif tag not in WHOLE and (
            name == "hidden" or name == "aria-hidden" and value.lower() == "true"
            or name == "style" and "display:none" in value.lower().replace(" ", "")
        ):
            return True, named
    return False, named


class _Stack(list):
    """Open elements, innermost last, and where those of each tag lie."""

    def __init__(self, root: Node):
        super().__init__()
        self.places: defaultdict[str, list[int]] = defaultdict(list)
        self.push(root)

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self))
        self.append(node)

    def innermost(self, *tags: str) -> int:
        return max((self.places[t][-1] for t in tags if self.places[t]), default=-1)

    def cut(self, at: int) -> None:
        while len(self) > at:
            self.places[self.pop().tag].pop()

    def close(self, tags: tuple[str, ...], scope: tuple[str, ...]) -> None:
        """Closes the innermost open element of ``tags`` unless one of ``scope`` is nearer."""
        at = self.innermost(*tags)
        if at > self.innermost(*scope):
            self.cut(at)


def blocks_of(page: str) -> tuple[list[Block], list[Node]]:
    """The page's text blocks outside skipped elements, and all block elements, in page order."""
    root = Node("#root", None, False, LIKELY)
    stack, blocks, nodes = _Stack(root), [], [root]
    barrier = [0]  # where the open block elements lie
    current: Block | None = None
    for token in _TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            top = stack[-1]
            if top.skip:
                continue
            if current is None:
                if text.isspace():
                    continue
                current = Block(top.up if top.tag in INLINE else top)
                blocks.append(current)
            current.parts.append(text)
            if top.in_link:
                current.linked += len(text)
            continue
        tag = token["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag not in INLINE and tag != "br":
            current = None
        if token["close"]:
            at = stack.innermost(tag)
            if at > (barrier[-1] if tag in INLINE else 0):
                stack.cut(at)
        elif tag == "br":
            if current is not None:
                current.parts.append(" ")
        else:
            if tag not in INLINE:
                stack.close(("p",), P_SCOPE)
                if tag in CLOSES:
                    stack.close(*CLOSES[tag])
            if tag not in VOID:
                parent, attrs = stack[-1], token["attrs"]
                skip, named = (True, LIKELY) if parent.skip else _judged(tag, attrs, parent.inside)
                node = Node(tag, parent, skip, named)
                if tag not in INLINE:
                    nodes.append(node)
                stack.push(node)
        while barrier[-1] >= len(stack):
            barrier.pop()
        if stack[-1].tag not in INLINE and barrier[-1] != len(stack) - 1:
            barrier.append(len(stack) - 1)
    return blocks, nodes


def _weigh(blocks: list[Block], nodes: list[Node]) -> None:
    """Adds up each element's characters and points, from its blocks and then once from each element
    to the one around it."""
    for node in nodes:
        node.chars = node.linked = 0
        node.points = 0.0
    for block in blocks:
        owner = block.owner
        if owner.gone:
            continue
        owner.chars += len(block.text)
        owner.linked += min(block.linked, len(block.text))
        if not (owner.tag.startswith("h") or owner.tag == "li"):
            scores = owner.up if owner.tag in PARAGRAPHS else owner
            scores.points += 1.0 + block.text.count(",") + min(len(block.text) // 100, 3)
    for node in reversed(nodes):
        if node.up is not None and not node.gone:
            node.up.chars += node.chars
            node.up.linked += node.linked
            node.up.points += node.points / 2


def _score(node: Node) -> float:
    return node.points * (1 - node.linked / node.chars)


def main_text(page: str) -> str:
    """The article of a page: its blocks, a line each."""
    blocks, nodes = blocks_of(page)
    for block in blocks:
        block.text = " ".join(html.unescape("".join(block.parts)).split())
    blocks = [b for b in blocks if b.text]
    if any(n.named for n in nodes):
        _weigh(blocks, nodes)
        for node in nodes:
            node.kept = node.named == LIKELY and (node.up is None or node.up.kept)
        # Where no article or main element is left, most of the running text stays.
        running = nodes[0].chars - nodes[0].linked
        if any(n.kept and n.chars and n.tag in CONTAINERS for n in nodes):
            running = 2 * running
        for node in nodes:
            most = 2 * (node.chars - node.linked) > running
            outer = node.up is not None and node.up.gone
            node.gone = outer or node.named == CERTAIN or node.named == NAMED and not most
            node.kept = False
    _weigh(blocks, nodes)
    able = [n for n in nodes if n.chars and not n.gone and n.tag not in PARAGRAPHS]
    best = max(able, key=_score, default=None)
    if best is None:
        return ""
    if _score(best) == 0:
        best = next((n for n in able if n.tag in CONTAINERS), best)
    around, node = None, best
    while node is not None:
        if node.tag == "article" or node.tag == "main" and around is None:
            around = node
        node = node.up
    best = around or best
    floor = _score(best) / 5
    best.kept = True
    for node in nodes:
        if node.gone:
            continue
        if node.up is not None and node.up.kept:
            node.kept = True
        elif node.chars and best.up is not None and node.up is best.up and not node.kept:
            reads_on = node.tag == "p" and node.chars > 80 and node.linked < 0.25 * node.chars
            node.kept = reads_on or node.tag not in PARAGRAPHS and _score(node) >= floor
    return "\n".join(b.text for b in blocks if b.owner.kept and not b.owner.gone)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; no shuffle."""
    pages = df.select(
        quoted(id_col).alias("page_id"), quoted(url_col).alias("url"), F.coalesce(quoted(html_col), F.lit("")).alias("html")
    )

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [main_text(page) for page in batch.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

        return work

    id_type = pages.schema["page_id"].dataType.simpleString()
    return by_slice(pages, make, f"page_id {id_type}, url string, text string, n_chars bigint")
