"""Main text of web pages by composite text density.

The page is read into a tree of elements. Elements that never hold article text (scripts, menus,
form controls, hidden parts) and reader comments are left out. Other names of menus, page headers
and footers, sidebars, notices and adverts are only names: a named part that alone holds the page's
article, main or first-rank heading, and in it the core by density, stands around the article and
stays; the others go. A name that is only a piece of a class or id, and a form, are measured with
the rest, and left out only where they do not hold the core; pieces of names inside the core also
only where their density is below the threshold. A page of which nothing is left is
read again with all names taken as pieces. Every remaining node has its characters and tags and
those of its links, and from them a composite density: characters per tag, raised where little of
them is link text. The node whose
children's densities have the greatest sum is the core of the article; the least density on the
path from the body down to it is the threshold that its surroundings must reach to belong to the
article as well. An ``article`` or ``main`` element around the core bounds the article; lists of
links inside it that lie below the threshold are left out.

Text comes out as blocks: character references decoded within each run of text, white space made one space, ends trimmed,
blocks joined by a line feed in page order. Nothing is cut or limited in number.

Defined cases: a null page or one without text has empty text; unclosed or stray tags, unclosed
comments and quotes are read like a lenient browser would; repeated rows are worked on again; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinledger.llm.common import text_of

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?/](?![a-zA-Z])[^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"']+))?", re.S)
RAW = frozenset("script style textarea title noscript iframe template xmp noframes".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr basefont frame".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that never hold article text.
DROPPED = frozenset(
    "script style noscript template iframe title head nav footer aside form button select option "
    "input textarea label output legend datalist meter progress svg canvas object embed audio video "
    "map menu dialog noframes xmp".split()
)
#: Words in class, id or role that name such a part.
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle adbox sponsor sponsored promo "
    "promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidenav aside "
    "complementary widget widgets footer contentinfo header masthead topbar toolbar cookie cookies consent gdpr notice notices notification "
    "newsletter subscribe subscription signup login modal popup overlay share sharing social related "
    "recommended pagination pager skip search form alert paywall copyright".split()
)
#: The same for reader comments, and words beside them that tell a state of the page.
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
STATES = frozenset("no has with open closed enabled disabled".split())
KEPT_ANYWAY = frozenset("html body article main".split())
MARKS = frozenset("article main h1".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p blockquote pre ul ol dl table figure".split())
LISTS = frozenset("ul ol dl div section table tbody tr td".split())
#: An open element of the first kind ends where one of the second kind begins.
ENDS = {
    "p": BLOCKS,
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "thead", "tfoot"}),
    "td": frozenset({"td", "th", "tr"}),
    "th": frozenset({"td", "th", "tr"}),
    "option": frozenset({"option", "optgroup"}),
}


class Node:
    __slots__ = ("tag", "attributes", "parent", "parts", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.parts: list[Node | str] = []

    def children(self) -> Iterator[Node]:
        return (part for part in self.parts if isinstance(part, Node))

    def above(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent


def parse(page: str) -> Node:
    root = Node("html", {}, None)
    open_node, at = root, 0
    while (found := TOKEN.search(page, at)) is not None:
        if found.start() > at:
            open_node.parts.append(page[at : found.start()])
        at = found.end()
        tag = found["tag"] or found["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if found["end"] or found["end2"]:
            open_node = closed(open_node, tag)
            continue
        attributes = attributes_of(found["rest"] or found["rest2"] or "")
        if tag in ("html", "body"):
            if tag == "body" and not any(n.tag == "body" for n in (open_node, *open_node.above())):
                body = Node("body", attributes, root)
                root.parts.append(body)
                open_node = body
            continue
        for held, by in ENDS.items():
            if tag in by:
                open_node = ended(open_node, held)
        node = Node(tag, attributes, open_node)
        open_node.parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            stop = end.start() if end else len(page)
            node.parts.append(page[at:stop])
            at = stop
            open_node = node
        elif tag not in VOID and not (found["rest"] or "").endswith("/"):
            open_node = node
    if at < len(page):
        open_node.parts.append(page[at:])
    return root


def attributes_of(rest: str) -> dict[str, str]:
    if not rest.strip(" /\n\t"):
        return {}
    return {
        name.lower(): html.unescape(value.strip("\"'")) for name, value in ATTRIBUTE.findall(rest)
    }


def closed(node: Node, tag: str) -> Node:
    """The open element after an end tag; one without a beginning changes nothing."""
    for held in (node, *node.above()):
        if held.tag == tag:
            return held.parent or held
        if tag not in BLOCKS and held.tag in BLOCKS:
            return node  # an inline end tag does not end blocks
    return node


def ended(node: Node, tag: str) -> Node:
    """The open element after an implied end of the nearest ``tag``, if no other block is between."""
    for held in (node, *node.above()):
        if held.tag == tag:
            return held.parent or held
        if held.tag in BLOCKS:
            return node
    return node


def removed(node: Node) -> bool:
    """By its tag or hidden, or as reader comments."""
    if node.tag not in KEPT_ANYWAY and (
        node.tag in DROPPED and node.tag != "form" or hidden(node.attributes)
    ):
        return True
    return bool(node.attributes) and node.tag not in ("html", "body", "main") and commented(node)


def commented(node: Node) -> bool:
    """A class, id or role speaks of comments, not of whether a page has any."""
    if node.tag == "article":
        return not names_of(node).isdisjoint(COMMENTS)
    pieces = [set(re.split("[^a-z]+", name)) for name in names_of(node)]
    return any(not p.isdisjoint(COMMENTS) and p.isdisjoint(STATES) for p in pieces)


def named(node: Node, names: set[str]) -> bool:
    """By these of its names it is something else than the article."""
    if node.tag in KEPT_ANYWAY:
        return False
    header = node.tag == "header" or "header" in names
    if header and in_article(node) and titled(node):
        return False  # the article's own head
    return header or not names.isdisjoint(NAMED)


def names_of(node: Node, between: str = r"\s+") -> set[str]:
    """Whole class names, id and roles, or their pieces."""
    a = node.attributes
    if not a:
        return set()
    text = f"{a.get('class', '')} {a.get('id', '')} {a.get('role', '')}".lower()
    return set(re.split(between, text))


def pieces_of(node: Node) -> set[str]:
    return names_of(node, "[^a-z]+")


def hidden(attributes: dict[str, str]) -> bool:
    style = attributes.get("style", "").replace(" ", "").lower()
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").lower() == "true"
        or "display:none" in style
        or "visibility:hidden" in style
    )


def in_article(node: Node) -> bool:
    return any(held.tag in ("article", "main") for held in node.above())


def titled(node: Node) -> bool:
    waiting = [node]
    while waiting:
        children = list(waiting.pop().children())
        if any(c.tag in HEADINGS for c in children):
            return True
        waiting += children
    return False


def pruned(root: Node, out: Callable[[Node], bool]) -> list[Node]:
    """Take out what is named as something else; the nodes left, parents first."""
    kept, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        kept.append(node)
        node.parts = [p for p in node.parts if isinstance(p, str) or not out(p)]
        waiting.extend(reversed(list(node.children())))
    return kept


def around(nodes: list[Node], others: set[Node]) -> set[Node]:
    """Named nodes that hold the only article of the page and its core: they stay."""
    marks = [n for n in nodes if n.tag in MARKS and n not in others]
    held = {m: others.intersection(m.above()) for m in marks} if others else {}
    if not any(held.values()):
        return set()
    measure(nodes)
    if any(m.chars and not names for m, names in held.items()):
        return set()
    best = max((n for n in nodes if n.tag not in ("html", "body")), key=lambda n: n.total)
    return set().union(*held.values()).intersection((best, *best.above()))


def article_nodes(page: str) -> list[Node]:
    """The measured nodes of a page without what surely, or by its density, is something else."""
    root = parse(page)
    nodes = pruned(root, removed)
    others = {n for n in nodes[1:] if named(n, names_of(n))}
    others -= around(nodes, others)
    nodes = pruned(root, others.__contains__)
    measure(nodes)
    if not root.chars:
        root = parse(page)
        nodes = pruned(root, lambda n: removed(n) or named(n, set()))
        measure(nodes)
    doubtful = {n for n in nodes[1:] if n.tag == "form" or named(n, pieces_of(n))}
    inner = [n for n in nodes if n.tag not in ("html", "body") and n.chars]
    if not doubtful or not inner:
        return nodes
    best = max(inner, key=lambda n: n.total)
    path = {best, *best.above()}
    threshold = min(n.density for n in path if n.tag not in ("html", "body"))
    inside = {best}
    for node in nodes:  # parents first
        if node.parent in inside:
            inside.add(node)

    def other(node: Node) -> bool:
        if node not in doubtful or node in path:
            return False
        return node.tag == "form" or node not in inside or node.density < threshold

    nodes = pruned(root, other)
    measure(nodes)
    return nodes


def measure(nodes: list[Node]) -> None:
    """Characters, tags, link characters and link tags; then densities and their sums."""
    for node in reversed(nodes):
        own = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        node.chars = own + sum(c.chars for c in node.children())
        node.tags = sum(c.tags + 1 for c in node.children())
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, 1 + node.tags
        else:
            node.link_chars = sum(c.link_chars for c in node.children())
            node.link_tags = sum(c.link_tags for c in node.children())
    body = nodes[0]
    linked = body.link_chars / max(body.chars, 1)
    for node in reversed(nodes):
        c, t = node.chars, max(node.tags, 1)
        lc, lt = max(node.link_chars, 1), max(node.link_tags, 1)
        base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + linked * c + math.e)
        node.density = c / t * math.log1p(c / lc * t / lt) / (1 + math.log(max(base, 1)))
        own = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        node.total = own + sum(x.density for x in node.children())


def core(nodes: list[Node]) -> list[Node | str]:
    """The subtrees (and text between them) that make up the article, in page order."""
    inner = [n for n in nodes if n.tag not in ("html", "body") and n.chars]
    if not inner:
        return nodes[:1]
    best = max(inner, key=lambda n: n.total)
    path = [best, *(n for n in best.above() if n.tag not in ("html", "body"))]
    threshold = min(n.density for n in path)
    for tag in ("article", "main"):
        bounds = [n for n in path if n.tag == tag]
        if bounds:
            pruned(bounds[-1], lambda n: n not in path and link_list(n) and n.density < threshold)
            return bounds[-1:]
    top = best
    while top.parent is not None and top.parent.tag not in ("html", "body"):
        beside = [c for c in top.parent.children() if c is not top and c.chars]
        if not all(belongs(c, threshold) for c in beside):
            break
        top = top.parent
    if top.parent is None:
        return [top]
    return [
        c
        for c in top.parent.parts
        if isinstance(c, str) or c is top or (c.chars and belongs(c, threshold))
    ]


def link_list(node: Node) -> bool:
    return node.tag in LISTS and node.link_tags > 1 and node.link_chars * 2 > node.chars


def belongs(node: Node, threshold: float) -> bool:
    return node.tag in PROSE and node.link_chars * 2 <= node.chars or node.density >= threshold


def blocks(node: Node | str, out: list[list[str]]) -> None:
    """Append the text of a subtree to the last block, opening blocks where elements ask."""
    waiting: list[Node | str | None] = [node]
    while waiting:
        part = waiting.pop()
        if part is None:
            out.append([])
        elif isinstance(part, str):
            out[-1].append(html.unescape(part))
        elif part.tag == "br":
            out.append([])
        else:
            block = part.tag in BLOCKS
            if block:
                out.append([])
                waiting.append(None)
            waiting.extend(reversed(part.parts))


def main_text(page: str) -> str:
    nodes = article_nodes(page)
    out: list[list[str]] = [[]]
    for node in core(nodes):
        blocks(node, out)
    lines = (" ".join("".join(block).split()) for block in out)
    return "\n".join(line for line in lines if line)


def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [main_text(page) for page in batch["html"].to_pylist()]
        sizes = pa.array([len(t) for t in found], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(found, pa.string()), sizes],
            ["page_id", "url", "text", "n_chars"],
        )


def extracted(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text, n_chars)."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", text_of("html").alias("html")).mapInArrow(texts, schema)
