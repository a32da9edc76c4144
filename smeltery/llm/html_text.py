"""Main text of web pages by tree scoring.

A page is read into a tree. Each paragraph passes points for its length and commas to its ancestors, less with the
distance; an ancestor's sum is discounted by the share of its text that stands in links. The best container, or the
article or main element around it, is kept, with those of its siblings that carry text of their own, and their blocks are
the main text. Within a main or an outer article that goes for the siblings on each level.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of the HTML standard by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {  # an opening tag ends these open elements, up to the elements that hold them
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
# What is never part of an article: elements, roles, and words of class and id names.
DROPPED = frozenset(
    "script style noscript template head title iframe object svg canvas math audio video nav aside footer form button select "
    "textarea input label fieldset dialog menu".split()
)
DROPPED_ROLES = frozenset("navigation banner complementary contentinfo search dialog alertdialog alert form menu menubar toolbar".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr "
    "notice notices popup modal overlay lightbox newsletter subscribe subscription signup login paywall share sharing social "
    "sidebar aside menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead "
    "comment comments commentlist disqus replies reply respond related recommended recommendations widget toolbar search skip "
    "copyright legal tags".split()
)
# Words of a class or id name that say nothing of their own beside one of those.
NEUTRAL_NAMES = frozenset(
    "site page main global primary secondary top bottom left right inner outer wrapper wrap container content box block section area bar "
    "list item items link links button buttons form icon icons panel column col row unit slot header head body title text post posts article "
    "articles entry story user social media js the".split()
)
# Names under which much text is still no article.
REMARKS = frozenset("comment comments commentlist disqus replies reply respond".split())
TERSE = 15  # characters of a menu's entry, on average
HOLDS_ARTICLE = frozenset("html body main article".split())

_MARKUP = re.compile(
    # A quote opens a quoted value only right after the equals sign; elsewhere in a tag it is a character like others.
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*+)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s>/=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s"'>][^\s>]*)))?""")
_NAME = re.compile(r"[a-z]+|[0-9]+")


class Node:
    __slots__ = ("tag", "attributes", "parent", "children", "score", "text", "links", "order", "holds_block")

    def __init__(self, tag: str, attributes: str = "", parent: Node | None = None) -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []
        self.score, self.text, self.links = 0.0, 0, 0
        self.order, self.holds_block = 0, False


def parsed(page: str) -> Node:
    """The page's tree, as browsers build it from unclosed and misnested tags, nearly. Tags cut off at the end count as markup."""
    root = Node("#root")
    at, here, page = 0, root, page.replace("\x00", "")
    lower = None
    while at < len(page):
        m = _MARKUP.search(page, at)
        if m is None:
            here.children.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            here.children.append(html.unescape(page[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            node = here
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                here = node.parent
            continue
        if tag in BLOCK:
            here = _ended(here, {"p"}, {"td", "th", "table", "button", "object", "article", "section", "div", "blockquote", "li", "main", "body"}) if tag != "body" else here
        if tag in CLOSES:
            here = _ended(here, *CLOSES[tag])
        node = Node(tag, m[3], here)
        here.children.append(node)
        if tag in RAW:
            lower = lower if lower is not None else _lower(page)
            end = lower.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
            here = node
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            here = node
        elif tag not in VOID and tag not in ("svg", "path", "use", "circle", "rect", "g"):
            here = node  # a slash does not close an HTML element
    return root


def _lower(page: str) -> str:
    """A-Z as a-z; offsets stay."""
    return re.sub("[A-Z]+", lambda m: m[0].lower(), page)


def _ended(here: Node, tags: set[str], within: set[str]) -> Node:
    node = here
    while node.parent is not None and node.tag not in within:
        if node.tag in tags:
            return node.parent
        node = node.parent
    return here


def _attributes(node: Node) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(node.attributes)}


def dropping_names(node: Node) -> set[str]:
    """The words by which a node's class or id says that it is no part of an article: of names all of whose words do,
    or say nothing, as `site-footer` and `ad_box_2`, but not `no-sidebar` or `modal-open`."""
    if not node.attributes.strip() or node.tag in HOLDS_ARTICLE:
        return set()
    given = _attributes(node)
    found: set[str] = set()
    for name in f"{given.get('class', '')} {given.get('id', '')}".split():
        words = {w for w in _NAME.findall(re.sub("([a-z])([A-Z])", r"\1 \2", name).lower()) if not w.isdigit()}
        if words <= DROPPED_NAMES | NEUTRAL_NAMES:
            found |= words & DROPPED_NAMES
    return found


def is_dropped(node: Node, in_article: bool) -> bool:
    """Whether the element, its role or its style takes it out."""
    if node.tag in DROPPED or node.tag == "header" and not in_article:
        return True
    if not node.attributes.strip() or node.tag in HOLDS_ARTICLE:
        return False
    given = _attributes(node)
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", "").lower()):
        return True
    return given.get("role", "").lower() in DROPPED_ROLES or given.get("itemprop") == "comment"


def _without(root: Node, drop) -> None:
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        node.children = [c for c in node.children if isinstance(c, str) or not drop(c, inside)]
        stack += [(c, inside or c.tag in ("article", "main")) for c in node.children if not isinstance(c, str)]


def pruned(root: Node) -> None:
    """Takes out what is never part of an article: first by elements, then by names. Names do not count for a node that holds
    more than half of the page's text outside links, unless they name readers' remarks or an article stands beside the node."""
    _without(root, is_dropped)
    articles = [n for n in measured(root) if n.tag in ("article", "main") and n.text]
    half = (root.text - root.links) / 2

    def beside(node: Node) -> bool:
        return any(node not in above(a) for a in articles)

    def above(node: Node | None) -> list[Node]:
        found = []
        while node is not None:
            found.append(node)
            node = node.parent
        return found

    def named(node: Node, inside: bool) -> bool:
        names = dropping_names(node)
        return bool(names) and (not REMARKS.isdisjoint(names) or node.text - node.links <= half or beside(node))

    _without(root, named)


def measured(root: Node) -> list[Node]:
    """All nodes in page order; each gets the lengths of its text and of its text in links, and whether it holds blocks."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        node.order = len(nodes)
        nodes.append(node)
        stack.extend(c for c in reversed(node.children) if not isinstance(c, str))
    for node in reversed(nodes):
        node.text = sum(len(c.strip()) if isinstance(c, str) else c.text for c in node.children)
        node.holds_block = any(not isinstance(c, str) and (c.tag in BLOCK or c.holds_block) for c in node.children)
        node.links = node.text if node.tag == "a" else sum(c.links for c in node.children if not isinstance(c, str))
    return nodes


def commas(node: Node) -> int:
    total, stack = 0, [node]
    while stack:
        for c in stack.pop().children:
            if isinstance(c, str):
                total += c.count(",") + c.count("،") + c.count("、") + c.count("，")
            else:
                stack.append(c)
    return total


def density(node: Node) -> float:
    return node.links / node.text if node.text else 0.0


def kept_nodes(nodes: list[Node]) -> list[Node]:
    """The best container and the siblings that are kept with it, in page order."""
    scored = set()
    for node in nodes:
        if not node.text or node.tag in ("a", "#root") or not (node.tag in ("p", "pre", "blockquote", "td", "li", "dd") or node.tag in BLOCK) or node.holds_block:
            continue
        points = (1 + commas(node) + min(node.text / 100, 3)) * (1 - density(node))
        above, level = node.parent, 0
        while above is not None and above.tag != "#root" and level < 5:
            above.score += points / (1, 2, 6, 9, 12)[level]
            scored.add(above)
            above, level = above.parent, level + 1
        if node.parent is not None and node.parent.tag == "#root":
            node.parent.score += points
            scored.add(node.parent)
    if not scored:
        return nodes[:1]
    final = {node: node.score * (1 - density(node)) for node in scored}
    best = max(scored, key=lambda n: (final[n], -n.order))
    above = [best]
    while above[-1].parent is not None:
        above.append(above[-1].parent)
    levels = [i for i, n in enumerate(above) if n.tag in ("article", "main")]
    at, last = (levels[0], levels[-1]) if levels else (0, 0)
    least = max(0.2 * final[best], 1.0)

    def passes(node: Node | str) -> bool:
        if isinstance(node, str):
            return False
        enough = 25 if node.tag in ("p", "pre", "blockquote", "article") else 0 if node.tag in ("h1", "h2", "h3", "header", "hgroup") else None
        return final.get(node, 0.0) >= least or enough is not None and node.text > enough and density(node) < 0.25

    out = [above[at]]
    for node, parent in zip(above[at:], above[at + 1 :]):
        here = parent.children.index(node)
        out = [*filter(passes, parent.children[:here]), *out, *filter(passes, parent.children[here + 1 :])]
        if at >= last and (parent.text > node.text or not levels):
            break
        at += 1
    return out


def blocks(kept: list[Node]) -> Iterator[str]:
    """Texts of the blocks, white space as one space. Lists of nothing but links are left out, but for an article's own
    whose entries are more than a word or two, as of sources."""
    parts: list[str] = []

    def is_terse(node: Node) -> bool:
        return node.text < TERSE * sum(not isinstance(c, str) and c.tag in ("li", "dt", "dd") for c in node.children)

    def in_article(node: Node | None) -> bool:
        while node is not None and node.tag not in ("article", "main"):
            node = node.parent
        return node is not None

    for top in kept:
        stack: list[Node | str | None] = [top, None]
        stack.reverse()
        while stack:
            item = stack.pop()
            if item is None:
                if text := " ".join("".join(parts).split()):
                    yield text
                parts.clear()
            elif isinstance(item, str):
                parts.append(item)
            elif item.tag in ("br", "hr", "img"):
                parts.append(" ")
                if item.tag == "hr":
                    stack.append(None)
            elif item.tag in ("ul", "ol", "dl") and item.links > 0.9 * item.text and (is_terse(item) or not in_article(item)):
                stack.append(None)
            else:
                inner = list(reversed(item.children))
                stack += [None, *inner, None] if item.tag in BLOCK else inner
    if text := " ".join("".join(parts).split()):
        yield text


def main_text(page: str | None) -> str:
    """The page's main text, its blocks joined by line ends; empty for null, empty or textless pages."""
    if not page:
        return ""
    root = parsed(page)
    pruned(root)
    return "\n".join(blocks(kept_nodes(measured(root))))


def extracted(pages: DataFrame) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars. Null html counts as empty; repeated rows stay; other columns
    are not read."""

    def run(batches):
        for batch in batches:
            texts = pa.array([main_text(p.as_py()) for p in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts], ["page_id", "url", "text"])

    kind = pages.schema
    out = pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(run, f"page_id {kind['page_id'].dataType.simpleString()}, url {kind['url'].dataType.simpleString()}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
