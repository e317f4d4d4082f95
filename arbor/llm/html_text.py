"""Main text of web pages by tree scoring (operator 2).

A page is parsed into a tree of elements (a small tolerant parser: implied end
tags of paragraphs, list items and table parts, raw script and style text).
Parts that are never main text are cut out. Every paragraph then passes points
to its ancestors, whole ones to its parent and a smaller share to each one
further up: one, one for each comma, and up to three for length, discounted by
the paragraph's link density. Containers start
with points for their tag and lose their own link density. The best container is
kept, with those of its siblings that score a fifth of it and with headings and
paragraphs beside it that are no links. Its blocks are joined in page order.

Defined cases: null or empty html and pages without text give the empty text;
a page without any paragraph gives the text of its body; repeated rows give
repeated results; very deep or unclosed markup is handled without recursion;
very long pages are read whole; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CUT = frozenset(
    "nav header footer aside form script style noscript head title template iframe object embed svg canvas button select "
    "option textarea input menu dialog audio video map xmp noframes".split())
PARAGRAPHS = frozenset("p pre blockquote td li dd figcaption h1 h2 h3 h4 h5 h6".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",),
         "thead": ("table",), "tbody": ("table",), "tfoot": ("table",), "option": ("select",)}
START = {"article": 25.0, "main": 20.0, "section": 5.0, "div": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0,
         "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0, "dd": -3.0, "dt": -3.0, "table": 0.0, "body": 0.0}
# Words of class, id and role. Parts around the article; words that may also be a topic, so that a part with
# prose is kept; words that may also be part of an article's name; words that mark the article; and prefixes of names that only say what the page has ("with-sidebar").
AROUND = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|sidebar|nav|navbar|navigation|menu|breadcrumbs?|masthead|footer|"
    r"cookies?|consent|notice|popup|modal|comments?|disqus|replies|respond|related|recommend\w*|newsletter|"
    r"subscribe|pagination|pager|contentinfo|complementary)(?=$|[\s_-])", re.I)
TOPICS = re.compile(r"(?:^|[\s_-])(?:share|sharing|social|signup|login|widget|copyright)(?=$|[\s_-])", re.I)
PERHAPS = re.compile(r"(?:^|[\s_-])(?:header|head|alert|side|rail|foot|form|search|hidden|legal|skip|overlay|toolbar|dialog)(?=$|[\s_-])", re.I)
INSIDE = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text|blog)(?=$|[\s_-])", re.I)
STATES = re.compile(r"(?:^|(?<=\s))(?:has|with|without|no|is|js)[-_]\S*", re.I)


def around(names: str) -> bool:
    """Whether class, id and role name a part around the article."""
    names = STATES.sub("", names)
    return bool(AROUND.search(names) or PERHAPS.search(names) and not INSIDE.search(names))


# Fixed value: elements that are kept beside the best container, if they are no links.
BESIDE = frozenset("h1 h2 h3 h4 h5 h6 hgroup p pre blockquote".split())
#: Characters of a part whose name is doubtful, if it is kept.
PROSE = 200
#: Ancestors that a paragraph's points reach.
ANCESTORS = 5

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)>|<[!?/][^>]*>", re.S)
ATTR = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "cut", "names", "doubt", "text", "linked", "commas", "score", "scored")

    def __init__(self, tag: str, parent: "Node | None", cut: bool = False, names: str = ""):
        self.tag, self.parent, self.cut, self.names, self.doubt = tag, parent, cut, names, False
        self.children: list = []  # nodes and text pieces in page order
        self.text = self.linked = self.commas = 0
        self.score, self.scored = 0.0, False


def parse(page: str, by_name: bool = True) -> Node:
    """The tree of a page; parts to cut (by tag, and by name) are marked and get no children."""
    root = Node("html", None)
    stack, at = [root], 0
    opened: Counter = Counter()  # open elements by tag, so that tags without a partner cost nothing

    def close(i: int) -> None:
        for x in stack[i:]:
            opened[x.tag] -= 1
        del stack[i:]

    n = page.rfind(">") + 1  # after it there is no whole tag; one that the page's end cuts off is nothing
    tail = page[n:]
    tail = tail[:m.start()] if (m := re.search(r"<[A-Za-z/!?]", tail)) else tail
    while at < n:
        m = TOKEN.search(page, at, n)
        stop = m.start() if m else n
        if stop > at and not stack[-1].cut:
            stack[-1].children.append(entities.unescape(page[at:stop]))
        if not m:
            break
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            # an end tag closes the nearest open element of its name; a stray one is nothing
            if opened[tag]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if tag in ("html", "body") and (opened[tag] or tag == "html"):
            continue
        if tag in BLOCK and opened["p"]:  # a block ends an open paragraph
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in CLOSES and any(opened[x] for x in CLOSES[tag]):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SCOPE[tag]:
                    break
                if stack[i].tag in CLOSES[tag]:
                    close(i)
        attrs = m["attrs"] or m["attrs2"] or ""
        names, hidden = "", False
        if attrs and not attrs.isspace():
            for a in ATTR.finditer(attrs):
                key = a[1].lower()
                value = a[2] or a[3] or a[4] or ""
                if key in ("class", "id", "role"):
                    names += " " + value
                elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                    hidden = True
                elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    hidden = True
        own = Node(tag, stack[-1])
        own.names = names
        own.cut = stack[-1].cut or hidden or tag in CUT or (
            by_name and bool(names) and tag not in ("html", "body", "article", "main") and around(names))
        own.doubt = by_name and bool(names) and tag not in ("html", "body", "article", "main") and bool(TOPICS.search(STATES.sub("", names)))
        if not stack[-1].cut:
            stack[-1].children.append(own)
        if tag in RAW and not attrs.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            if not end:
                return root  # the rest of the page is its text
            at = end.end()
        elif tag not in VOID:
            stack.append(own)
            opened[tag] += 1
    if tail and not stack[-1].cut:
        stack[-1].children.append(entities.unescape(tail))
    return root


def _ordered(root: Node) -> list[Node]:
    """Kept nodes, parents before children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if not node.cut:
            out.append(node)
            todo.extend(c for c in reversed(node.children) if type(c) is Node)
    return out


def _measure(nodes: list[Node]) -> None:
    """Characters, characters in links and commas of each subtree."""
    for node in reversed(nodes):
        for c in node.children:
            if type(c) is str:
                size = len(SPACES.sub(" ", c).strip())
                node.text += size
                node.commas += c.count(",") + c.count("，") + c.count("、")
            elif not c.cut:
                node.text += c.text
                node.linked += c.linked
                node.commas += c.commas
        if node.tag == "a":
            node.linked = node.text


def density(node: Node) -> float:
    return node.linked / node.text if node.text else 0.0


def best_containers(root: Node) -> list[Node]:
    """The best container and the siblings kept with it, in page order."""
    nodes = _ordered(root)
    _measure(nodes)
    poor = [x for x in nodes if x.doubt and not (x.text >= PROSE and x.commas > 1 and density(x) < 0.2)]
    if poor:  # a part named after the page's furniture that holds no prose
        for x in poor:
            x.cut = True
        for x in nodes:
            x.text = x.linked = x.commas = 0
        nodes = _ordered(root)
        _measure(nodes)

    def give(node: Node | None, points: float) -> None:
        for step in range(1, ANCESTORS + 1):
            if node is None:
                break
            if not node.scored:
                node.scored = True
                node.score = START.get(node.tag, 0.0) + (5.0 if node.names and INSIDE.search(node.names) else 0.0)
            node.score += points / step
            node = node.parent

    for node in nodes:
        loose = node.tag in ("div", "section", "article", "main", "body") and any(type(c) is str and not c.isspace() for c in node.children)
        if (node.tag in PARAGRAPHS or loose) and node.text:
            points = (1.0 + node.commas + min(node.text / 100.0, 3.0)) * (1.0 - density(node))
            give(node if loose and node.tag not in PARAGRAPHS else node.parent, points)
    scored = [x for x in nodes if x.scored]
    if not scored:
        return [root]
    for node in scored:
        node.score *= 1.0 - density(node)
    best = max(scored, key=lambda x: x.score)
    if best.parent is None:
        return [best]
    around_best = [c for c in best.parent.children if type(c) is not str and not c.cut]
    kept = {c for c in around_best if c is best or (c.scored and c.score >= max(10.0, best.score * 0.2))}
    # an article's headings and short paragraphs may stand beside its container, but lists of links do not
    beside = [c in kept or (c.text > 0 and c.tag in BESIDE and density(c) < 0.25) for c in around_best]
    return [c for c, b in zip(around_best, beside) if b]


def blocks(node: Node) -> list[str]:
    """Texts of a container's blocks in page order, white space inside a block as one space."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = SPACES.sub(" ", "".join(line)).strip()
        if text:
            out.append(text)
        line.clear()

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif type(x) is str:
            line.append(x)
        elif x.cut:
            if x.tag in BLOCK:
                flush()
        elif x.tag == "br":
            line.append(" ")
        else:
            block = x.tag in BLOCK
            if block:
                flush()
                todo.append(None)
            todo.extend(reversed(x.children))
    flush()
    return out


def main_text(page: str | None) -> str:
    """The article's blocks; a page that is empty without the parts cut by name is read with them."""
    if not page:
        return ""
    for by_name in (True, False):
        text = "\n\n".join(t for c in best_containers(parse(page, by_name)) for t in blocks(c))
        if text:
            break
    return text


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))

    def run(batch: pa.RecordBatch) -> dict:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    return map_text(rows, "html", run, "page_id long, url string, text string, n_chars long")
