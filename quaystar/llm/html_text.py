"""Main text of a web page by composite text density.

Each block-level DOM node has a density: its characters per tag, adjusted for the share of them that are links. The
node whose children have the largest sum of densities leads to the main text: its article, if it is in one, and the
nodes beside its path to the body whose density reaches the smallest one on that path. A page without an article may have
its text in many parts, and a short one has little density: there all that is beside the path belongs to the main text,
unless half of it or more is links. Menus, headers, footers, sidebars,
notices, adverts, forms, comments, scripts and styles are no part of the tree.
"""

from __future__ import annotations

import html
import re
from math import e, log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quaystar.llm.common import free_name, with_text_columns

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article blockquote body center dd details dir div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr"
    " html legend li main ol p pre section summary table tbody tfoot thead tr caption ul".split()
)
CLOSED_BY_NEXT = {
    "li": ({"li"}, {"ul", "ol", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
# What is no main text, by element, role and words of class or id.
LEFT_OUT = frozenset(
    "head script style noscript template nav header footer aside form button select textarea iframe svg math object canvas"
    " audio video menu dialog noembed noframes xmp title".split()
)
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
LEFT_OUT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer"
    r"|sidebar|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscri\w*|share|sharing|social|related|recommended"
    r"|comments?|disqus|replies|widget|login|signup|search)(?:$|[\s_-])",
    re.I,
)
NEVER_LEFT_OUT = frozenset(("html", "body", "article", "main"))

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


def _left_out(tag: str, attributes: str) -> bool:
    if tag in LEFT_OUT:
        return True
    if not attributes or tag in NEVER_LEFT_OUT:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next(filter(None, values), "")
        name = name.lower()
        if name == "role" and value.lower() in LEFT_OUT_ROLES or name in ("class", "id") and LEFT_OUT_NAMES.search(value):
            return True
    return False


class _Page:
    """Block nodes of a page in document order: parent, tag, and what of the text is theirs."""

    def __init__(self) -> None:
        self.tags, self.parents = ["#page"], [-1]
        self.links = [0]  # number of links directly in a node
        self.texts: list[tuple[int, str, bool]] = []  # node, text, is it a link
        self.first, self.last = [0], [0]  # texts of the subtree

    def open(self, tag: str, parent: int) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.links.append(0)
        self.first.append(len(self.texts))
        self.last.append(-1)
        return len(self.tags) - 1

    def close(self, node: int) -> None:
        self.last[node] = len(self.texts)


def parse(source: str) -> _Page:
    page = _Page()
    stack: list[tuple[str, int, bool]] = [("#page", 0, False)]  # tag, its block node, is it inside what is left out
    links = 0  # open links
    at = 0

    def pop() -> None:
        nonlocal links
        tag, node, _ = stack.pop()
        if tag == "a":
            links -= 1
        if node != stack[-1][1]:
            page.close(node)

    def put(text: str) -> None:
        _, node, out = stack[-1]
        if not out and text:
            page.texts.append((node, html.unescape(text), links > 0))

    size = len(source)
    while at < size:
        found = TOKEN.search(source, at)
        if not found:
            put(source[at:])
            break
        put(source[at : found.start()])
        at = found.end()
        closing, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not name:
            if found.group().startswith("<![CDATA["):
                put(html.escape(found.group()[9:].removesuffix("]]>"), quote=False))
            continue
        tag = name.lower()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    while len(stack) > k:
                        pop()
                    break
                if tag not in BLOCK and tag not in LEFT_OUT and stack[k][0] in BLOCK:
                    break  # an inline end tag closes no block
            if tag in BLOCK or tag in ("td", "th"):
                put(" ")
            continue
        if tag in BLOCK and tag not in ("html", "body"):
            for k in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[k][0] == "p":
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in BLOCK or stack[k][0] in ("td", "th"):
                    break
        if tag in CLOSED_BY_NEXT:
            same, inside = CLOSED_BY_NEXT[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in inside:
                    break
                if stack[k][0] in same:
                    while len(stack) > k:
                        pop()
                    break
        _, node, out = stack[-1]
        if tag in VOID:
            if tag == "hr" and not out:
                page.close(page.open("hr", node))
            put(" ")
            continue
        out = out or _left_out(tag, attributes)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = end.end() if end else size
            continue
        if tag == "a":
            links += 1
            if not out:
                page.links[node] += 1
        if tag in BLOCK and not out:
            node = page.open(tag, node)
        elif tag in ("td", "th"):
            put(" ")
        stack.append((tag, node, out))
    while len(stack) > 1:
        pop()
    page.close(0)
    return page


def main_nodes(page: _Page) -> tuple[set[int], set[int]]:
    """The nodes whose subtrees are the main text, and those of which only the text outside their children is."""
    n = len(page.tags)
    chars, link_chars, links, tags, own = [0] * n, [0] * n, list(page.links), list(page.links), [0] * n
    for node, text, is_link in page.texts:
        size = len(" ".join(text.split()))
        chars[node] += size
        own[node] += size
        if is_link:
            link_chars[node] += size
    own_link_chars = list(link_chars)
    for node in range(n - 1, 0, -1):
        parent = page.parents[node]
        chars[parent] += chars[node]
        link_chars[parent] += link_chars[node]
        links[parent] += links[node]
        tags[parent] += tags[node] + 1
    body_links = link_chars[0] / max(chars[0], 1)

    def density(c: int, lc: int, t: int, lt: int) -> float:
        if not c:
            return 0.0
        base = log(c / max(c - lc, 1) * lc + body_links * c + 1 + e)
        return c / max(t, 1) * log(max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1)) / log(base)

    value = [density(chars[k], link_chars[k], tags[k], links[k]) for k in range(n)]
    total = [density(own[k], 0, 1, 1) if own[k] else 0.0 for k in range(n)]
    children: list[list[int]] = [[] for _ in range(n)]
    for node in range(1, n):
        total[page.parents[node]] += value[node]
        children[page.parents[node]].append(node)
    best = max(range(n), key=lambda k: (total[k], -k))
    path = [best]
    while page.parents[path[-1]] >= 0:
        path.append(page.parents[path[-1]])
    threshold = min(value[k] for k in path)
    in_article = [k for k, node in enumerate(path) if page.tags[node] in ("article", "main")]
    top = in_article[0] if in_article else 0
    chosen, alone = {path[top]}, set()
    for below, node in zip(path[top:], path[top + 1 :]):
        beside = {k for k in children[node] if k != below and chars[k] and 2 * link_chars[k] < chars[k]}
        chosen |= {k for k in beside if not in_article or value[k] >= threshold}
        if not in_article and 2 * own_link_chars[node] < own[node]:
            alone.add(node)
    return chosen, alone


def main_text(source: str) -> str:
    page = parse(source)
    if not page.texts:
        return ""
    chosen, alone = main_nodes(page)
    kept = [False] * len(page.tags)
    for node, parent in enumerate(page.parents):
        kept[node] = node in chosen or (parent >= 0 and kept[parent])
    lines: list[str] = []
    block, parts = -1, []
    for owner, text, _ in page.texts:
        if not kept[owner] and owner not in alone:
            owner, text = -1, ""
        if owner != block:
            lines.append(" ".join("".join(parts).split()))
            block, parts = owner, []
        parts.append(text)
    lines.append(" ".join("".join(parts).split()))
    return "\n".join(line for line in lines if line)


def extracted(pages: DataFrame, source: str = "html") -> tuple[DataFrame, str, str]:
    """`pages` plus the main text and its length in code points; returns the names of both as well.

    A null or empty page, or one without text, gives an empty text. Every page is read as a whole, whatever its length;
    broken markup gives the tree that closing what is open gives. Repeated rows each get their text.
    """
    text = free_name(pages, "text")
    count = free_name(pages, "n_chars")
    added = StructType([StructField(text, StringType()), StructField(count, LongType())])

    def measure(sources: list[bytes]) -> list[list]:
        texts = [main_text(value.decode("utf-8", "replace")) for value in sources]
        return [texts, [len(value) for value in texts]]

    return with_text_columns(pages, source, added, measure), text, count


def article_texts(pages: DataFrame) -> DataFrame:
    rows, text, count = extracted(pages)
    return rows.select("page_id", "url", F.col(text).alias("text"), F.col(count).alias("n_chars"))
