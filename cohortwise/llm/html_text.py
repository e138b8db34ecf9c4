"""HTML extraction by tree scoring.

A page is read into a tree; elements that are boilerplate by their kind or
name are cut. Every paragraph passes points for its length and commas to its
ancestors, the full points to its parent and less with distance. A container's
points are discounted by its link density. The container with most points is
the article (or the ``article``/``main`` element around it); siblings that hold
content are kept with it, in page order.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.kernels import slices

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
BOILERPLATE = frozenset("""head nav footer aside form script style noscript template iframe object embed svg canvas button input
    select textarea dialog menu noembed noframes title""".split())
#: Words in class or id, or roles, that name menus, headers, notices, adverts, comments and the like.
BOILERPLATE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo
    promotion promotions banner banners sidebar sidebars sidenav menu menus nav navbar navigation topnav breadcrumb breadcrumbs footer
    footers header masthead topbar comment comments commentlist disqus respond reply replies notice notices cookie cookies consent gdpr
    popup modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations widget
    widgets toolbar pagination pager skip login search outbrain taboola alert legal copyright tags""".split())
BOILERPLATE_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog form menu menubar".split())
PARAGRAPHS = frozenset("p pre blockquote td dd figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
SECTIONS = frozenset("section ul ol dl table".split())
#: Elements that a start tag of this kind ends, up to the nearest container.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[a-zA-Z/][^>]*\Z""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
WHITE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "cut", "points", "length", "linked", "content", "named", "inside")

    def __init__(self, tag: str, parent: Node | None, cut: bool = False, content: bool = False):
        self.tag, self.parent, self.children = tag, parent, []
        self.cut, self.content, self.named = cut, content, False  # boilerplate; named as an article's body; as boilerplate
        self.points, self.length, self.linked, self.inside = 0.0, 0, 0, False


def _named(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """(boilerplate, boilerplate by class or id alone, content) by the attributes of a start tag."""
    cut = content = named = False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "role":
            cut |= value.lower() in BOILERPLATE_ROLES
            content |= value.lower() in ("main", "article")
        elif name == "itemprop":
            content |= value.lower() == "articlebody"
        elif name == "hidden":
            cut |= value.lower() != "until-found"
        elif name == "aria-hidden":
            cut |= value.lower() == "true"
        elif name == "style":
            cut |= "display:none" in value.replace(" ", "").lower()
        else:
            named |= any(w.lower() in BOILERPLATE_NAMES for w in WORDS.findall(value))
    free = tag in ("html", "body", "article", "main")
    return cut and not free, named and not free and not content, content


def parse(page: str) -> Node:
    """The element tree; unclosed and misnested tags end where their parent ends."""
    root = node = Node("html", None)
    at, size = 0, len(page)
    while at < size:
        match = TOKEN.search(page, at)
        if match is None:
            node.children.append(page[at:])
            break
        if match.start() > at:
            node.children.append(page[at:match.start()])
        at = match.end()
        closing, tag, attributes = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            above = node
            while above is not root and above.tag != tag:
                above = above.parent
            if above is not root:
                node = above.parent
            elif tag == "br":
                node.children.append(" ")
            continue
        if tag in ("html", "body"):
            if tag == "body":  # ends an unclosed head
                while node is not root:
                    node = node.parent
                node = _opened(node, tag, attributes)
            continue
        if tag in BLOCK:  # a block ends an open paragraph
            above = node
            while above is not root and above.tag != "p" and (above.tag not in BLOCK):
                above = above.parent
            if above.tag == "p":
                node = above.parent
        if tag in ENDS:
            above, last = node, None
            while above is not root and above.tag not in SCOPES[tag]:
                if above.tag in ENDS[tag]:
                    last = above
                above = above.parent
            if last is not None:
                node = last.parent
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK and tag not in RAW:
            if tag == "hr":
                node.children.append(Node("hr", node))
            elif tag in ("br", "img", "wbr") and tag != "wbr":
                node.children.append(" ")
            continue
        child = _opened(node, tag, attributes)
        if tag in RAW:  # its content is no markup
            end = re.compile(rf"</{tag}\s*/?>", re.I).search(page, at)
            at = end.end() if end else size
        else:
            node = child
    return root


def _opened(parent: Node, tag: str, attributes: str) -> Node:
    cut, named, content = _named(tag, attributes) if attributes else (False, False, False)
    child = Node(tag, parent, cut or tag in BOILERPLATE, content or tag in ("article", "main"))
    child.named = named
    parent.children.append(child)
    return child


def _ancestors(node: Node):
    while node.parent is not None:
        node = node.parent
        yield node


def _cut_by_name(root: Node) -> None:
    """Cuts the elements with a boilerplate name, but not what is around the
    content: the longest article or main if none stands free of such names, or
    more than half of the text of a page without one."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, Node) and not node.cut:
            order.append(node)
            stack.extend(reversed(node.children))
    place = {id(x): i for i, x in enumerate(order)}
    end, text, above, linked = list(range(1, len(order) + 1)), [0] * len(order), [0] * len(order), [False] * len(order)
    for i, node in enumerate(order):
        up = place.get(id(node.parent), i)
        linked[i] = linked[up] or node.tag == "a"
        above[i] = (above[up] if up != i else 0) + node.named
        if not linked[i]:
            text[i] = sum(len(x.strip()) for x in node.children if isinstance(x, str))
    for i in range(len(order) - 1, 0, -1):
        up = place[id(order[i].parent)]
        end[up], text[up] = max(end[up], end[i]), text[up] + text[i]
    articles = [i for i, x in enumerate(order) if x.content]
    longest = max(articles, key=lambda i: text[i], default=-1)
    enclosed = all(above[i] for i in articles)
    cut_to = 0
    for i, node in enumerate(order):
        if not node.named or i < cut_to:
            continue
        if not (enclosed and i < longest < end[i] if articles else 2 * text[i] > text[0]):
            node.cut, cut_to = True, end[i]


def _prepared(root: Node) -> list[Node]:
    """Elements in page order, boilerplate left out, with the length of their
    text and of the part of it in links."""
    _cut_by_name(root)
    order, stack = [], [(root, False, False)]
    while stack:
        node, linked, in_article = stack.pop()
        if node.cut or node.tag == "header" and not in_article:
            node.cut = True
            continue
        order.append(node)
        linked |= node.tag == "a"
        own = sum(len(x.strip()) for x in node.children if isinstance(x, str))
        node.length, node.linked = own, own if linked else 0
        node.inside = in_article
        stack.extend((x, linked, node.inside or node.content) for x in reversed(node.children) if isinstance(x, Node))
    for node in reversed(order):
        if node.parent is not None:
            node.parent.length += node.length
            node.parent.linked += node.linked
    for node in order:  # lists of links only are menus, unless they belong to the marked article: its references
        if node.tag in ("ul", "ol") and not node.inside and node.length and node.linked >= 0.9 * node.length and \
                sum(isinstance(x, Node) and x.tag == "li" for x in node.children) > 2:
            node.cut = True
    return order


def _density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def article_nodes(root: Node) -> list[Node]:
    """The best container and the siblings kept with it."""
    order = _prepared(root)
    for node in order:
        if not node.length or any(x.cut for x in (node, *_ancestors(node))):
            continue
        direct = "".join(x for x in node.children if isinstance(x, str)) if node.tag not in PARAGRAPHS else ""
        if node.tag in PARAGRAPHS or node.tag in BLOCK and node.tag not in HEADINGS and direct.strip():
            text = _text_of(node) if node.tag in PARAGRAPHS else direct
            points = (1 + text.count(",") + min(len(text) / 100, 3.0)) * (1 - _density(node))
            if node.tag not in PARAGRAPHS:
                node.points += points
            for level, above in enumerate(_ancestors(node)):
                above.points += points / (1, 2)[level] if level < 2 else points / (3 * level)
    best = max(order, key=lambda n: n.points * (1 - _density(n)), default=root)
    if not best.points:
        return [root]
    around = next((x for x in (best, *_ancestors(best)) if x.content), None)
    if around is not None:
        best = around
    if best.parent is None:
        return [best]
    least = max(0.2 * best.points * (1 - _density(best)), 1.0)
    kept = []
    for sibling in best.parent.children:
        if sibling is best:
            kept.append(sibling)
        elif isinstance(sibling, Node) and not sibling.cut and sibling.length and (
                sibling.points * (1 - _density(sibling)) >= least
                or sibling.tag in PARAGRAPHS | HEADINGS | SECTIONS and _density(sibling) < 0.25 and around is None):
            kept.append(sibling)
    return kept


def _text_of(node: Node) -> str:
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.cut:
            stack.extend(reversed(x.children))
    return "".join(out)


def blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks in page order: references decoded, white space as one space, trimmed."""
    out, run = [], []

    def close():
        if run:
            text = WHITE.sub(" ", entities.unescape("".join(run))).strip()
            run.clear()
            if text:
                out.append(text)

    stack = list(reversed(nodes))
    while stack:
        x = stack.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            run.append(x)
        elif not x.cut:
            if x.tag in BLOCK:
                close()
                stack.append(None)
            stack.extend(reversed(x.children))
    close()
    return out


def main_text(page: str | None) -> str:
    """The article's blocks joined by line ends; empty without any."""
    if not page:
        return ""
    return "\n".join(blocks(article_nodes(parse(page))))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row.

    Null, empty and text-free pages give an empty text; a page without any
    markup is its own text. Rows are handled one by one, so null ids and urls
    and repeated rows pass through; an empty table gives an empty result.
    Pages of any length or depth are read whole. Other columns are not read.
    """

    def run(batches):
        for batch in slices(batches, "_html"):
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("_html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
