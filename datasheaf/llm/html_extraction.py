"""Main text of web pages by tree scoring.

A page becomes a tree of blocks. Each paragraph gives points for its length and
its commas to the elements around it, fewer the farther off; an element's points
are discounted by its link density. The best container is kept, with siblings
that score or read like it. Everything inside that is no furniture (menus,
footers, adverts, forms, comments and the like) is returned, in page order.

Some elements are furniture by their kind (``nav``, ``footer``). Of those that
only a name speaks against (``class="post header"``), the page's text decides:
one that holds nearly all text isn't.

The scanner reads a page in one pass and needs no well-formed input: a script's
content ends at its own end tag only, open paragraphs end where a new block
starts, what never closes ends with the page, and a tag cut off by the end of
the page is no text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datasheaf.llm._common import per_row

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup; it ends at their own end tag only.
RAW = frozenset("script style textarea title iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that are never part of the article.
FURNITURE = frozenset("nav footer aside button select option input dialog menu head header noscript template svg canvas object audio video".split())
#: Elements that end an open paragraph.
PARAGRAPHS = frozenset("p pre td th blockquote li dd dt h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that may stand beside the best container as part of the article if they read like text.
TEXTS = frozenset("p blockquote pre div section ul ol dl table figure".split())
#: Names of furniture, as parts of a class or an id. The second kind also names what belongs to an article.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|advertisement|adverts|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo|promoted|sidebar|signup|sponsor|sponsored|subscribe|toolbar|widget)(?:$|[\s_-])",
    re.I,
)
WEAK_NAMES = re.compile(r"(?:^|[\s_-])(?:foot|header|legal|pager|related|replies|reply|share|sharing|skip|social|tags)(?:$|[\s_-])", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: A comment, a declaration, a tag with its attributes, or text. Quotes count only where a value starts and if they close.
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/[^a-zA-Z])[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++)?)?)*+)(>|\Z)|([^<]+|<)",
    re.S,
)
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for tag in RAW}
ATTRIBUTES = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S)
BLANK = re.compile(r"[\s\x85\xa0]+")
#: Characters from which a block gives points, and a sibling of the best container reads like text.
SCORED, READS = 25, 50
#: A named element isn't furniture if what is outside of such elements has less than this share of its characters.
LITTLE = 0.1

NO, NAMED, SURE = 0, 1, 2


class Element:
    """children: elements, and (text, inside a link). furniture: NO, NAMED (by class, id or role) or SURE; what is inside is judged by the elements around it."""

    __slots__ = ("tag", "parent", "block", "furniture", "children", "points", "score", "chars", "linked")

    def __init__(self, tag: str, parent: Element | None = None, furniture: int = NO) -> None:
        self.tag, self.parent, self.furniture = tag, parent, furniture
        self.block: Element = parent.block if parent is not None and tag in INLINE else self
        self.children: list = []
        self.points = self.score = 0.0
        self.chars = self.linked = 0


def furniture_of(tag: str, attributes: str) -> int:
    if tag in FURNITURE:
        return SURE
    found = NAMED if tag == "form" else NO
    if not attributes or tag in ("html", "body", "article", "main"):
        return found
    for name, *values in ATTRIBUTES.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return SURE
        if name in ("class", "id") and (NAMES.search(value) or tag not in PARAGRAPHS and tag not in INLINE and WEAK_NAMES.search(value)) or name == "role" and value.lower() in ROLES:
            found = NAMED
    return SURE if re.search(r"(?:^|\s)hidden(?:\s|$)", ATTRIBUTES.sub("", attributes)) else found


def tokens(page: str) -> Iterator[tuple[str, str, str, str]]:
    """(kind, name, attributes, text): kind is "text", "open" or "close"; raw elements are passed over with their content."""
    at = 0
    while m := TOKEN.match(page, at):
        at = m.end()
        closing, name, attributes, ended, text = m.groups()
        if text:
            yield "text", "", "", text
        elif name and ended:
            tag = name.lower()
            if closing:
                yield "close", tag, "", ""
            elif tag in RAW:
                end = RAW_END[tag].search(page, at)
                at = end.end() if end else len(page)
            else:
                yield "open", tag, attributes, ""


def tree(page: str) -> Element:
    root = at = Element("#root")
    opened: Counter[str] = Counter()

    def close_through(e: Element) -> None:
        nonlocal at
        while at is not e.parent:
            opened[at.tag] -= 1
            at = at.parent

    for kind, tag, attributes, text in tokens(page):
        if kind == "text":
            at.children.append((text, opened["a"] > 0))
        elif kind == "close":
            if opened[tag] > 0:
                x = at
                while x.tag != tag:
                    x = x.parent
                close_through(x)
        else:
            if tag not in INLINE:
                x = at.block  # a block ends the open paragraph, and a list item its like
                if x.tag == "p" or x.tag == tag and tag in ("li", "dd", "dt", "td", "th", "tr", "option"):
                    close_through(x)
            e = Element(tag, at, furniture_of(tag, attributes))
            at.children.append(e)
            if tag not in VOID and not attributes.rstrip().endswith("/"):
                opened[tag] += 1
                at = e
    return root


def below(e: Element, into=lambda x: True) -> Iterator[Element]:
    """``e`` and the elements inside, in page order; not into those that ``into`` refuses."""
    stack = [e]
    while stack:
        x = stack.pop()
        if into(x):
            yield x
            stack.extend(c for c in reversed(x.children) if isinstance(c, Element))


def shown(e: Element) -> bool:
    return not e.furniture


def blocks(e: Element) -> list[str]:
    """The texts of the blocks inside, in page order, white space collapsed; furniture left out."""
    out: list[list[str]] = [[]]
    stack: list = [e]
    while stack:
        x = stack.pop()
        if x is None:
            out.append([])
        elif isinstance(x, tuple):
            out[-1].append(x[0])
        elif x is e or not x.furniture:
            if x.tag == "br":
                out[-1].append(" ")
            elif x.tag not in INLINE:
                out.append([])
                stack.append(None)
            stack.extend(reversed(x.children))
    joined = (BLANK.sub(" ", html.unescape("".join(x))).strip() for x in out if x)
    return [x for x in joined if x]


def measure(root: Element) -> None:
    """Characters, linked characters and points of each block's own text, with that of the inline elements inside it."""
    texts: dict[Element, list[str]] = {}
    for e in below(root, lambda x: x.furniture != SURE):
        # what is named counts as its own text, for the element that it may turn out to be
        owner = e if e.furniture else e.block
        for c in e.children:
            if isinstance(c, tuple):
                texts.setdefault(owner, []).append(c[0])
                owner.linked += len(c[0].strip()) * c[1]
    for e, found in texts.items():
        text = "".join(found).strip()
        e.chars = len(text)
        if len(text) >= SCORED and e.tag not in HEADINGS and e.tag not in ("html", "body", "#root"):
            e.points = 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)


def acquit(root: Element) -> None:
    """Named elements that hold nearly all of the page's text outside of links are no furniture."""
    order = list(below(root, lambda x: x.furniture != SURE))
    holds = {e: e.chars - e.linked for e in order}
    for e in reversed(order):
        if e.parent is not None:
            holds[e.parent] += holds[e]

    def gather(e: Element) -> tuple[int, list[Element]]:
        """Characters in ``e`` outside of named elements, and the outermost of these."""
        inside = list(below(e, lambda x: x is e or not x.furniture))
        return sum(x.chars - x.linked for x in inside), [c for x in inside for c in x.children if isinstance(c, Element) and c.furniture == NAMED]

    outside, named = gather(root)
    if not named or any(e.tag in ("article", "main") and any(x.chars for x in below(e, shown)) for e in below(root, shown)):
        return
    place = {e: i for i, e in enumerate(order)}
    largest_first = [(-holds[e], place[e]) for e in named]
    heapify(largest_first)
    while largest_first:
        held, at = heappop(largest_first)
        if outside >= LITTLE * -held:
            return
        order[at].furniture = NO
        more, named = gather(order[at])
        outside += more
        for e in named:
            heappush(largest_first, (-holds[e], place[e]))


def weigh(root: Element) -> list[Element]:
    """Pass the points of paragraphs to their ancestors, and sum up characters; the blocks in page order."""
    found = [e for e in below(root, shown) if e.tag not in INLINE]
    for e in found:
        if e.points:
            x, share = e.parent if e.tag in PARAGRAPHS else e, 1.0
            while x is not None and share > 0.1:
                x.score += e.points * share
                x, share = x.parent, share / 2
    for e in reversed(found):
        if e.parent is not None:
            p = e.parent.block
            p.chars += e.chars
            p.linked += e.linked
    return found


def link_density(e: Element) -> float:
    return e.linked / e.chars if e.chars else 0.0


def extract(page: str) -> str:
    """The article's blocks joined by spaces; empty if the page has no text outside its furniture."""
    root = tree(page)
    measure(root)
    acquit(root)
    found = weigh(root)
    value = {e: e.score * (1 - link_density(e)) for e in found}
    scored = [e for e in found if e.score > 0]
    if not scored:
        # too short to score: an article element, else the whole page
        chosen = next((e for e in found if e.tag in ("article", "main") and e.chars), root)
        return " ".join(blocks(chosen))
    best = max(scored, key=lambda e: value[e])  # of equals the first, which is the outer one
    # the article element around the best container has its headline too
    x = best
    while x is not None:
        if x.tag in ("article", "main"):
            best = x
            break
        x = x.parent
    kept = [best]
    if best.parent is not None and best.tag not in ("article", "main", "body", "html"):
        limit = max(10.0, value[best] * 0.2)
        kept = []
        for c in best.parent.children:
            if isinstance(c, tuple) or c.furniture:
                continue
            reads = c.chars >= (SCORED if c.tag in PARAGRAPHS else READS) and c.tag in TEXTS and link_density(c) < 0.25
            if c is best or value.get(c, 0) >= limit or reads or c.tag in HEADINGS and c.chars:
                kept.append(c)
    elif best.tag in ("article", "main") and best.parent is not None:
        # an article in several parts
        kept = [c for c in best.parent.children if c is best or isinstance(c, Element) and not c.furniture and c.tag == best.tag and value.get(c, 0) >= 0.2 * value[best] and c.chars]
    return " ".join(b for e in kept for b in blocks(e))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of ``pages``: page_id, url, text, n_chars (code points of text).

    A null or empty page has an empty text. Null ids and repeated rows stay;
    other columns aren't read; an empty table gives no rows.
    """

    def texts(found: list[bytes]) -> list[pa.Array]:
        out = [extract(x.decode()) for x in found]
        return [pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())]

    return per_row(pages, [F.col(id_col).alias("page_id"), F.col(url_col).alias("url")], F.col(html_col), texts, "text string, n_chars bigint")
