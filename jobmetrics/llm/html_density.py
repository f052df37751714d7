"""Main text of web pages by composite text density.

Each element's density is its characters per tag, damped by how much of it is link text. The
sum of its children's densities is large for the element that holds the paragraphs. Elements
whose density is below the threshold, the least density on the way from the body down to the
densest block, are no candidates; of the others the one with the largest sum is the main text.
If it lies in an ``article`` or ``main`` element, that element is taken. Otherwise the subtree grows
to all of its parent as long as that adds only content, that is, as long as nothing left out and no
list of links is beside it. Where something is, those parts beside it are main text as well that reach the
threshold, and the headings before them. Elements that say what they are (menus, footers, forms,
adverts, ...) take no part; a class or an id says so only of an element that does not hold the main
text by its structure or size.

Parsing takes time in proportion to the page: places of open elements are kept by name, and behind the last ``>``
nothing is taken for a tag.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from html import unescape
from itertools import accumulate
from math import e, log

from pyspark.sql import DataFrame, functions as F

from jobmetrics.llm.common import Batches, map_rows

RESULT_SCHEMA = "page_id long, url string, text string, n_chars long"

# Element names, roles and name parts, as HTML and common usage have them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul xmp".split())
ENDS_PARAGRAPH = BLOCK - frozenset("body html td th tr tbody thead tfoot caption option optgroup legend".split())
NOT_CONTENT = frozenset(
    "aside button datalist dialog footer form head input menu nav noscript select".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
                  "search".split())
NAME_PARTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "copyright disqus footer masthead menu modal nav navbar navigation newsletter notice notices popup promo "
    "promotion related share sharing sidebar social sponsor sponsored subscribe widget".split())
# An element of the first kind ends an open one of the second, up to the third.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "thead": ({"tbody"}, {"table"}),
    "tfoot": ({"tbody", "thead"}, {"table"}), "option": ({"option"}, {"select", "datalist"}),
}
PARAGRAPH_SCOPE = frozenset("button caption html table td th".split())

TOKEN = re.compile(
    r"<!--.*?(?P<done>-->|\Z)"
    r"|<(?P<raw>script|style|template|textarea|title|iframe|svg|xmp|noembed|noframes)(?=[\s/>])"
    r"[^>]*+>(?P<inside>.*?)(?P<end></(?P=raw)\s*+>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?/][^>]*+>", re.S | re.I)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]++)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
PART = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Element:
    name: str
    parent: int
    left_out: bool
    named: bool
    in_link: bool
    in_article: bool = False
    last: int = 0
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    children: list[int] = field(default_factory=list)


@dataclass(slots=True)
class Page:
    """Elements in page order, and texts as (element, block, text)."""

    elements: list[Element] = field(default_factory=list)
    texts: list[tuple[int, int, str]] = field(default_factory=list)


def says(name: str, rest: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element says that it is no main text, and whether its class or id suggests so."""
    if name in NOT_CONTENT or (name == "header" and not in_article):
        return True, False
    named = False
    if not rest or name in ("html", "body", "article", "main"):
        return False, named
    for key, *values in ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values).lower()
        if key in ("class", "id") and not NAME_PARTS.isdisjoint(PART.findall(value)):
            named = True
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True, named
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True, named
    return False, named


def parse(html: str) -> Page:
    """The page's elements, with missing end tags put where browsers put them."""
    page = Page([Element("", -1, False, False, False)])
    elements, texts, stack = page.elements, page.texts, [0]
    block, at = 0, 0
    places: dict[str, list[int]] = {}  # depths of the open elements of each name

    def close_to(depth: int) -> None:
        for index in reversed(stack[depth:]):
            elements[index].last = len(elements) - 1
            places.get(elements[index].name, [0]).pop()
        del stack[depth:]

    def depth_of(names: frozenset | set, scope: frozenset | set) -> int | None:
        """Depth of the innermost open element of ``names``, None if one of ``scope`` is within it."""
        found, barrier = (max((places[n][-1] for n in group if places.get(n)), default=0) for group in (names, scope))
        return found if found > barrier else None

    # Behind the last end of a tag there are no more tags, only a comment may start.
    end = html.rfind(">") + 1
    comment = html.find("<!--", end)
    text_end = len(html) if comment < 0 else comment
    for token in TOKEN.finditer(html, 0, end):
        if token.start() > at:
            texts.append((stack[-1], block, html[at:token.start()]))
        at = token.end()
        inside = token["inside"] or ""
        if token["done"] == "" or token["end"] == "":  # it goes on to the end of the page
            inside, text_end = inside + html[end:], at
        if (token["raw"] or "").lower() == "xmp":
            texts.append((stack[-1], block + 1, inside.replace("&", "&amp;")))
            block += 2
        if not token["name"]:
            continue
        name = token["name"].lower()
        if name in BLOCK:
            block += 1
        if token["close"]:
            depth = depth_of({name}, frozenset()) if name != "p" else depth_of({"p"}, PARAGRAPH_SCOPE)
            if depth:
                close_to(depth)
            continue
        if name in ENDS_PARAGRAPH:
            depth = depth_of({"p"}, PARAGRAPH_SCOPE)
            if depth:
                close_to(depth)
        if name in IMPLIED_END:
            depth = depth_of(*IMPLIED_END[name])
            if depth:
                close_to(depth)
        parent = elements[stack[-1]]
        in_article = parent.in_article or parent.name in ("article", "main")
        no_content, named = says(name, token["rest"], in_article)
        element = Element(name, stack[-1], parent.left_out or no_content, named,
                          parent.in_link or name == "a", in_article, len(elements))
        parent.children.append(len(elements))
        elements.append(element)
        if name in VOID:
            if name == "br":
                texts.append((stack[-1], block, "\n"))
        elif not token["rest"].endswith("/") or name in BLOCK:
            places.setdefault(name, []).append(len(stack))
            stack.append(len(elements) - 1)
    if at < text_end:
        texts.append((stack[-1], block, html[at:text_end]))
    close_to(0)
    leave_out_named(page)
    return page


def leave_out_named(page: Page) -> None:
    """Leaves out the elements with a telling class or id, unless they hold the main text.

    They hold it if a main or h1 element is in them, or an article (articles in an article are
    comments on it), or most of the page's text, unless that is beside the page's main element
    or only article. What is in such an element is judged by itself.
    """
    elements = page.elements
    if not any(x.named and not x.left_out for x in elements):
        return
    sizes = [0] * len(elements)
    for index, _, text in page.texts:
        sizes[index] += 0 if elements[index].left_out else len(text.strip())
    text_before = [0, *accumulate(sizes)]

    def held(before: list[int], index: int) -> int:
        return before[elements[index].last + 1] - before[index]

    def before(*names: str) -> list[int]:
        return [0, *accumulate(int(x.name in names and not x.left_out and held(text_before, i) > 0)
                               for i, x in enumerate(elements))]

    heads, mains, articles = before("main", "h1"), before("main"), before("article")
    above = [(0, 0)] * len(elements)
    for i, x in enumerate(elements[1:], 1):
        parent = elements[x.parent]
        in_mains, in_articles = above[x.parent]
        above[i] = in_mains + (parent.name == "main"), in_articles + (parent.name == "article")
        if parent.left_out:
            x.left_out = True
        elif x.named and not x.left_out:
            beside = mains[-1] > held(mains, i) + above[i][0] or (
                articles[-1] == 1 and not held(articles, i) and not above[i][1])
            x.left_out = not (held(heads, i) or held(articles, i) and not above[i][1]
                              or 2 * held(text_before, i) > text_before[-1] and not beside)


def densities(page: Page) -> tuple[list[float], list[float]]:
    """Composite density of each element, and the sum of its children's (its own, if it has none)."""
    elements = page.elements
    for index, _, text in page.texts:
        element = elements[index]
        if not element.left_out:
            size = len(text.strip())
            element.chars += size
            element.link_chars += size if element.in_link else 0
    for element in reversed(elements[1:]):
        if not element.left_out:
            parent = elements[element.parent]
            parent.chars += element.chars
            parent.link_chars += element.link_chars
            parent.tags += element.tags + 1
            parent.link_tags += element.link_tags + (element.name == "a")
    whole = next((x for x in elements if x.name == "body"), elements[0])
    linked = whole.link_chars / max(whole.chars, 1)
    density = [0.0 if x.left_out else composite(x, linked) for x in elements]
    sums = [sum(density[c] for c in x.children) or d for x, d in zip(elements, density)]
    return density, sums


def composite(x: Element, linked: float) -> float:
    """Characters per tag, times a logarithm that falls with the share of links."""
    if not x.chars:
        return 0.0
    plain = max(x.chars - x.link_chars, 1)
    base = log(x.chars / plain * x.link_chars + linked * x.chars + e)
    share = x.chars / max(x.link_chars, 1) * max(x.tags, 1) / max(x.link_tags, 1)
    return x.chars / max(x.tags, 1) * max(log(max(share, 1.0)), 1e-3) / base


def main_elements(page: Page) -> list[int]:
    """Indexes of the elements that hold the main text, in page order; none if no element has text."""
    density, sums = densities(page)
    elements = page.elements
    blocks = [i for i, x in enumerate(elements) if density[i] > 0 and (x.name in BLOCK or not x.name)]
    if not blocks:
        return []
    index = max(blocks, key=lambda i: (density[i], -i))
    weakest = index
    while index >= 0:
        weakest = min(weakest, index, key=density.__getitem__)
        index = -1 if elements[index].name == "body" else elements[index].parent
    best = max((i for i in blocks if density[i] >= density[weakest]), key=lambda i: (sums[i], -i))
    outer = best
    while outer > 0 and elements[outer].name not in ("article", "main"):
        outer = elements[outer].parent
    return [outer] if outer > 0 else with_siblings(elements, elements[weakest], best)


def with_siblings(elements: list[Element], weakest: Element, best: int) -> list[int]:
    """The element grown to its parents while they add only content; then what reaches the threshold beside it.

    A part beside it is compared by its characters per tag alone, as the logarithm grows with a part's size.
    """
    def menu(x: Element) -> bool:
        return 2 * x.link_chars > x.chars

    def dense(x: Element) -> bool:
        return x.chars * max(weakest.tags, 1) >= weakest.chars * max(x.tags, 1)

    while best > 0:
        beside = elements[elements[best].parent].children
        if any(elements[i].left_out or menu(elements[i]) for i in beside if i != best):
            break
        best = elements[best].parent
    if best <= 0:
        return [0]
    taken, heads = [], []
    for i in beside:
        x = elements[i]
        if i != best and (x.left_out or not x.chars):
            continue
        if i == best or x.name not in HEADINGS and dense(x) and not menu(x):
            taken += [*heads, i]
            heads = []
        elif x.name in HEADINGS:
            heads.append(i)
        else:
            heads = []
    return taken


def extract(html: str | None) -> str:
    """The main text: blocks in page order joined by line ends, white space within each as one space."""
    page = parse(html or "")
    spans = [(i, page.elements[i].last) for i in main_elements(page)]
    blocks: dict[int, list[str]] = {}
    at = 0
    for index, block, text in sorted(page.texts, key=lambda t: t[0]) if len(spans) > 1 else page.texts:
        if page.elements[index].left_out:
            continue
        while at + 1 < len(spans) and index > spans[at][1]:
            at += 1
        if spans and spans[at][0] <= index <= spans[at][1]:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join(unescape("".join(texts)).split()) for _, texts in sorted(blocks.items()))
    return "\n".join(line for line in lines if line)


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    Null and empty html, and pages without any text, give an empty text. Repeated rows give
    repeated results; ids and urls may be null; other columns are left out.
    """

    def run(batches: Batches) -> Iterable[list[tuple]]:
        for rows in batches:
            yield [(page, url, text, len(text)) for page, url, text in ((p, u, extract(h)) for p, u, h in rows)]

    return map_rows(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                                 F.col("html").cast("string")), run, RESULT_SCHEMA)
