"""Main text of pages, against what the pages' makers meant."""

from __future__ import annotations

import html
import math
import re
import time

from llm_helpers import prepared  # noqa: F401
import pytest

from jobmetrics.llm import html_density as hd

BOILERPLATE = """<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="ad">Buy <b>now</b>, pay later, the best offer that there ever was</div>"""
CASES = [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>a", "a"), ("<", "<"), ("<script>x", ""),
    ("<!-- all of it", ""), ("<p>x &lt; y &amp;amp; z&nbsp;!</p>", "x < y &amp; z !"),
    ("<p>one<p>two\n \t three<br>four", "one\ntwo three four"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    (f"<body>{BOILERPLATE}<article><h1>T</h1><p>first <b>bold</b> text<p>Ok.</article>"
     "<footer>&copy; me</footer>", "T\nfirst bold text\nOk."),
    (f"<body>{BOILERPLATE}<div><div><p>{'long text ' * 30}</p><p>{'more text ' * 30}</p></div>"
     "<div class='comments'><p>" + "I disagree with every word " * 20 + "</p></div></div>",
     "\n".join([("long text " * 30).strip(), ("more text " * 30).strip()])),
    ("<main><form><label>Name</label></form><p>kept words</p><aside>side</aside></main>", "kept words"),
    ("<article><p>a<script>var t='</p>';</script>b</p><style>p{}</style></article>", "ab"),
    ("<div hidden>no</div><div style='display: none'>no</div><p>yes</p>", "yes"),
    ("<p title='a > b'>text</p>", "text"), ("<p title='unclosed>text</p>", "text"),
    ("<div role=banner>no</div><p>yes</p>", "yes"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_cases(page, text):
    assert hd.extract(page) == text


def test_deep_and_unclosed_pages_take_linear_time():
    assert hd.extract("<div>" * 3000 + "deep") == "deep"
    assert hd.extract("<p>" + "<b>" * 2000 + "x") == "x"
    assert len(hd.extract("<p>" + "a < b \" ' " * 50_000)) > 300_000


@pytest.mark.parametrize("page", [
    "<div>" * 200_000, "<a " * 350_000, "<div>" * 50_000 + "</i>" * 50_000, "<p><button>" + "<b>" * 30_000 + "</p>" * 200_000,
    "<!--" + "<a " * 350_000, "<b>x</b>" + "<a \"" * 250_000, "<ul>" + "<li><b>" * 140_000, "<" * 1_000_000, "<p><table>" * 100_000,
])
def test_a_megabyte_of_anything_takes_seconds(page):
    start = time.perf_counter()
    hd.extract(page + "deep")
    assert time.perf_counter() - start < 5


def paragraphs(n):
    return "".join(f"<p>{f'Paragraph number {i} of several words. ' * 3}</p>" for i in range(n))


def lines_of(*counts):
    return [f"Paragraph number {i} of several words. " * 2 + f"Paragraph number {i} of several words." for n in counts for i in range(n)]


MENU = "<nav><a href=x>Home</a></nav>"


def test_all_parts_of_a_text_without_article_are_kept():
    parts = "<h1>Title</h1>" + "".join(f"<section>{paragraphs(n)}</section>" for n in (10, 3, 1))
    want = "\n".join(["Title", *lines_of(10, 3, 1)])
    assert hd.extract(f"<body>{MENU}<div>{parts}</div><footer>me</footer></body>") == want
    assert hd.extract(f"<body>{MENU}{parts}<footer>me</footer></body>") == want
    assert hd.extract(f"<body><div><ul><li><a href=1>one page</a><li><a href=2>other page</a></ul>{parts}</div></body>") == want
    short = f"<div><div>{paragraphs(6)}</div><div><p>Short part.</p></div></div>"
    assert hd.extract(f"<body>{MENU}{short}<footer>me</footer></body>") == "\n".join([*lines_of(6), "Short part."])


def test_what_is_beside_the_text_of_a_page_stays_out():
    page = f"<body>{MENU}<h1>Title</h1><div>{paragraphs(8)}</div><div>All rights reserved</div><h2>More</h2><div>x</div></body>"
    assert hd.extract(page) == "\n".join(["Title", *lines_of(8)])


def test_nothing_else_is_dropped():
    assert hd.extract("<article><p>Let <math><mi>x</mi></math> be</p><xmp>a <b> &lt; c</xmp>d</article>") == "Let x be\na <b> &lt; c\nd"
    assert hd.extract("<article><p>a</p><object><p>b</p></object><canvas>c</canvas></article>") == "a\nb\nc"
    assert hd.extract("<p>a<xmp>b <i>") == "a\nb <i>"
    assert hd.extract("<p>a</p>b<!-- c") == "a\nb"


def brute_densities(html_text):
    """Composite density and sum of children's of each element, straight from the definitions, by recursion over the tree."""
    page = hd.parse(html_text)
    elements = page.elements

    def below(i):
        return [i, *(j for c in elements[i].children if not elements[c].left_out for j in below(c))]

    def counts(i):
        inside = set(below(i)) if not elements[i].left_out else set()
        chars = sum(len(t.strip()) for j, _, t in page.texts if j in inside)
        links = sum(len(t.strip()) for j, _, t in page.texts if j in inside and elements[j].in_link)
        return chars, links, len(inside) - 1, sum(elements[j].name == "a" for j in inside if j != i)

    body = next((i for i, x in enumerate(elements) if x.name == "body"), 0)
    whole_chars, whole_links, *_ = counts(body)
    out = []
    for i, x in enumerate(elements):
        chars, links, tags, link_tags = counts(i)
        if x.left_out or not chars:
            out.append(0.0)
            continue
        tags = max(tags, 1)
        base = math.log(chars / max(chars - links, 1) * links + whole_links / max(whole_chars, 1) * chars + math.e)
        ratio = chars * tags / (max(links, 1) * max(link_tags, 1))
        out.append(chars / tags * max(math.log(max(ratio, 1)), 1e-3) / base)
    return out, [sum(out[c] for c in x.children) or d for x, d in zip(elements, out)]


def test_densities_against_their_definition(sf_dir):
    import pyarrow.parquet as pq

    pages = pq.read_table(f"{sf_dir}/pages.parquet").column("html").to_pylist()[:30]
    for page in [*pages, *WRAPPED, *[c[0] for c in CASES if c[0]]]:
        got = hd.densities(hd.parse(page))
        for a, b in zip(got, brute_densities(page)):
            assert a == pytest.approx(b)


def test_whole_table(prepared, sf_dir):
    pages = prepared.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r["page_id"]: r for r in hd.main_text(pages).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for row in rows:
        inside = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        want = "\n".join(b for b in blocks if b)
        got = found[row["page_id"]]
        assert (got["text"], got["n_chars"], got["url"]) == (want, len(want), row["url"])


def test_edges(prepared):
    schema = "page_id long, url string, html string, text int, n_chars string"
    rows = [(None, None, None, 1, "x"), (1, "u", "<p>a", 1, "x"), (1, "u", "<p>a", 1, "x")]
    got = hd.main_text(prepared.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, got), key=str) == [(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)]
    assert hd.main_text(prepared.createDataFrame([], schema)).collect() == []


POST = f"<h1>Title</h1><p>{'long text ' * 30}</p><p>{'more text ' * 30}</p>"
PARAGRAPHS = "\n".join([("long text " * 30).strip(), ("more text " * 30).strip()])
SIDE = '<div class="sidebar"><p>other pages of this place</p></div>'
WRAPPED = [
    f'<div class="layout has-sidebar"><article>{POST}</article>{SIDE}</div>',
    f'<div id="notice-1234"><main>{POST}</main></div>',
    f'<div class="share-price-report">{POST}</div>{SIDE}',
    f'<div class="page-with-widget"><div id="social-page"><article>{POST}</article>{SIDE}</div></div>',
    f'<article><div class="related-work">{POST}</div></article>{SIDE}',
    f'<div class="promo"><article><p>teaser</p></article></div><div class="has-sidebar"><article>{POST}</article></div>',
]


@pytest.mark.parametrize("inside", WRAPPED)
def test_names_of_wrappers_do_not_lose_the_main_text(inside):
    assert hd.extract(f"<body>{BOILERPLATE}{inside}<footer>me</footer>") == f"Title\n{PARAGRAPHS}"


def test_most_of_the_text_is_main_text_whatever_its_name():
    text = POST.replace("<h1>Title</h1>", "")
    assert hd.extract(f"<body>{BOILERPLATE}<div class='share-price-report'>{text}</div>{SIDE}") == PARAGRAPHS
    assert hd.extract(f"<body><main><div id='notice-7'>{text}</div></main>{SIDE}") == PARAGRAPHS
    assert hd.extract("<div class='notice'>all there is</div>") == "all there is"


def test_comments_and_adverts_stay_out_by_name():
    comments = "<div class='comments'>" + f"<article><p>{'I disagree ' * 12}</p></article>" * 3 + "</div>"
    plain = comments.replace("article>", "div>")
    assert hd.extract(f"<body><article><h1>T</h1><p>short post</p></article>{plain}") == "T\nshort post"
    assert hd.extract(f"<body><main><p>short post</p></main>{plain}") == "short post"
    assert hd.extract(f"<body><article>{POST}{comments}</article>") == f"Title\n{PARAGRAPHS}"
    assert hd.extract(f"<body><div>{POST}</div>{SIDE}<div class='ad'>Buy</div>").endswith(PARAGRAPHS)


def test_named_elements_without_end_take_linear_time():
    assert hd.extract("<div class=ad>" * 3000 + "deep") == "deep"
