import html
import random
import re
from itertools import product

import numpy as np
import pytest

from indicast.llm import html_text as H, mincut
from indicast.llm.common import table

W = np.array(H.DEFAULT_WEIGHTS)
LONG = "This is a longer sentence of the story, with commas, and it ends here."


def text(page):
    return H.main_text(page, W)


def test_given_pages_against_their_article(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    for r in H.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split())
                 for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(x for x in parts if x)


BOILERPLATE = [
    "<nav><ul><li><a href='/a'>Home</a></li></ul></nav>", "<header><h2>Site of it all</h2></header>",
    f"<footer><p>{LONG}</p></footer>", f"<aside><h3>Read more</h3><p>{LONG}</p></aside>",
    f"<div class='cookie-notice'><p>{LONG}</p></div>", f"<div class='ad'>{LONG}</div>",
    f"<form><label>Mail</label><input name=q><p>{LONG}</p></form>", "<script>var a = '<p>no</p>';</script>",
    "<style>p > a { color: red }</style>", f"<section id='comments'><p>{LONG}</p><div class='text'>{LONG}</div></section>",
    "<!-- <p>not this</p> -->", f"<div role='navigation'>{LONG}</div>", f"<div style='display: none'>{LONG}</div>",
    "<ul class='breadcrumbs'><li><a>A</a></li><li><a>B</a></li></ul>", f"<div hidden><p>{LONG}</p></div>",
    f"<h3>Comments</h3><p>{LONG}</p>",
]
BODY = f"<h1>A title</h1><p>{LONG}</p><p>Short.</p><ul><li>one item</li></ul><p>{LONG}</p>"
WANT = f"A title\n{LONG}\nShort.\none item\n{LONG}"


@pytest.mark.parametrize("extra", BOILERPLATE)
@pytest.mark.parametrize("shell", ["<article>{}</article>{}", "<div id='main-content'>{}</div>{}", "<main><article>{}{}</article></main>",
                                   "{}{}"])
def test_boilerplate_goes_and_the_article_stays(extra, shell):
    if extra.startswith("<header>") and "{}{}</article>" in shell:
        return  # the header of an article is part of it
    assert text("<html><body>" + shell.format(BODY, extra) + "</body></html>") == WANT
    assert text("<html><body>" + extra * (not extra.startswith("<h3>")) + shell.format(BODY, "") + "</body></html>") == WANT


@pytest.mark.parametrize("page,want", [
    ("", ""), ("   ", ""), ("<html></html>", ""), (f"<article><p>{LONG}", LONG), (f"<article><p>a &lt;b&gt; &amp; c&nbsp;d &#233;x, {LONG}</p>",
                                                                             f"a <b> & c d éx, {LONG}"),
    (f"<article>{LONG}<br>next <b>bo</b>ld<i> it</i>", f"{LONG} next bold it"), (f"<article><p>{LONG}<script>x", LONG),
    (f"<article><p>{LONG}<!-- open", LONG), (f"<article><p title='a>b' x=\"c>d\">{LONG}</p>", LONG), (f"<article><p>1 < 2 and 3 > 2, {LONG}", f"1 < 2 and 3 > 2, {LONG}"),
    (f"<ARTICLE><P>{LONG}</P></ARTICLE>", LONG), (f"<article><td>{LONG}<td>b c d", f"{LONG}\nb c d"),
])
def test_markup_edge_cases(page, want):
    assert text(page) == want


def test_long_and_deep_pages_take_linear_time():
    import time
    began = time.time()
    deep = "<div>" * 40000 + f"<article><p>{LONG}</p></article>"
    assert text(deep) == LONG
    assert text("<article>" + f"<p>{LONG}<i>x" * 20000).count("\n") == 19999
    text("<a \"" * 30000)
    assert time.time() - began < 60


def test_rows(spark):
    big = "<article>" + f"<p>{LONG}</p>" * 20000 + "</article>"
    rows = [(1, "u", None), (None, None, f"<article><p>{LONG}"), (2, "u", ""), (2, "u", ""), (3, "v", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS one")
    out = {(r.page_id, r.url): r.text for r in H.extract(pages).collect()}
    assert out == {(1, "u"): "", (None, None): LONG, (2, "u"): "", (3, "v"): "\n".join([LONG] * 20000)}
    assert H.extract(pages.limit(0)).count() == 0


def cost(unary, edges, sides):
    return sum(u if u > 0 and not s else -u if u < 0 and s else 0 for u, s in zip(unary, sides)) + sum(
        w for i, j, w in edges if sides[i] != sides[j])


@pytest.mark.parametrize("seed", range(60))
def test_cut_is_minimal(seed):
    rnd = random.Random(seed)
    n = rnd.randrange(1, 10)
    unary = [rnd.choice([-2, -1, 0, 1, 2]) * rnd.random() for _ in range(n)]
    edges = [(rnd.randrange(n), rnd.randrange(n), rnd.random() * 1.5) for _ in range(rnd.randrange(2 * n + 1))]
    edges = [(i, j, w) for i, j, w in edges if i != j]
    best = min(cost(unary, edges, s) for s in product([False, True], repeat=n))
    assert abs(cost(unary, edges, mincut.label(unary, edges)) - best) < 1e-6


def test_smoothing_settles_weak_blocks():
    assert mincut.label([3.0, -0.4, 3.0], [(0, 1, 1.0), (1, 2, 1.0)]) == [True] * 3
    chain = [2.0] + [-0.01] * 500 + [2.0]
    assert mincut.label(chain, [(i, i + 1, 1.0) for i in range(501)]) == [False] * 502 or \
        mincut.label(chain, [(i, i + 1, 3.0) for i in range(501)])


@pytest.mark.parametrize("inner", [
    f'<p title="hidden gems">{LONG}</p>', f'<p data-id="menu" data-class="ad" alt="x id=nav">{LONG}</p>',
    f'<section id="related-work"><p>{LONG}</p></section>', f'<section class="legal-history"><p>{LONG}</p></section>',
    f'<div class="legal"><p>{LONG}</p></div>', f'<div class="advertising-history-of-rome"><p>{LONG}</p></div>',
    f'<p aria-hidden="false">{LONG}</p>', f'<p data-hidden>{LONG}</p>', f"<div data-x='class=\"menu\"'>{LONG}</div>",
    f'<section id="search-for-truth"><p>{LONG}</p></section>', f'<p class="content-style hidden-valley">{LONG}</p>'])
def test_names_inside_other_attributes_and_names_do_not_drop_text(inner):
    page = f"<html><body><nav><a>Home</a></nav><article>{BODY}{inner}</article></body></html>"
    assert text(page) == WANT + "\n" + LONG


@pytest.mark.parametrize("page", [
    f'<article data-teaser="The hidden valley"><p>{LONG}</p></article>', f'<div data-grid="menu"><p>{LONG}</p></div>',
    f'<article TITLE=menu><p>{LONG}</p></article>', f'<div myid="sidebar" class="story"><p>{LONG}</p></div>'])
def test_whole_pages_with_such_attributes(page):
    assert text(f"<html><body>{page}</body></html>") == LONG


@pytest.mark.parametrize("mark", [
    'class="site-footer"', 'id="mainNav"', 'class="wrap page-sidebar"', 'class="cookie-notice box"', 'ID="comments-list"',
    "class=newsletter", 'role="NAVIGATION"', 'hidden=""', 'style="color: red; DISPLAY:none"', 'aria-hidden=true',
    'class="related-posts"', 'class="share-buttons"'])
def test_names_of_boilerplate_alone_still_drop_it(mark):
    assert text(f"<html><body><article>{BODY}<div {mark}><ul><li><a>One link</a></li></ul></div></article></body></html>") == WANT


def test_the_cut_settles_what_the_blocks_alone_get_wrong():
    """Pages without any tag or name: short blocks of an article, and a sentence among links."""
    links = "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(6))
    pages = [
        (f"<div><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div>", f"{LONG}\nYes.\n{LONG}"),
        (f"<div><p>{LONG}</p><p>12 May</p><p>{LONG}</p><ul>{links}</ul></div>", f"{LONG}\n12 May\n{LONG}"),
        (f"<div><h2>Rome</h2><p>{LONG}</p><li>a b</li><p>{LONG}</p></div><div><ul>{links}</ul></div>",
         f"Rome\n{LONG}\na b\n{LONG}")]
    better = 0
    for page, want in pages:
        found = H.blocks(f"<html><body>{page}</body></html>")
        alone = "\n".join(b.text for b, u in zip(found, H.log_odds(found, W)) if u > 0)
        assert text(f"<html><body>{page}</body></html>") == want
        better += alone != want
    assert better >= 2


def test_many_headings_of_comments_take_linear_time():
    import time
    began = time.time()
    page = "<article>" + f"<p>{LONG}</p>" + "<section><h3>Comments</h3><p>x y z</p></section>" * 20000 + "</article>"
    assert text(page) == LONG
    assert time.time() - began < 60


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "u", f"<article><p>{LONG}</p></article>")], "page_id long, url string, html string")
    clash = pages.selectExpr("*", "1 AS content", "'x' AS text", "2.0 AS one", "3 AS n_chars")
    assert [tuple(r) for r in H.extract(clash).collect()] == [(1, "u", LONG)]
