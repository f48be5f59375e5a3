import html
import re
import time
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterlake.llm.main_text import (
    PageModel,
    best_run,
    count_keys,
    extract,
    fit,
    main_text,
    read_items,
    train,
)

SCHEMA = "page_id long, url string, html string"
BLOG = """<html><body><header><a href=/>Home</a> Site</header>
<div class='sidebar'><p>Side words here many more words than usual</p></div>
<div id=content><h1>Title  here</h1><p>First paragraph of the <a href=x>linked</a> article.
<div class="cookie-notice">We use cookies</div>
<p>Second &nbsp; paragraph &lt;b&gt;.<br>line two</p><ul><li>one item<li>two items</ul>
<form><label>Name</label><input></form><script>if (a < b) { c("</p>") }</script></div>
<section id='comments'><p>Great post! I love this one very much indeed yes.</p></section>
<footer>(c) 2020</footer></body></html>"""
BLOG_TEXT = (
    "Title here\nFirst paragraph of the linked article.\nSecond paragraph <b>. line two\n"
    "one item\ntwo items"
)


@pytest.fixture(scope="module")
def pages():
    table = pd.read_parquet("/root/testdata/sf0.001/pages.parquet")
    return list(table[["page_id", "url", "html"]].itertuples(index=False, name=None))


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    blocks = [re.sub(r"</?b>|<br>", "", b) for b in re.split(r"</?(?:p|h1)>", inner)]
    texts = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks]
    return "\n".join(t for t in texts if t)


def test_articles_of_real_pages(spark, stored_table, pages):
    rows = [*pages, (None, None, None), (90_000, "u", ""), pages[0]]
    table = stored_table(rows, SCHEMA)
    model = train(table)
    got = [tuple(r) for r in extract(table, model, ["page_id", "url"]).collect()]
    want = [(i, u, article(h) if h else "") for i, u, h in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_weights_do_not_hang_on_the_article_element(stored_table, pages):
    table = stored_table(pages, SCHEMA)
    model = train(table)
    bare = [re.sub(r"</?article>", "", h) for _, _, h in pages]
    assert [main_text(b, model) for b in bare] == [article(h) for _, _, h in pages]


def test_unlabelled_page_of_another_kind(stored_table, pages):
    model = train(stored_table(pages, SCHEMA))
    assert main_text(BLOG, model) == BLOG_TEXT
    assert main_text(BLOG, PageModel()) == BLOG_TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<p>", ""), ("words & more &lt;b&gt; &amp;c", "words & more <b> &c"),
        ("<script>x", ""), ("<p>a b c<nav>d e", "a b c"), ("<!-- a b", ""),
        ("<p title='>'>a b c</p>", "a b c"), ("<P>Ä&#228;&ouml b</P>", "Ääö b"),
    ],
)
def test_odd_pages(page, text):
    assert main_text(page, PageModel()) == text


POST = "<h1>A longer title</h1><p>Some words of a post.</p><p>More of them in here.</p>"
MENU = "<nav><a href=/>Home</a></nav>"


@pytest.mark.parametrize(
    "page",
    [
        f'<body><form id="aspnetForm">{MENU}<div>{POST}</div></form></body>',
        f'<body>{MENU}<div class="layout has-sidebar">{POST}</div></body>',
        f'<body>{MENU}<div class="post no-comments">{POST}</div></body>',
        f'<html class="js cookie ok"><body>{MENU}{POST}</body></html>',
        f'<body class="x"><form><div class="sidebar-layout"><div class="post comments-open">{POST}</div>'
        '<div class="sidebar"><p>Aside</p></div></div></form></body>',
        f'<body><div class="page search"><p>{"many words here " * 9}</p></div>'
        f'<div class="page comments-open"><article class="post comments-open">{POST}</article></div>'
        "</body>",
        f'<main><div class="sidebar-layout">{POST}</div></main>',
        f'<main>{POST}<section class="comments"><p>Great!</p></section></main>',
        f'<main>{POST}</main><div class="comments"><p>{"many great words " * 30}</p></div>',
    ],
)
def test_named_elements_around_a_page_do_not_empty_it(page):
    assert main_text(page, PageModel()) == "A longer title\nSome words of a post.\nMore of them in here."


def test_long_pages_take_no_longer_than_their_length():
    for page in ("<" * 300_000, "<a " * 100_000, "<p>word " * 20_000, "<a b='" * 100_000):
        main_text(page, PageModel())


def test_best_run_is_the_best_of_all():
    model = fit([("w p", 9, 1), ("t p", 5, 5), ("t div", 1, 9)])
    items = read_items("<div>a b</div><p>c d e</p><div></div><p>f g</p><div>h</div>")
    weights = [model.of(i) for i in items]
    first, last = best_run(items, model)
    every = [(sum(weights[i:j]), -i) for i in range(len(items)) for j in range(i, len(items) + 1)]
    assert sum(weights[first:last]) == pytest.approx(max(every)[0])


def test_without_labelled_pages(stored_table):
    table = stored_table([(1, "u", "<p>some words in here</p>")], SCHEMA)
    assert train(table) == PageModel()
    assert extract(table, PageModel(), ["page_id"]).select(F.length("text")).first()[0] == 18
    assert extract(stored_table([], SCHEMA), PageModel(), ["page_id"]).collect() == []


@pytest.mark.parametrize("part", ["<div>word ", "<b>word ", "<svg>word ", "<li>word ", "</x>word ", "<p>a<div>"])
def test_open_tags_take_no_longer_than_their_length(part):
    def seconds(n):
        start = time.process_time()
        main_text(part * n, PageModel())
        return time.process_time() - start

    seconds(1000)
    assert seconds(100_000) < 40 * max(seconds(10_000), 0.02)


ASIDE = "<aside>" + "<a href=x>link text</a> " * 40 + "</aside>"


@pytest.mark.parametrize("trained", [False, True])
@pytest.mark.parametrize(
    ("page", "text"),
    [
        (
            '<article><h1>T</h1><p>One two three.</p><div class="social-studies"><p>Studies here.</p>'
            '</div><div class="alert-level">Level of alert</div><p>End of it.</p></article>',
            "T\nOne two three.\nStudies here.\nLevel of alert\nEnd of it.",
        ),
        (
            f"<article><h1>Title</h1><p>One two three.</p>{ASIDE}<p>And the rest of it.</p></article>",
            "Title\nOne two three.\nAnd the rest of it.",
        ),
        (
            '<article><p>One two.</p><div class="ad-slot top">Buy now</div><div id="relatedPosts">More</div>'
            "<p>Three four.</p></article>",
            "One two.\nThree four.",
        ),
        ("<article><my-part><p>Own element names.</p></my-part></article>", "Own element names."),
    ],
)
def test_parts_within_an_article(page, text, trained, model):
    assert main_text(page, model if trained else PageModel()) == text


@pytest.fixture(scope="module")
def model():
    """Weights from real pages that mark their article."""
    pages = pd.read_parquet("/root/testdata/sf0.001/pages.parquet")["html"]
    counts = Counter()
    for page in pages:
        if "<article" in page or "<main" in page:
            counts.update(count_keys(page))
    keys = sorted({key for key, _ in counts})
    return fit([(key, counts[key, True], counts[key, False]) for key in keys])


def test_clashing_columns(spark, tmp_path):
    path = str(tmp_path / "clash")
    layout = "page_id long, html string, key string, inside int, page int, _page int"
    row = (1, "<article><p>One two three.</p></article>", "k", 2, 3, 4)
    spark.createDataFrame([row, (2, None, "k", 2, 3, 4)], layout).write.parquet(path)
    pages = spark.read.parquet(path)
    keep = ["page_id", "key", "inside", "page", "_page"]
    found = {r["page_id"]: r for r in extract(pages, train(pages), keep).collect()}
    assert [tuple(found[i][c] for c in keep) for i in (1, 2)] == [(1, "k", 2, 3, 4), (2, "k", 2, 3, 4)]
    assert (found[1]["text"], found[2]["text"]) == ("One two three.", "")
