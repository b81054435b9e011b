import html
import re

import pytest

from punctual.llm import html_text

SCHEMA = "page_id long, url string, html string, text string, n_chars int"
LONG = (
    "This is the story of a man who was in the town and of the people that he met there with his "
    "friends, and it is a long one for all of us."
)
OTHER = (
    "And then there was the other thing that they had to do for it to be done in the way that we "
    "would all like it to be, as it was."
)


def test_article_pages(spark, medium):
    """The blocks of the article element, decoded, and nothing else."""
    pages = spark.read.parquet(f"{medium}/pages.parquet")
    got = {r.page_id: r for r in html_text.page_texts(pages).collect()}
    for page in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|\Z)", page.html, re.S)[1]
        body = re.sub(r"<[^>]*\Z", "", body)
        blocks = re.split(r"</?(?:p|h1)>", body)
        texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
        row = got[page.page_id]
        assert row.text == "\n".join(t for t in texts if t)
        assert row.n_chars == len(row.text) and row.url == page.url


def test_page_without_an_article_element():
    page = f"""<html><body class="page"><header><h1>Site</h1></header>
    <div id="cookie-notice">{LONG}</div><nav><a href=x>Home</a></nav>
    <div class="wrap"><h2>Great title</h2><p>{LONG}</p><p>Short.</p><p>{OTHER}</p>
    <p><a href="/1">{LONG}</a></p></div>
    <div class=sidebar><p>{LONG}</p></div><section class="comments"><p>{LONG}</p></section>
    <form><p>Sign up for the list</p></form><p style="display: none">{LONG}</p>
    <footer>{LONG}</footer></body>"""
    assert html_text.main_text(page) == f"Great title\n{LONG}\nShort.\n{OTHER}"


def test_furniture_inside_the_article():
    page = f"""<article><h1>T</h1><p>{LONG}</p><aside>{LONG}</aside><div class="adBox">{LONG}</div>
    <ul class="share-links"><li>Tweet</li></ul><p>xyz qwe</p>
    <article class="comment"><p>{OTHER}</p></article></article><p>{OTHER}</p>"""
    assert html_text.main_text(page) == f"T\n{LONG}\nxyz qwe"


def test_names_that_mark_the_article():
    page = f"""<div id="wrap"><p>{LONG}</p><div class="post-content"><div class="entry-header">Title
    </div><p>Short one.</p><p>{OTHER}</p><div class="post-footer">{LONG}</div></div></div>"""
    assert html_text.main_text(page) == f"Title\nShort one.\n{OTHER}"


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<p>x", ""),
        ("<article>a &lt; b&nbsp;c 1<2 &copy d</article>", "a < b c 1<2 © d"),
        ('<article>a<script>var x="</p>"</script>b<p>c<a href="', "a b\nc"),
        ("<article>one<br>two <b>th</b>ree<!-- no --> four", "one two three four"),
        ("<article>x\n\t y&#x41;&amp;amp;</article>", "x yA&amp;"),
        ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
        ("<article><div><p>a<p>b</div>c</article>", "a\nb\nc"),
        ("<main><p title='>'>q</p></main>", "q"),
    ],
)
def test_markup(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    "icon",
    [
        '<svg class="i"/>',
        "<svg class='a>b' />",
        "<math/>",
        "<object data='x'/>",
        '<iframe src="/x"/>',
        "<svg class=i/><path/></svg>",
        "<svg><path d='M0'/>no</svg>",
    ],
)
def test_self_closed_elements_are_empty(icon):
    page = f"<body>{icon}<article><p>{LONG}</p><p>{icon}{OTHER}</p></article>{icon}</body>"
    assert html_text.main_text(page) == f"{LONG}\n{OTHER}"


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="layout has-sidebar"><article><p>{LONG}</p><p>{OTHER}</p></article></div>',
        f'<div class="post no-comments"><p>{LONG}</p><p>{OTHER}</p></div>',
        f'<div class="sidebar layout"><article><p>{LONG}</p><p>{OTHER}</p></article></div>',
        f'<div class="sidebar"><div class="post-content"><p>{LONG}</p><p>{OTHER}</p></div></div>',
        f'<main><div class="widget"><p>{LONG}</p><p>{OTHER}</p></div></main>',
        f"<html><head><title>t</title><meta x><body><article><p>{LONG}</p><p>{OTHER}</p></article>",
        f"<html><head><title>t</title><p>{LONG}</p><p>{OTHER}</p>",
        f"<head><title>t</title>{LONG}<p>{OTHER}</p>",
    ],
)
def test_wrappers_and_open_heads_hide_no_article(page):
    assert html_text.main_text(page) == f"{LONG}\n{OTHER}"


def test_cards_in_furniture_stay_behind_the_article():
    cards = f'<div class="related"><article><p>{LONG}</p></article></div>'
    page = f"<main><p>{LONG}</p><p>{OTHER}</p></main>{cards}"
    assert html_text.main_text(page) == f"{LONG}\n{OTHER}"
    assert html_text.main_text(f"<div><p>{LONG}</p><p>{OTHER}</p></div>{cards}") == f"{LONG}\n{OTHER}"
    hidden = f'<div class="sidebar" hidden><article><p>{LONG}</p></article></div>'
    assert html_text.main_text(hidden) == ""


def test_edges(spark):
    rows = [
        (1, None, None, "x", 1),
        (2, "u", "", None, None),
        (2, "u", "<article>twice", None, None),
        (2, "u", "<article>twice", None, None),
        (None, "u", "<article><p>" + "long " * 60_000, None, None),
    ]
    got = html_text.page_texts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, 5, 5, 5 * 60_000 - 1]
    assert html_text.page_texts(spark.createDataFrame([], SCHEMA)).count() == 0


PROSE = "It was a cold day and the rain fell on the roofs of the town, so we all stayed at home and read for hours."


@pytest.mark.parametrize(
    "page",
    [
        '<div data-headline="The hidden cost of rain"><p>{}</p></div>',
        '<section aria-label="our hidden rivers"><p>{}</p></section>',
        '<div class="hidden md:block"><p>{}</p></div>',
        '<div class="md:block hidden lg:flex"><p>{}</p></div>',
        '<p title="display: none">{}</p>',
        "<!--><p>{}</p>",
        "<!---><p>{}</p>",
        "<!-- x --!><p>{}</p>",
        "<canvas><p>{}</p>",
        "<video src=x><p>{}</p>",
        "<p>{}</p><object data=x>",
    ],
)
def test_text_that_only_looks_hidden(page):
    assert html_text.main_text(page.format(PROSE)) == PROSE


@pytest.mark.parametrize(
    "element",
    [
        "<p hidden>{}</p>",
        '<p aria-hidden="true">{}</p>',
        '<p style="color: red; display : none">{}</p>',
        "<canvas><p>{}</p></canvas>",
        "<object data=x><p>{}</p></object>",
    ],
)
def test_hidden_text(element):
    other = PROSE.replace("cold", "warm")
    assert html_text.main_text(f"<p>{PROSE}</p>" + element.format(other)) == PROSE


def test_stray_end_tags_take_linear_time():
    import time

    def seconds(n):
        start = time.perf_counter()
        html_text.main_text("<div>" * n + "</span></b></ul>" * n + f"<p>{PROSE}</p>")
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(64_000) < 40 * max(seconds(8_000), 0.05)


def test_other_scripts():
    russian = "Это первый абзац статьи, который достаточно длинный, чтобы его можно было признать текстом по всем правилам."
    chinese = "这是文章的第一段，它足够长，可以根据任何规则被识别为正文，而且没有任何链接，因此应该被保留下来。" * 2
    for text in (russian, chinese):
        menu = "<ul><li><a href=x>主页</a></li><li><a href=y>Новости</a></li></ul>"
        assert html_text.main_text(f"{menu}<p>{text}</p><p>{text}</p>") == f"{text}\n{text}"


def test_blocks_decide_without_article_tags(medium, spark):
    pages = [r.html for r in spark.read.parquet(f"{medium}/pages.parquet").collect()]
    marked = [html_text.main_text(p) for p in pages]
    bare = [html_text.main_text(re.sub(r"</?article[^>]*>", "", p, flags=re.I)) for p in pages]
    same = sum(a == b for a, b in zip(marked, bare))
    halved = sum(2 * len(b) < len(a) for a, b in zip(marked, bare))
    assert same > 0.95 * len(pages) and halved < 0.02 * len(pages)
