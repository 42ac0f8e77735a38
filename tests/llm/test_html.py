"""Operator 7: main text of pages written for the purpose."""

from civitas.llm import html

from .helpers import with_clashes

PAGE = """<!DOCTYPE html><html><head><title>Not text</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header class="site-header"><h1>The Site</h1><p>its motto in a few words</p></header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site, as every site does these days.</div><!-- <p>no</p> -->
<article><header><h1>The title</h1></header><p>First &amp; para with <a href="x">a link</a>.
<p>Second&nbsp;para<br>same   block<ul><li>item one<li>item two</ul>
<aside class="related"><a href="1">More</a> things that others read</aside><form><label>Mail</label><input><button>Go</button></form>
<p class="advert">Buy now!</p><p>Last &lt;one&gt; &eacute;&#233;&#xe9;</p>
<section id="comments"><h3>Comments</h3><article class="comment"><p>I think that this is a great article and I agree.</p></article></section></article>
<div class="sidebar"><p>Long sidebar text with many words that are no part of it.</p></div><footer>&copy; somebody</footer></body></html>"""
TEXT = "The title First & para with a link. Second para same block item one item two Last <one> ééé"


def test_furniture_goes_and_the_article_stays():
    assert html.main_text(PAGE) == TEXT


def test_page_without_main_element():
    page = """<div id="nav"><a href=1>A</a> <a href=2>B</a></div><div class="post"><h2>Hello</h2><p>Some words that make
    a paragraph long enough to be text.</p><p>Short one.</p></div><div class="comments"><p>Nice!</p></div>"""
    assert html.main_text(page) == "Hello Some words that make a paragraph long enough to be text. Short one."


def test_layout_wrappers_are_not_furniture():
    body = "<h1>The title</h1><p>A paragraph of the article that is long enough to be text.</p><p>And one more of them.</p>"
    text = "The title A paragraph of the article that is long enough to be text. And one more of them."
    side = '<div class="sidebar"><p>Text beside the article.</p></div>'
    for wrapper in ('div class="page has-sidebar"', 'div id="wrap" class="content-sidebar"', 'div class="post tag-news"',
                    'section class="no-comments"', 'div class="page-with-banner"', 'div class="post comments-open"', 'div class="layout sidebar"'):
        end = wrapper.split()[0]
        for inner in (body, f"<article>{body}</article>", f"<main>{body}</main>", f'<div class="content">{body}</div>'):
            assert html.main_text(f"<body><{wrapper}>{inner}{side}</{end}><footer>the end</footer></body>") == text, wrapper
    # a wrapper does not lose a short article to a long sidebar
    assert html.main_text(f'<div class="content-sidebar"><article>{body}</article><div class="sidebar">{"<p>many words</p>" * 40}</div></div>') == text


def test_furniture_by_name_beside_the_article():
    body = "<article><h1>The title</h1><p>A short article.</p></article>"
    for name in ("ad", "ad-box", "sidebar", "related-posts", "cookie-notice", "comments", "post-comments", "share tag-news"):
        for inner in ("<p>long text in it</p>" * 30, "<article><p>long text in it</p></article>" * 30):
            assert html.main_text(f'{body}<div class="{name}">{inner}</div>') == "The title A short article.", name
    comments = '<div class="comments">' + "<p>a long comment on it</p>" * 30 + "</div>"
    assert html.main_text(f'<div class="post"><h2>Hello</h2><p>Some words that make a paragraph.</p></div>{comments}') == "Hello Some words that make a paragraph."
    assert html.main_text('<div class="ad"><p>Buy now, and buy all of it!</p></div>') == ""


def test_cut_and_odd_markup():
    cases = {None: "", "": "", "plain text": "plain text", "<p>cut <b": "cut", "<article><p>a</p><p>b &am": "a b &am",
             "<article><p>a<script>x</p>": "a", "<article>1 < 2 and 3 > 2</article>": "1 < 2 and 3 > 2",
             "<ARTICLE><P>Caps</ARTICLE>": "Caps", "<article><p title='a>b'>quoted</p></article>": "quoted",
             "<article></div></p>stray</article>": "stray", "<article><p>no break\t\n x</p></article>": "no break x"}
    for page, text in cases.items():
        assert html.main_text(page) == text


def test_trained_tree_fits_its_table():
    import numpy as np
    tree = html.trained_tree()
    pages = html.cut_pages()
    wrong = sum(html.verdict(tree, row) != b[5] for page in pages for b, row in zip(page, html.neighbours(page), strict=True))
    assert wrong <= 0.02 * sum(map(len, pages)) and isinstance(tree, tuple)
    assert html.grow_tree(np.zeros((3, 2)), np.array([1, 1, 0])) == 1


def test_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", ""), (3, "w", "<article>" + "<p>word word</p>" * 20_000)]
    pages = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string"), "text", "n_chars", "row")
    got = html.extract_main_text(pages)
    assert got.columns == ["page_id", "url", "row", "text", "n_chars"]
    want = [TEXT, TEXT, "", "", " ".join(["word word"] * 20_000)]
    assert sorted((r["text"], r["n_chars"]) for r in got.collect()) == sorted((t, len(t)) for t in want)
    assert html.extract_main_text(pages.limit(0)).count() == 0
    only = spark.createDataFrame([("<p>x",)], "html string")
    assert [r["text"] for r in html.extract_main_text(only).collect()] == ["x"]


def test_the_last_block_stays():
    """The same article with and without a header, a menu, a main element and anything behind it."""
    parts = ["<h1>The title</h1>", "<p>A first paragraph, long enough to be text of an article.</p>", "<p>Second one.</p>",
             "<p>The last paragraph has more than four words in it.</p>"]
    for n in range(1, 5):
        body, text = "".join(parts[:n]), " ".join(x[x.index(">") + 1:x.index("</")] for x in parts[:n])
        for main in ("article", "main"):
            for before in ("", "<header><p>The site</p></header>", "<nav><a href=1>One</a> <a href=2>Two</a></nav>", '<div class="ad">Buy this now</div>'):
                for after in ("", "<footer>The end</footer>", "<nav><a href=1>One</a></nav>", '<div class="sidebar"><p>Text beside it</p></div>'):
                    assert html.main_text(f"<body>{before}<{main}>{body}</{main}>{after}</body>") == text


def test_sections_are_not_named_away():
    text = "The title Some words before it. Words of the section in question. Some words after it."
    for name in ('id="discussion"', 'id="related-work"', 'class="share-price"', 'id="advertising"', 'class="tags-explained"', 'class="alert"',
                 'id="search"', 'id="legal"', 'class="menu-item-recipes"', 'id="feedback"'):
        page = (f"<article><h1>The title</h1><p>Some words before it.</p><section {name}><p>Words of the section in question.</p></section>"
                "<p>Some words after it.</p></article>")
        assert html.main_text(page) == text, name
        # a menu of links under such a name is furniture all the same
        assert html.main_text(f"<article><p>Some words before it.</p><div {name}><a href=1>One</a> <a href=2>Two</a></div></article>") == "Some words before it."
    linked = "<article><h1>The title</h1><p>Some words.</p><p><a href=1>A paragraph</a> <a href=2>of links</a></p></article>"
    assert html.main_text(linked) == "The title Some words. A paragraph of links"
    for name in ("comments", "ad", "newsletter", "share-buttons", "cookie-notice"):
        assert html.main_text(f'<article><p>Some words.</p><div class="{name}"><p>Not words of the article.</p></div></article>') == "Some words."


def test_what_follows_the_article_changes_nothing():
    import pyarrow.parquet as pq
    n = 0
    for page in pq.read_table("/root/testdata/sf0.1/pages.parquet")["html"].to_pylist():
        end = (page or "").rfind("</article>")
        if end > 0:
            n += 1
            assert html.main_text(page[:end + 10]) == html.main_text(page) == html.main_text(page[:end])
    assert n > 1000


def test_deep_markup_in_linear_time():
    import time
    for page in ("<div>" * 64_000, "<div><p>x</b></ul>" * 20_000, '<div class="sidebar"><p>x</p>' * 12_000, "<ul><li>" * 40_000 + "</ul>" * 40_000):
        start = time.time()
        html.main_text(page + "<p>word</p>")
        assert time.time() - start < 3
