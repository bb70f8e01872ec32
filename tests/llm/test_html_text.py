import html
import re
import time

import pytest

from idweave.llm import html_text
from idweave.llm.html_text import main_text
from idweave.llm.queries import op12_html

LONG = "This is a paragraph of the article, long enough to count, with commas, and no links."
NAV = "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>"


@pytest.mark.parametrize("source,want", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), (NAV, ""), ("<div class='ad'>buy now</div>", ""),
    ("no tags at all", "no tags at all"), ("<p>short", "short"),
    # character references, with and without semicolon, cut off, invalid
    ("<p>a &lt;b&gt; &amp c &am d&eacute;e &#233; &#xD800;.", "a <b> & c &am d\xe9e \xe9 �."),
    # white space within and between blocks; inline elements join, blocks part
    ("<p> a \n\t b<b>c</b>d<br>e&nbsp;f </p><p>g</p>h<div>i</div>", "a bcd e f g h i"),
    # scripts, styles, comments, quoted brackets
    ("<p>a<script>if (a<b) x='<p>no</p>'</script>b<style>p{}</style></p><!-- <p>no</p> --><p title='x>y'>c</p>", "ab c"),
    ("<p>a<!-- never closed <p>b", "a"), ("<![cdata[x]]><p>a</p><?php y ?><p>b</p></nothing>", "a b"),
])
def test_small_pages(source, want):
    assert main_text(source) == want


def test_what_is_not_the_article_goes():
    page = f"""<!DOCTYPE html><html><head><title>Title</title><style>x</style></head><body class="has-sidebar">
    <header><h1>The site</h1></header>{NAV}
    <div class="cookie-notice"><p>We use cookies, many of them, on this site, as everyone does, and more.</p></div>
    <div id=wrap><main><article><header><h1>Headline</h1><span>by someone</span></header>
    <p>{LONG}<p>Second &amp; <a href=x>linked</a> words.<ul><li>one<li>two</ul>
    <div class="share-buttons"><a href=1>Tweet</a> <a href=2>Mail</a></div>
    <ul><li><a href=x>Related one</a><li><a href=y>Related two</a></ul>
    <form><label>Name, please, and more, and more</label><input></form></article></main>
    <aside><p>{LONG} {LONG} {LONG}</p></aside></div>
    <section id="comments"><p>I think, as always, that this, though long, is no part of the article.</p></section>
    <div style="display: none"><p>{LONG}</p></div><footer>&copy; us</footer>"""
    assert main_text(page) == f"Headline {LONG} Second & linked words. one two"


def test_containers_without_article():
    plain = f"<div id=top><a href=1>a</a> <a href=2>b</a></div><div id=x><h2>Head</h2><p>{LONG}</p><p>{LONG}</p></div><div>{LONG}</div>"
    assert main_text(plain) == f"Head {LONG} {LONG} {LONG}"
    sections = f"<body>{NAV}<article><section><p>{LONG}</p></section><section><p>ok</p></section></article>"
    assert main_text(sections) == f"{LONG} ok"
    table = f"<table><tr><td>{LONG}<td>b<tr><td>c</table>"
    assert main_text(table) == f"{LONG} b c"
    # everything lies in an element with a suspicious class
    assert main_text(f"<div class=widget><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>") == " ".join([LONG] * 4)


def test_broken_pages_take_linear_time():
    start = time.time()
    for source in ("<div>" * 50_000 + "x", "<div>" * 20_000 + "</foo>" * 20_000, "<p a=\"" * 20_000, "<!--" * 50_000,
                   "<li><ul>" + "<figcaption>" * 20_000 + "<li></li>" * 20_000, "<a href=x>" * 30_000 + LONG,
                   "<p>a, b <b>c</b>" * 30_000):
        main_text(source)
    assert time.time() - start < 60


def test_pages_of_the_table(spark):
    """On the given pages the text is the article element's."""
    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op12_html(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.sub(r"</?(?:a|b)\b[^>]*>", "", re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1])
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert r.text == want and r.n_chars == len(want)


def test_defined_cases(spark, tmp_path):
    kind = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", "<p>a\U0001f600", "x", "y"), (1, "u", "<p>a\U0001f600", "x", "y"), (None, None, None, None, None),
            (2, "v", "<p>" + "long, " * 200_000, "", "")]
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(op12_html(spark, str(tmp_path)).collect(), key=repr)
    assert [(r.page_id, r.url, r.n_chars) for r in got] == [(1, "u", 2), (1, "u", 2), (2, "v", 1_199_999), (None, None, 0)]
    assert html_text.extract(spark.createDataFrame([], kind)).count() == 0
