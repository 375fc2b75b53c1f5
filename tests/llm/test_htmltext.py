import re
from html import unescape

import pandas as pd
import pytest

from claimwise.llm.htmltext import extract, main_text

LONG = "This is the first paragraph of the article, with commas, and words enough to be told from the rest of it."


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>Site</title>{head}</head><body>{body}</body></html>"


def test_pages_of_the_test_data_against_their_article():
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet")
    for html in pages["html"]:
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", html, re.S)[1]
        plain = re.sub(r"</?(?:p|h1|br)>", " ", inner).replace("<b>", "").replace("</b>", "")
        assert main_text(html) == " ".join(unescape(plain).split())


@pytest.mark.parametrize("other", [
    '<nav><a href="/a">Menu, one</a></nav>', '<div id="menu"><ul><li><a href=x>Home</a></li></ul></div>', "<header>Site, name</header>",
    "<footer>Some rights, reserved.</footer>", '<div class="sidebar"><p>Side, text, of, some, length, for all who read the side.</p></div>',
    "<aside><p>Also, read, this, piece, of text in the side bar of the page.</p></aside>", '<div class="cookie-notice"><p>We use cookies, of course, and you agree.</p></div>',
    '<div class="ad">Buy now, cheap, cheap, cheap.</div>', '<p class="advert">Buy now, cheap.</p>', "<form>Your name, please <input><button>Send</button></form>", "<script>var a = '<p>x, y</p>';</script>",
    "<style>p { color: red, blue }</style>", "<noscript>Turn it on, please</noscript>", '<section id="comments"><p>Great, article, indeed, says the reader, who comments at length here, and more.</p></section>',
    '<div class="comment-body"><p>First, comment, here.</p></div>', '<div style="display:none">hidden, text</div>', "<!-- a comment, <p>not text</p> -->", '<div role="navigation">a, b</div>', "<div hidden>c, d</div>"])
@pytest.mark.parametrize("container", ["article", 'div class="content"', "main"])
def test_other_parts_are_left_out(container, other):
    name = container.split()[0]
    article = f"<{container}><p>{LONG}</p><p>Second &amp; last paragraph, also of some length, &eacute;t&#233;.</p>"
    expected = f"{LONG} Second & last paragraph, also of some length, été."
    assert main_text(page(f"{other}{article}</{name}>")) == expected
    assert main_text(page(f"{article}</{name}>{other}")) == expected
    assert main_text(page(f"{article}{other}</{name}>")) == expected


def test_blocks_white_space_and_broken_markup():
    html = page(f"<article><h1>Title</h1><p>{LONG}<p>Second   para\n\tgoes<br>on <b>bold<i>er</b> text</i>.<ul><li>one<li>two</ul><table><tr><td>a<td>b</table><blockquote>Quote</blockquote>tail")
    assert main_text(html) == f"Title {LONG} Second para goes on bolder text. one two a b Quote tail"
    assert main_text(f"<div><p>{LONG}<div><p>More, text, here, for the reader") == f"{LONG} More, text, here, for the reader"


def test_small_and_odd_pages():
    for html in (None, "", "   ", "<p", "<!--", "<script>x", "<html><head><title>only</title></head><body></body></html>", "<nav>menu</nav>"):
        assert main_text(html) == ""
    assert main_text("plain &lt;text&gt;, only") == "plain <text>, only"
    assert main_text("a < b > c") == "a < b > c"
    assert main_text("<div>" * 5000 + f"<p>{LONG}</p>" + "</div>" * 5000) == LONG
    assert main_text(f"<article><p>{LONG * 3000}</p></article>") == LONG * 3000


def test_table_of_pages(spark):
    rows = [(1, "u", page(f"<article><p>{LONG}</p></article>")), (1, "u", page(f"<article><p>{LONG}</p></article>")), (2, None, None), (None, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(map(str, ((r.page_id, r.text) for r in extract(df).collect()))) == sorted(map(str, [(1, LONG), (1, LONG), (2, ""), (None, "")]))
    assert extract(df.limit(0)).count() == 0 and extract(df.withColumnRenamed("url", "text")).columns == ["page_id", "text", "html"]


@pytest.mark.parametrize("name", ["page right-sidebar", "content sidebar-left", "site-content comments-open", "nav-wrapper"])
def test_frames_with_layout_words_keep_the_article(name):
    second = "Second and last paragraph, also of some length, for the reader."
    side = '<div class="sidebar"><p>Side, text, of, some, length.</p></div><div class="menu"><a href="/">Home</a></div>'
    readers = "<div class='comments'>" + "<p>Great, article, indeed, says the reader.</p>" * 20 + "</div>"
    for inner in (f"<p>{LONG}</p><p>{second}</p>", f"<div class='post'><p>{LONG}</p><p>{second}</p></div>{side}"):
        assert main_text(page(f"<div class='{name}'>{inner}</div>")) == f"{LONG} {second}"
    assert main_text(page(f"<div class='text'><p>{LONG}</p><p>{second}</p></div>{readers}")) == f"{LONG} {second}"


SECOND = "Second and last paragraph, also of some length, for the reader."
COMMENT = "Great, article, indeed, says the reader, who comments at length here, and more, and more again, so that it is long."


@pytest.mark.parametrize("comment", ['article class="comment-body"', 'article id="comment-12" class="comment even"', 'article class="comment"', "article"])
@pytest.mark.parametrize("block", ['div id="comments"', 'section class="comments-area"', 'div class="comment-list"'])
@pytest.mark.parametrize("post", ['div class="entry-content"', 'article class="post"', "article", 'div class="text"'])
def test_readers_comments_in_article_tags(post, block, comment):
    name, outer = post.split()[0], block.split()[0]
    comments = "".join(f"<{comment}><p>{COMMENT}</p></article>" for _ in range(4))
    for heading in ("", "<h2>Comments</h2>", "<h3>4 replies</h3>"):
        html = page(f"<{post}><p>{LONG}</p><p>{SECOND}</p></{name}><{block}>{heading}{comments}</{outer}>")
        assert main_text(html) == f"{LONG} {SECOND}"
        html = page(f"<{post}><p>{LONG}</p><p>{SECOND}</p></{name}>{heading}<{block}>{comments}</{outer}>")
        assert main_text(html) == f"{LONG} {SECOND}"
        html = page(f"<{post}><p>{LONG}</p><p>{SECOND}</p>{heading}<{block}>{comments}</{outer}></{name}>")
        assert main_text(html) == f"{LONG} {SECOND}"


@pytest.mark.parametrize("extra", [
    f'<aside class="related"><article><h3>Teaser, with a title</h3><p>{COMMENT}</p></article></aside>', f"<nav><article><p>{COMMENT}</p></article></nav>",
    f"<footer><article><p>{COMMENT}</p></article></footer>", f'<section class="user-reviews"><h2>What readers say</h2><p>{COMMENT}</p></section>',
    f'<div class="reader-comments"><p>{COMMENT}</p></div>', '<span class="advert">Buy now, cheap</span>', '<a class="share" href="/s">Share this, please</a>',
    '<a class="share-button" href="/s">Share</a>', f'<div class="related-posts"><p>{COMMENT}</p></div>', f'<section class="cookie-notice"><p>{COMMENT}</p></section>',
    '<div class="search-tools"><a href="/">One</a> <a href="/">Two</a></div>'])
def test_side_parts_inside_an_article(extra):
    for at in (f"<p>{LONG}</p>{extra}<p>{SECOND}</p>", f"<p>{LONG}</p><p>{SECOND}</p>{extra}"):
        assert main_text(page(f"<article>{at}</article>")) == f"{LONG} {SECOND}"
    assert main_text(page(f"<article><p>{LONG}</p><p>{SECOND}</p></article>{extra}")) == f"{LONG} {SECOND}"


@pytest.mark.parametrize("own", ['section id="search-algorithms"', 'div class="related-work"', 'div id="menu-of-the-day"', 'section id="alert-levels"', 'section class="social-history"'])
def test_sections_of_the_article_with_words_of_side_parts(own):
    name = own.split()[0]
    inner = f"<{own}><h2>A section</h2><p>{COMMENT}</p></{name}>"
    assert main_text(page(f"<article><p>{LONG}</p>{inner}<p>{SECOND}</p></article>")) == f"{LONG} A section {COMMENT} {SECOND}"
    assert main_text(page(f'<article><p>{LONG}</p><p class="notice-of-terms">{SECOND}</p></article>')) == f"{LONG} {SECOND}"


def test_headings_stay_with_their_text():
    assert main_text(page(f"<div class=content><h1>Title</h1><p>{LONG}</p><h2>Part</h2><p>{SECOND}</p></div>")) == f"Title {LONG} Part {SECOND}"
    assert main_text(page(f"<h1>Title</h1><div class=share><a href=/>x</a></div><div class=content><p>{LONG}</p></div><h2>More to read</h2><div class=related><a href=/>y</a></div>")) == f"Title {LONG}"
    assert main_text(page(f"<article><p>{LONG}</p><h2>Part</h2><div class=ad>Buy</div><p>{SECOND}</p></article>")) == f"{LONG} Part {SECOND}"
