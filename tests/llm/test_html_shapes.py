"""Page shapes with the text a reader would pick by hand, broken pages, and limits of time."""

import time

import pytest

from shelfmark.llm.html import main_text

P1, P2 = "First part, with commas, and words, enough to count.", "Second part, also long, which goes on, and on."
BODY = f"<p>{P1}</p><p>{P2}</p>"
TEXT = [P1, P2]
COMMENT = "<p>I, for one, disagree, strongly, with, all, of, this, really.</p>"

SHAPES = {
    "heading ids in an article": (f'<article><h2 id="related-work">Related work</h2><p>{P1}</p><h2 id="social-impact">Impact</h2><h3 id="search">Search</h3>'
                                  f'<p id="comments-on">{P2}</p></article>', ["Related work", P1, "Impact", "Search", P2]),
    "section ids in an article": (f'<article><section id="search"><p>{P1}</p></section><section id="share"><p>{P2}</p></section></article>', TEXT),
    "tags paragraph in an article": (f'<article>{BODY}<p class="tags">red, blue</p></article>', [*TEXT, "red, blue"]),
    "page in one form": (f'<body><form id="aspnetForm" action="x"><input type=hidden value=1><div id="content">{BODY}</div></form></body>', TEXT),
    "article in a form beside a search form": (f'<form id=page><form class=search><p>Search the site</p></form><article>{BODY}</article></form>', TEXT),
    "comment form": (f'<article>{BODY}</article><form><label>Name</label><p>Leave, a, reply</p><input></form>', TEXT),
    "form inside the article": (f'<article><p>{P1}</p><form><p>Your mail</p></form><p>{P2}</p></article>', TEXT),
    "references as links": (f'<article>{BODY}<ol><li><a href=1>Smith, A study of many words, 2020</a></li><li><a href=2>Jones, Another of them, 2021</a></li></ol></article>',
                            [*TEXT, "Smith, A study of many words, 2020", "Jones, Another of them, 2021"]),
    "menu of links in the article": (f'<article>{BODY}<ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul></article>', TEXT),
    "links outside the article": (f'<article>{BODY}</article><ul><li><a href=1>A long title of some other article here</a></li></ul>', TEXT),
    "comments as articles": (f'<article>{BODY}</article><article class="comment">{COMMENT}</article><article class="comment-body depth-2">{COMMENT}</article>', TEXT),
    "comments as articles inside": (f'<article><p>{P1}</p><p>{P2}</p><section id="comments"><article class="comment">{COMMENT * 5}</article></section></article>', TEXT),
    "article with a sidebar class": (f'<body class="has-sidebar"><article class="post has-sidebar no-comments">{BODY}</article></body>', TEXT),
    "related content": (f'<div class="post"><div class="post-body">{BODY}</div><div class="related-content">{COMMENT}</div></div>', TEXT),
    "newsletter body": (f'<main>{BODY}<div class="newsletter-body"><p>Sign up, now.</p></div></main>', TEXT),
    "article footer block": (f'<div id=main><div class="article-text">{BODY}</div><div class="article-footer"><p>Posted in x</p></div></div>', TEXT),
    "entry header": (f'<div class="post"><div class="entry-header"><h1>Title</h1></div>{BODY}</div>', ["Title", *TEXT]),
    "header in the article": (f'<article><header class="page-header"><h1>Title</h1></header>{BODY}</article>', ["Title", *TEXT]),
    "site header": (f'<div class="header"><p>Site, name, here</p></div><article>{BODY}</article>', TEXT),
    "two good classes": (f'<div class="widget main-content">{BODY}</div>', TEXT),
    "never outvoted": (f'<article>{BODY}<div class="post-body advert"><p>Buy, this, now.</p></div></article>', TEXT),
    "hidden parts": (f'<article>{BODY}<div hidden><p>a, b</p></div><div style="display: none">c</div><div aria-hidden="true">d</div></article>', TEXT),
    "words in other attributes": (f'<article><p title="class=ad id=comments" data-role="nav">{P1}</p><p alt="hidden">{P2}</p></article>', TEXT),
    "roles": (f'<div role="navigation"><p>Go, there</p></div><div role="main">{BODY}</div><div role="contentinfo"><p>By, us</p></div>', TEXT),
    "cookie notice": (f'<div id="cookie-banner"><p>We, use, cookies, and, more.</p></div><div id="page">{BODY}</div>', TEXT),
    "unclosed paragraphs": (f'<article><p>{P1}<p>{P2}</article>', TEXT),
    "unclosed list items": (f'<article>{BODY}<ul><li>one<li>two</ul></article>', [*TEXT, "one", "two"]),
    "table cells": (f'<article>{BODY}<table><tr><td>1<td>2<tr><td>3</table></article>', [*TEXT, "1", "2", "3"]),
    "definition list": (f'<article>{BODY}<dl><dt>word<dd>meaning</dl></article>', [*TEXT, "word", "meaning"]),
    "references and white space": ("<article><p>a&nbsp;&amp;\n\t b &lt;p&gt; &#33;</p><p>c&eacute; &unknown; &#x41;</p></article>", ["a & b <p> !", "cé &unknown; A"]),
    "markup in attributes": (f'<article><p data-x="<p>a > b</p>">{P1}</p><p data-y=\'"\'>{P2}</p></article>', TEXT),
    "comments and cdata": (f'<article><!-- <p>no</p> --><p>{P1}</p><![CDATA[more]]><p>{P2}</p><!doctype x></article>', [P1, "more", P2]),
    "less than signs": ("<article><p>a < b, and 1<2, x <- y</p></article>", ["a < b, and 1<2, x <- y"]),
    "an odd quote": (f'<article><p title="x>{P1}</p><p>{P2}</p></article>', TEXT),
    "upper case": (f'<ARTICLE><P>{P1}</P><SCRIPT>var a = "<p>";</SCRIPT><P>{P2}</P></ARTICLE><FOOTER>f</FOOTER>', TEXT),
    "unclosed svg and noscript": (f'<article><svg><p>{P1}</p><noscript><p>{P2}</p></article>', TEXT),
    "stray end tags": (f'</div></p><article></section>{BODY}</ul></article></article>', TEXT),
    "blockquote and pre": (f'<article><blockquote><p>{P1}</p></blockquote><pre>{P2}</pre></article>', TEXT),
    "no blocks at all": ("just, text", ["just, text"]),
    "only a menu": ("<nav><a href=x>Home</a></nav>", []),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_shape(shape):
    page, want = SHAPES[shape]
    assert main_text(page) == "\n".join(want)
    assert main_text(f"<!doctype html><html><head><title>t</title></head><body><nav><p>Menu, here</p></nav>{page}</body></html>") == "\n".join(want)


def within(seconds, page):
    start = time.perf_counter()
    out = main_text(page)
    assert time.perf_counter() - start < seconds
    return out


def test_pages_cut_anywhere():
    page = ("<!doctype html><html><body><div class='x' id=\"y\"><article data-a=\"b > c\"><!-- c --><p>One, two &amp; three</p><a href='u' title=v>link"
            "</a><svg width=1><path d='M0'/></svg><script>if (a<b) x</script><p>four</article></div></body></html>")
    for end in range(len(page) + 1):
        within(0.5, page[:end])
    assert main_text(page[:page.index("<a href") + 6]) == "One, two & three"


@pytest.mark.parametrize("page", [
    "<article><p>a, b</p></article><a " + "x" * 10**6, "<p>if a <b&&c__" + "y" * 10**6, "<a " * 300_000, '<a x="' * 200_000, "<a x='\">" * 100_000,
    "</section>" * 100_000, "<svg>" * 50_000, "<" * 500_000, "<!--" * 100_000, "<a b=' >" * 100_000, "<iframe>" * 100_000, "<p a=b " * 100_000 + ">"],
    ids=lambda p: p[-12:])
def test_broken_pages_take_linear_time(page):
    within(5, page)


@pytest.mark.parametrize("tag", ["div", "center", "form", "li", "p", "a", "section", "table", "td", "article", "font"])
def test_deep_nesting_takes_linear_time(tag):
    assert within(2, f"<{tag}>" * 20_000 + "x, y" + f"</{tag}>" * 20_000) == "x, y"
    within(2, f"<{tag}>" * 10_000 + "<p>x</p></section>" * 10_000)
