import time

import pytest

from corpusmill.config import ANY_SITE, SiteProfile, parse_arguments
from corpusmill.operators.dom import inner_html
from corpusmill.operators.extract import extract_one
from corpusmill.operators.markdown import markdown
from corpusmill.operators.tree import parse

SITE = SiteProfile(product="Thing")


def text(body):
    return extract_one(f"<body>{body}</body>", SITE)["text"]


@pytest.mark.parametrize(
    "body,want",
    [
        ("<nav>n</nav><p>a</p><footer>f</footer>", "a"),
        ('<div class="x promo-y">p</div><div class="is-nextish">c</div>b', "b"),
        ('<div class="ad">kept</div>', "kept"),
        ("a<script>s</script><style>t</style><noscript>u</noscript><iframe>v</iframe>b", "ab"),
        ("<h2>NEW TO THING? x</h2>loose<p>a</p><h3>b</h3><h2>c</h2><p>d</p>", "loosecd"),
        ("<h3>Next article</h3><p>a</p><h4>b</h4><h3>c</h3>", "c"),
        ("<h3>Next article now</h3>", "Next article now"),
        ("<div><h2>Want to learn more?</h2><div><h1>in</h1></div></div><p>o</p>", "o"),
        ("<section>x<p>See our Cookie Settings</p></section>y", "y"),
        ('<div id="w"><div>q <a href="/services/education/">go</a> This free lesson</div>r</div>', "r"),
        ('<p><a href="/services/education/">go</a></p>', "go"),
        ('a<img src="/course_book.png">b', "ab"),
        ("a<div><b>Thank you for your feedback! </b></div>b", "ab"),
        ('a<i onclick="x__doPostBack()">c</i>b<a href="javascript:void 0">j</a>', "ab"),
        ("a<br>b<!-- c -->d", "abd"),
        ("  a  ﻿", "a"),
    ],
)
def test_cleaning(body, want):
    assert text(body) == want


def test_fields():
    page = '<html><head><title> A  &amp;\nB </title></head><body><header><h1> Head </h1></header><nav aria-label="the breadcrumb"><a>Home</a><a> </a><span aria-current="page">Here</span><span>no</span></nav><p>x</p><!--c--></body></html>'
    got = extract_one(page, SITE)
    assert (got["title"], got["heading"], got["breadcrumb"], got["text"], got["html"]) == ("A & B", "Head", ["Home", "Here"], "x", "<p>x</p><!--c-->")
    assert extract_one(None, SITE)["text"] == extract_one("", SITE)["title"] == ""
    assert extract_one("<p>x", SITE, selectors=("p",))["text"] == ""
    assert extract_one('<div class="sf-breadcrumb"><a>Home</a></div>', SITE)["breadcrumb"] == ["Home"]
    assert extract_one("<div>" * 3000 + "x", ANY_SITE)["text"] == "x" and extract_one("<div>" * 3000 + "x", ANY_SITE)["error"] is None


@pytest.mark.parametrize(
    "html,want",
    [
        ("<h1>T</h1><p>a <b>b</b> <em>c</em></p>", "# T\n\na **b** _c_"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "*   a\n*   b\n    \n    *   c"),
        ("<ol start=3><li>a</li><li>b</li></ol>", "3.  a\n4.  b"),
        ('<pre><code class="language-js">x = 1;\n</code></pre>', "```js\nx = 1;\n```"),
        ('<p>see <a href="/u" title="t">it</a> and <code>c`d</code></p>', 'see [it](/u "t") and ``c`d``'),
        ("<blockquote><p>q</p><p>r</p></blockquote>", "> q\n>\n> r"),
        ("<p>1. *x* [y] _z_</p>", r"1\. \*x\* \[y\] \_z\_"),
        ("a<hr>b<br>c", "a\n\n* * *\n\nb  \nc"),
        ('<img src="i.png" alt="k">', "![k](i.png)"),
        ("<p><b>x<br><p>y</p>", "**x  \n**\n\n**y**"),
    ],
)
def test_markdown(html, want):
    assert markdown(parse(html).first("body")) == want


def test_tree_round_trip():
    html = '<div class="a&quot;b"><p>x &lt; y &amp; z</p><br><script>a<b</script><!--c--></div>'
    body = parse(html).first("body")
    assert inner_html(body) == html and inner_html(parse(inner_html(body)).first("body")) == html
    assert inner_html(parse("<!doctype html><p>a<p>b<table><tr><td>c<td>d</table><p cla").first("body")) == "<p>a</p><p>b</p><table><tbody><tr><td>c</td><td>d</td></tr></tbody></table>"


def test_arguments():
    assert parse_arguments([]).max_pages is None and parse_arguments([]).stale_seconds == 86400
    assert parse_arguments(["5", "0"]).max_pages == 5 and parse_arguments(["Infinity", "60x"]).stale_seconds == 60
    with pytest.raises(SystemExit) as e:
        parse_arguments(["many"])
    assert e.value.code == 1


def test_cleaning_is_linear():
    """Deep markup, and very many matches under one parent."""
    for make in (lambda k: "<div>x" * k, lambda k: "<div><p>This free lesson</p><a href='/services/education/x'>y</a></div>" * k, lambda k: "<p>Cookie Settings</p>" * k, lambda k: "<span>Thank you for your feedback!</span>" * k, lambda k: "<div>" * k + "<a href='/services/education/x'>y</a>" * k):
        took = []
        for k in (1500, 6000):
            began = time.process_time()
            assert extract_one("<body>" + make(k), SITE)["error"] is None
            took.append(time.process_time() - began)
        assert took[1] < 10 * took[0] + 0.3, took
