import time

import pytest

from corpusmill.operators.dom import inner_html
from corpusmill.operators.markdown import markdown
from corpusmill.operators.markup import Mode, attribute_text, tokens
from corpusmill.operators.tree import MOST_DEPTH, parse


def body(html, doctype="<!doctype html>"):
    return inner_html(parse(doctype + html).first("body"))


#: Worked out from the standard's rules, not from the code.
TREES = [
    ('<table><tr><td>a<td>b<tr><td>c</table>', '<table><tbody><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></tbody></table>'),
    ('<b>a<div>b</b>c</div>', '<b>a</b><div><b>b</b>c</div>'),
    ('<table><p>x</p></table>', '<p>x</p><table></table>'),
    ('<p>1<b>2<i>3</b>4</i>5</p>', '<p>1<b>2<i>3</i></b><i>4</i>5</p>'),
    ('<b>1<p>2</b>3</p>', '<b>1</b><p><b>2</b>3</p>'),
    ('<table><b><tr><td>aaa</td></tr>bbb</table>ccc', '<b></b><b>bbb</b><table><tbody><tr><td>aaa</td></tr></tbody></table><b>ccc</b>'),
    ('A<table><tr> B</tr> B</table>', 'A B B<table><tbody><tr></tr></tbody></table>'),
    ('A<table><tr> B</tr> </em>C</table>', 'A BC<table><tbody><tr></tr> </tbody></table>'),
    ('<a href=1>x<div>y<a href=2>z</div>', '<a href="1">x</a><div><a href="1">y</a><a href="2">z</a></div>'),
    ('<p>a<table><tr><td>b</table>c', '<p>a</p><table><tbody><tr><td>b</td></tr></tbody></table>c'),
    ('<select><option>a<option>b<p>c</select>d', '<select><option>a</option><option>bc</option></select>d'),
    ('<table><col><td>x', '<table><colgroup><col></colgroup><tbody><tr><td>x</td></tr></tbody></table>'),
    ('<table><caption>c<p>d<tr><td>e<table><tr><td>f</table>g</table>', '<table><caption>c<p>d</p></caption><tbody><tr><td>e<table><tbody><tr><td>f</td></tr></tbody></table>g</td></tr></tbody></table>'),
    ('<ul><li>a<li>b<ul><li>c</ul><li>d</ul>', '<ul><li>a</li><li>b<ul><li>c</li></ul></li><li>d</li></ul>'),
    ('<dl><dt>a<dd>b<dt>c</dl>', '<dl><dt>a</dt><dd>b</dd><dt>c</dt></dl>'),
    ('<b><b><b><b>x</b></b></b></b><p>y', '<b><b><b><b>x</b></b></b></b><p>y</p>'),
    ('<p><b><b><b><b>x<p>y', '<p><b><b><b><b>x</b></b></b></b></p><p><b><b><b>y</b></b></b></p>'),
    ('x</p>a</br>b', 'x<p></p>a<br>b'),
    ('<svg viewbox=1><path d=x /><lineargradient></svg>a<svg><p>b', '<svg viewBox="1"><path d="x"></path><linearGradient></linearGradient></svg>a<svg></svg><p>b</p>'),
    ('<pre>\n\na</pre><textarea>\n<b>&amp;</textarea>', '<pre>\na</pre><textarea>&lt;b&gt;&amp;</textarea>'),
    ('x<script><!--<script>a</script>b--></script>c', 'x<script><!--<script>a</script>b--></script>c'),
    ('<p>a<h1>b<h2>c</h3>d', '<p>a</p><h1>b</h1><h2>c</h2>d'),
    ('<form>a<form>b</form>c</form>d', '<form>ab</form>cd'),
    ('<button>a<button>b', '<button>a</button><button>b</button>'),
    ('a<!-->b<!--c--!>d<?e>f</ g>h</>i', 'a<!---->b<!--c-->d<!--?e-->f<!-- g-->hi'),
    ("<a title='x&copy=1&copy;&amp'>", '<a title="x&amp;copy=1©&amp;"></a>'),
    ('<template><tr><td>x</td></tr></template>y', '<template><tr><td>x</td></tr></template>y'),
    ('<div>a</body> b</html>c<!--d-->', '<div>a bc<!--d--></div>'),
    ('<table><tr><td>x</th>y</td></tr><input type=hidden><input></table>', '<input><table><tbody><tr><td>xy</td></tr><input type="hidden"></tbody></table>'),
    ('<a><table><td><a><table></table><a></tr><a></table><b>X</b>C<a>Y', '<a><a></a><table><tbody><tr><td><a><table></table></a><a></a></td></tr></tbody></table></a><a><b>X</b>C</a><a>Y</a>'),
    ('<font><p>hello<b>cruel</font>world', '<font></font><p><font>hello<b>cruel</b></font><b>world</b></p>'),
    ('<b><em><foo><foob><fooc><aside></b></em>', '<b><em><foo><foob><fooc></fooc></foob></foo></em></b><aside><b></b></aside>'),
    ('<div><a><b><u><i><code><div></a>', '<div><a><b><u><i><code></code></i></u></b></a><u><i><code><div><a></a></div></code></i></u></div>'),
]


@pytest.mark.parametrize("html,want", TREES)
def test_tree(html, want):
    assert body(html) == want


def test_quirks():
    """Without a doctype of today a table doesn't end a paragraph."""
    for doctype, want in (("", "<p>a<table></table></p>"), ('<!DOCTYPE html PUBLIC "-//W3C//DTD HTML 3.2 Final//EN">', "<p>a<table></table></p>"), ("<!DOCTYPE html>", "<p>a</p><table></table>"), ('<!DOCTYPE html PUBLIC "-//W3C//DTD XHTML 1.0 Strict//EN" "u">', "<p>a</p><table></table>")):
        assert body("<p>a<table>", doctype) == want


def test_head_and_body():
    doc = parse(" <!--x--><html lang=en><title>a&amp;<b></title><meta x> \n<style>p</style></head> <link> text<title>late</title><body class=c>")
    assert inner_html(doc.first("head")) == '<title>a&amp;&lt;b&gt;</title><meta x=""><style>p</style><link>'
    assert inner_html(doc.first("body")) == "text<title>late</title>" and doc.first("body").attrs == {"class": "c"} and doc.first("html").attrs == {"lang": "en"}
    assert body("") == "" and body("<") == "&lt;" and body("a</") == "a&lt;/" and body("<p") == "" and body("a<p b='") == "a"


def test_text_is_one_node():
    paragraph = parse("<p>a</x>b&amp;<y").first("p")
    assert [c.data for c in paragraph.children] == ["ab&"]


def test_templates_hold_no_part_of_the_document():
    doc = parse("<body>a<template><p>b</p></template>")
    assert doc.first("p") is None and doc.first("body").text() == "a" and markdown(doc.first("body")) == "a"
    assert inner_html(doc.first("body")) == "a<template><p>b</p></template>"


def test_depth_is_bounded():
    node, depth = parse("<div>" * 5000 + "x").first("body"), 0
    while node.children and hasattr(node.children[-1], "children"):
        node, depth = node.children[-1], depth + 1
    assert depth <= MOST_DEPTH and body("<div>" * 5000 + "x" + "</div>" * 5000 + "y").endswith("y")


@pytest.mark.parametrize("value,want", [("a&copy;b", "a©b"), ("a&copy=1", "a&copy=1"), ("a&copyb", "a&copyb"), ("&copy", "©"), ("&#65;&#x42&unknown;", "AB&unknown;"), ("?a=1&lt=2&gt;", "?a=1&lt=2>")])
def test_references_in_attributes(value, want):
    assert attribute_text(value) == want


def test_tokens():
    got = [tuple(t) for t in tokens("<A HREF=x/ b c='&lt;' B=2 / >t<br/></a x>\r\n<![CDATA[y]]>", Mode())]
    assert got == [("start", "a", {"href": "x/", "b": "", "c": "<"}, False), ("text", "t", None, False), ("start", "br", {}, True), ("end", "a", None, False), ("text", "\n", None, False), ("comment", "[CDATA[y]]", None, False)]


HARD = {
    "unclosed": "<b>" * 10_000,
    "reopened": "<i><div>y</div>" * 4000,
    "paragraphs": "<b><p>x</p>" * 4000,
    "nested": "<p><b>x" * 4000,
    "distinct": "".join(f"<p><b id={k}>" for k in range(1500)),
    "fostered": "<table>" + "<p>x</p>" * 4000,
    "tables": "<table><tr><td>" * 3000,
    "adopted": "<b><div>" * 3000 + "</b>" * 3000,
    "links": "<a href=1><div>" * 3000,
    "comments": "<!--" * 20_000,
    "quotes": "<a b='" * 20_000,
    "text": "x</zz>" * 20_000,
}


@pytest.mark.parametrize("name", HARD)
def test_hard_markup_takes_a_second(name):
    began = time.process_time()
    parse(HARD[name])
    assert time.process_time() - began < 1
