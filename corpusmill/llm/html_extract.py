"""Main-text extraction by minimum-cut labelling of a page's blocks.

One pass over the markup gives the page's text blocks in order, each with the elements
that it stands in. A linear classifier over a block's features (elements and names around
it, share of linked text, length, sentence marks) gives the costs of calling it content or
boilerplate; they are the capacities of its terminal edges. Its weights, and the scale of
smoothness against them, are fitted on labelled pages of many templates (html_training).
Neighbouring blocks are joined by smoothness edges, stronger the more of their ancestors they share, and blocks of one
section also to the section's other blocks through a hub. The cut of least capacity between
the terminals is the labelling: content is what stays on the source's side.

A block whose terminal difference is at least the capacity of all its smoothness edges has
that label in some minimum cut, so such blocks are settled first and folded into their
neighbours' terminals, again and again; Dinic's algorithm cuts what is left.

Rules of the text: character references are decoded, white space inside a block becomes
one space, blocks are trimmed, empty ones go, the others are joined by one line feed.
Scripts, styles, forms, templates, comments and markup have no text; a form that holds the
page's layout (an article, main, nav, header or footer) is no form but a wrapper of it. The
work is linear in the markup, however deep or unclosed it is. Markup that is cut off, unclosed or wrongly nested is taken as browsers take it: an unfinished tag at the end
is no text, an end tag without its start is ignored.

Defined results: a null or empty page gives an empty text; a page without a block called
content too; a null page_id or url is passed on; repeated rows each give a row; an empty
table gives no rows; of several cuts of least capacity the one with the fewest blocks of
content counts, save what the settling of blocks has fixed; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import slices

TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)"
    r"|<(?:[!?])[^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?P<close>>|\Z)"
    r"|</[^a-zA-Z>][^>]*(?:>|\Z)|</>",
    re.S,
)
BROKEN_TAG = re.compile(r"</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
ATTR = re.compile(r"""([^\s"'>/=]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
ATTRS_READ = frozenset("class id role aria-label itemprop hidden aria-hidden style".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is raw up to their end tag, and those whose text is no text of the page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset("script style textarea title xmp iframe noembed noframes noscript template select option datalist label legend svg object head annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mspace mpadded mphantom semantics annotation annotation-xml button select option datalist output meter progress svg object".split()
)
#: A start tag of these ends an open p; and what else an element ends when it starts.
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt".split())
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "body": ("head",)}
SCOPES = frozenset("table ul ol dl article section div body html nav aside main".split())

#: Words that speak for boilerplate or content in a class, id, role or label. A name of several words speaks only if
#: each of them does, or is one of PLACES: market-share and legal-history say nothing, post-share and site-footer do.
BOILER = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promos promotion banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside widget widgets footer foot header masthead topbar toolbar cookie cookies consent gdpr notice notices alert alerts disclaimer popup modal overlay newsletter subscribe subscription signup login share sharing social related recommend recommended recommendation recommendations trending popular comment comments replies reply disqus respond feedback rating pagination pager tag tags tagcloud copyright legal skip search form hidden cta teaser teasers complementary contentinfo dialog".split()
)
CONTENT = frozenset("article content main post entry story body text prose articlebody".split())
PLACES = frozenset("a area bar block blocks bottom box btn button buttons cloud col column container first fixed global group head in inner item items js large last left line link links list main more outer page panel primary right row secondary section side site small sticky the top widget wrap wrapper zone articles news posts stories".split())
_PAIRS = (("side-bar", "sidebar"), ("sign-up", "signup"), ("sign-in", "login"), ("sr-only", "hidden"), ("tag-cloud", "tagcloud"), ("article-body", "articlebody"), ("post-body", "articlebody"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: What the classifier reads of a block, and its weights, in favour of content: as html_training.fit() gives them.
FEATURES = ("bias", "linked", "article", "main", "boiler_tag", "boiler_name", "content_name", "paragraph", "heading", "long", "sentence", "linked_core", "bare", "outside")
WEIGHTS = (-1.06, -4.08, 1.62, 2.48, -10.44, -7.79, 4.62, 2.21, 2.93, 0.06, 0.03, 3.68, 5.25, -4.97)
#: Share of a page's text from which its largest article, or an element around it, is the page's core.
ARTICLE_SHARE, WRAPPER_SHARE = 1 / 3, 1 / 2
LONG_CHARS = 80
BOILER_TAGS = frozenset("nav footer aside header menu dialog search".split())
#: Smoothness: between neighbours with one parent, with the same section, and of other sections; to a section's hub.
SAME_PARENT, SAME_SECTION, APART, HUB = 0.8, 0.4, 0.05, 0.3
#: Its scale against the costs of the classifier, chosen on pages that the weights were not fitted on.
SCALE = 2.0
#: Elements that a form has only if it is a wrapper of the page.
LAYOUT = frozenset("article main nav header footer".split())


@lru_cache(10_000)
def spoken(name: str, in_article: bool) -> str:
    """What a name speaks for, by all its words: boiler, content, or nothing. Within an article a header is the place of its title."""
    text = re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()
    words = "-".join(re.findall("[a-z]+", text))
    for pair, one in _PAIRS:
        words = words.replace(pair, one)
    found = [w for w in words.split("-") if not (in_article and w in ("header", "head"))]
    boiler = [w for w in found if w in BOILER]
    if boiler and all(w in BOILER or w in PLACES or w in CONTENT for w in found):
        return "boiler"
    return "content" if not boiler and any(w in CONTENT for w in found) and all(w in CONTENT or w in PLACES for w in found) else ""


class Element:
    __slots__ = ("tag", "parent", "section", "article", "main", "boiler_tag", "content_name", "unseen", "core", "named_boiler", "mark", "boiler", "size", "block", "inline", "scope", "open", "form", "layout")

    def __init__(self, tag: str, parent: Element | None, attrs: str):
        self.tag, self.parent = tag, parent
        p = parent
        self.article = tag == "article" or bool(p and p.article)
        self.main = tag == "main" or bool(p and p.main)
        # a header of an article holds its title; any other one is the page's
        boiler = tag in BOILER_TAGS and not (tag == "header" and p and p.article)
        self.boiler_tag = boiler or bool(p and p.boiler_tag)
        self.content_name = bool(p and p.content_name)
        self.core = tag if tag in ("main", "article") else ""
        self.named_boiler = self.boiler = False
        self.size = 0
        self.unseen = tag in UNSEEN or bool(p and p.unseen)
        # the nearest element that is no inline one, with what inline ones are open in it; the same for scopes
        self.block = p.block if p and tag in INLINE else self
        self.scope = p.scope if p and tag not in SCOPES else self
        self.inline, self.open = {}, {}
        self.form, self.layout = self if tag == "form" else p.form if p else None, False
        had_name = self.content_name
        if attrs and tag not in ("html", "body", "meta", "link"):
            self.named(attrs)
        # what a form has only if it is a wrapper of the page
        if p and p.form and (tag in LAYOUT or self.core or self.content_name and not had_name and not p.form.article and not p.form.main):
            f = p.form
            while f and not f.layout:
                f.layout = True
                f = f.parent.form if f.parent else None
        # the nearest element, this one or around it, that is a core or has a boilerplate name
        self.mark = self if self.core or self.named_boiler else p.mark if p else None
        self.section = p.section if p and tag not in ("article", "main", "section", "nav", "aside", "footer", "header", "div", "body", "form", "table", "td", "ul", "ol") else self

    @property
    def boiler_name(self) -> bool:
        return bool(self.mark and self.mark.boiler)

    def named(self, attrs: str) -> None:
        names = []
        for m in ATTR.finditer(attrs):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key not in ATTRS_READ:
                continue
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and HIDDEN.search(value):
                self.unseen = True
            elif key == "role" and value.lower() in ("main", "article"):
                self.main, self.core = True, value.lower()
            elif key in ("class", "id"):
                names += value.split()
            elif key in ("role", "aria-label", "itemprop"):
                names.append("-".join(value.split()))
        for name in names:
            said = spoken(name, self.article)
            self.named_boiler |= said == "boiler"
            self.content_name |= said == "content"
        if self.named_boiler:
            self.content_name = False


def weigh_names(marks: list[Element], found: list[Block]) -> None:
    """Whether the boilerplate names of marks count, outer elements first.

    A name on an element around the core of its page, or on the core, is that of a layout. The
    core is each main; without one, the largest article that is a good part of the page's
    text; without that, where nothing long is free of boilerplate names, each element that
    holds most of the text.
    """
    for m in marks:
        m.boiler = m.named_boiler or bool(m.parent and m.parent.boiler_name)
    if not any(m.named_boiler for m in marks):
        return
    total = 0
    for b in found:
        if not b.element.boiler_tag:
            total += len(b.text)
            if b.element.mark:
                b.element.mark.size += len(b.text)
    for m in reversed(marks):
        if m.parent and m.parent.mark:
            m.parent.mark.size += m.size
    core = [m for m in marks if m.core == "main" and m.size]
    if not core:
        core = [max((m for m in marks if m.core == "article" and m.size >= ARTICLE_SHARE * total > 0), key=lambda m: m.size, default=None)]
    if core == [None]:
        free = any(len(b.text) >= LONG_CHARS and not b.element.boiler_tag and not b.element.boiler_name and b.linked < 0.5 for b in found)
        core = [] if free else [m for m in marks if m.named_boiler and m.size > WRAPPER_SHARE * total]
    layout: set[int] = set()
    for m in core:
        while m and id(m) not in layout:
            layout.add(id(m))
            m = m.parent.mark if m.parent else None
    for m in marks:
        m.boiler = m.named_boiler and id(m) not in layout or bool(m.parent and m.parent.boiler_name)


@dataclass
class Block:
    text: str
    element: Element
    linked: float
    #: It stands in no article, main or element named so, on a page that has one.
    outside: bool = False

    @property
    def core(self) -> bool:
        return self.element.article or self.element.main or self.element.content_name


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in order."""
    root = Element("html", None, "")
    here, out = root, []
    marks: list[Element] = []
    parts: list[str] = []
    links = pressed = 0  # characters of the parts that stand in links, and on buttons
    holder = root

    def flush() -> None:
        nonlocal links, pressed
        if parts:
            whole = "".join(parts)
            text = " ".join(unescape(whole).split())
            # what is on a button is read where it stands in a sentence
            if text and pressed < len(whole.strip()):
                out.append(Block(text, holder, min(1.0, links / len(text))))
            parts.clear()
        links = pressed = 0

    anchors = buttons = 0

    def say(text: str) -> None:
        nonlocal holder, links, pressed
        if here.unseen or not text:
            return
        if not parts:
            if text.isspace():
                return
            holder = here.block
        parts.append(text)
        if anchors:
            links += len(text)
        if buttons:
            pressed += len(text)

    def pop_to(e: Element) -> None:
        nonlocal here, anchors, buttons
        while here is not e:
            if here.tag == "a":
                anchors -= 1
            buttons -= here.tag == "button"
            if here.tag not in INLINE:
                flush()
            else:
                here.block.inline[here.tag] -= 1
            here.parent.scope.open[here.tag] -= 1
            names[here.tag] -= 1
            here = here.parent

    names: Counter = Counter()  # open elements by name

    def enclosing(tags: tuple[str, ...]) -> Element | None:
        """The nearest open element of tags within the scope. It is looked for only if it is there, and then it is closed."""
        if not any(here.scope.open.get(t) for t in tags):
            return None
        e = here
        while e.tag not in tags:
            e = e.parent
        return e

    at, n = 0, len(html)
    while at < n:
        less = html.find("<", at)
        if less < 0:
            say(html[at:])
            break
        if less > at:
            say(html[at:less])
        m = TOKEN.match(html, less) or BROKEN_TAG.match(html, less)
        if not m:
            say("<")
            at = less + 1
            continue
        at = m.end()
        groups = m.groupdict() if m.re is TOKEN else {}
        name = groups.get("name")
        if name is None or groups.get("close") != ">":
            continue  # a comment, a declaration, or a tag cut off by the end
        name = name.lower()
        if groups["end"]:
            if name == "br":
                say(" ")
            elif name == "p" and not enclosing(("p",)):
                flush()
            elif here.block.inline.get(name) if name in INLINE else names[name]:
                e = here
                while e.tag != name:
                    e = e.parent
                pop_to(e.parent)
            continue
        if name in CLOSES_P and (p := enclosing(("p",))):
            pop_to(p.parent)
        if name in IMPLIED and (e := enclosing(IMPLIED[name])):
            pop_to(e.parent)
        if name in HEADINGS and here.tag in HEADINGS:
            pop_to(here.parent)
        if name in VOID or groups["attrs"].endswith("/") and name in ("svg", "path"):
            if name in ("br", "wbr"):
                say(" " if name == "br" else "")
            elif name not in INLINE:
                flush()
            continue
        if name in RAW:  # none of it is text of the page
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if name not in INLINE:
            flush()
        if name == "a":
            if (e := enclosing(("a",))) is not None:
                pop_to(e.parent)
            anchors += 1
        buttons += name == "button"
        here = Element(name, here, groups["attrs"])
        here.parent.scope.open[name] = here.parent.scope.open.get(name, 0) + 1
        names[name] += 1
        if name in INLINE:
            here.block.inline[name] = here.block.inline.get(name, 0) + 1
        if here.mark is here:
            marks.append(here)
    flush()
    out = without_forms(out)
    weigh_names(marks, out)
    cored = any(b.core and not b.element.boiler_tag and not b.element.boiler_name for b in out)
    for b in out:
        b.outside = cored and not b.core
    return out


def without_forms(found: list[Block]) -> list[Block]:
    """The blocks that stand in no form, but for forms that are wrappers: by what is in them, or by most of the page's long texts."""
    long = [b for b in found if len(b.text) >= LONG_CHARS and not b.element.boiler_tag and b.linked < 0.5]
    total, inside = sum(len(b.text) for b in long), Counter()
    for b in long:
        f = b.element.form
        if f and not f.article and not f.main:
            inside[f] += len(b.text)
    for f, n in inside.items():
        f.layout |= n > WRAPPER_SHARE * total
    return [b for b in found if not b.element.form or b.element.form.layout]


def features(block: Block) -> tuple[float, ...]:
    """The values of FEATURES."""
    e, text = block.element, block.text
    paragraph, sentence = e.tag in ("p", "pre", "blockquote", "dd", "td", "li"), text[-1] in ".!?:;\"')”»"
    return (1.0, block.linked, e.article, e.main, e.boiler_tag, e.boiler_name, e.content_name, paragraph, e.tag in HEADINGS, len(text) >= LONG_CHARS, sentence, block.linked * block.core, e.tag in ("body", "html") and block.linked < 0.5, block.outside)


def score(block: Block) -> float:
    """The classifier's log odds that a block is content."""
    return sum(w * x for w, x in zip(WEIGHTS, features(block), strict=True))


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each node whether it is on the source's side of a minimum cut.

    scores: capacity from the source less that to the sink; edges go both ways.
    """
    n = len(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    value, label = list(scores), [None] * n
    weight = [sum(x.values()) for x in near]
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is not None or abs(value[i]) < weight[i]:
            continue
        label[i] = value[i] > 0
        for j, w in near[i].items():
            if label[j] is None:
                value[j] += w if label[i] else -w
                weight[j] -= w
                queue.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        for i, side in zip(rest, _dinic(rest, value, near, label), strict=True):
            label[i] = side
    return label


def _dinic(rest: list[int], value: list[float], near: list[dict[int, float]], label: list) -> list[bool]:
    """Max-flow over the open nodes; the source's side is what the source still reaches."""
    index = {i: k for k, i in enumerate(rest)}
    source, sink = len(rest), len(rest) + 1
    to, cap, out = [], [], [[] for _ in range(len(rest) + 2)]

    def edge(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        cap.append(forth)
        out[b].append(len(to))
        to.append(a)
        cap.append(back)

    for k, i in enumerate(rest):
        if value[i] > 0:
            edge(source, k, value[i], 0.0)
        elif value[i] < 0:
            edge(k, sink, -value[i], 0.0)
        for j, w in near[i].items():
            if label[j] is None and i < j:
                edge(k, index[j], w, w)
    tiny = 1e-12
    while True:
        level = [-1] * len(out)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if cap[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(len(rest))]
        turn = [0] * len(out)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                first = next(k for k, e in enumerate(path) if cap[e] <= tiny)
                a = to[path[first] ^ 1]
                del path[first:]
                continue
            while turn[a] < len(out[a]):
                e = out[a][turn[a]]
                if cap[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(out[a]):
                path.append(e)
                a = to[e]
            elif path:
                e = path.pop()
                a = to[e ^ 1]
                turn[a] += 1
            else:
                break


def smoothness(found: list[Block], scale: float = SCALE) -> tuple[int, list[tuple[int, int, float]]]:
    """The number of nodes, hubs of sections included, and the edges between them."""
    edges, hubs = [], {}
    sections: dict[int, list[int]] = {}
    for i, b in enumerate(found):
        sections.setdefault(id(b.element.section), []).append(i)
        if i:
            a = found[i - 1].element
            same = SAME_PARENT if a.parent is b.element.parent else SAME_SECTION if a.section is b.element.section else APART
            edges.append((i - 1, i, scale * same))
    n = len(found)
    for key, members in sections.items():
        if len(members) > 2:
            hubs[key] = n
            edges += [(i, n, scale * HUB) for i in members]
            n += 1
    return n, edges


def labels(found: list[Block], scores: list[float], scale: float = SCALE) -> list[bool]:
    """Which blocks are content, by the minimum cut."""
    n, edges = smoothness(found, scale)
    return min_cut(scores + [0.0] * (n - len(found)), edges)[: len(found)]


def main_text(html: str | None) -> str:
    found = blocks(html or "")
    return "\n".join(b.text for b, keep in zip(found, labels(found, [score(b) for b in found]), strict=True) if keep)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            out = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


#: What the method finds on pages of one plain template: the blocks of the article element.
ORACLE = r"""WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|\z)', 1), '<[a-z/][^>]*\z', '') AS b FROM pages),
    p AS (SELECT page_id, url, list_transform(regexp_split_to_array(regexp_replace(b, '</?b>|<br>', '', 'g'), '</?(?:p|h1|article)>'),
        lambda x: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS l FROM a)
SELECT page_id, url, array_to_string(list_filter(l, lambda x: x <> ''), chr(10)) AS text, length(array_to_string(list_filter(l, lambda x: x <> ''), chr(10)))::BIGINT AS n_chars FROM p"""
