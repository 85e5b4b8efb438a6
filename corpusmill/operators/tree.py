"""The document tree of any markup, built as browsers build it.

Which rules hold is told by the innermost open element of STRUCTURE: a table takes only rows
and sections, and what does not belong there goes before it (foster parenting); missing
sections, rows and column groups are made; a cell ends where the next begins. Formatting
elements that a block has cut go on in it, three equal ones at most, and an end tag of one
that stands across blocks parts both (the adoption agency). SVG and MathML keep to themselves.

Scripts count as run, so noscript is raw text. Without a doctype of today a table stands in
the paragraph before it (quirks). A template's content is no part of the
document. The tree is never deeper than MOST_DEPTH: deeper elements stand beside each other.
"""

from __future__ import annotations

import re
from collections import Counter

from corpusmill.operators.dom import SPACE, SVG_ATTRIBUTES, SVG_TAGS, VOID, Comment, Node, Text
from corpusmill.operators.markup import Mode, Token, tokens

# The element groups of the HTML standard.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
BLOCKS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer header hgroup main menu nav ol p search section summary ul listing pre".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MARKED = frozenset("applet marquee object".split())
SPECIAL = BLOCKS | HEADINGS | MARKED | HEAD | frozenset("area body br button caption col colgroup dd dt embed form frame frameset head hr html iframe img input keygen li noembed param plaintext select source table tbody td textarea tfoot th thead tr track wbr xmp".split()) - {"dialog"}
IMPLIED_END = frozenset("dd dt li optgroup option p rb rp rt rtc".split())
SECTIONS = frozenset(("tbody", "thead", "tfoot"))
ROW_PARTS = SECTIONS | {"table", "tr"}
TABLE_PARTS = SECTIONS | {"caption", "col", "colgroup", "td", "th", "tr"}
STRUCTURE = SECTIONS | {"caption", "colgroup", "html", "select", "table", "td", "template", "th", "tr"}
SCOPE = MARKED | {"caption", "html", "table", "td", "template", "th"}
INTEGRATION = frozenset("mi mo mn ms mtext annotation-xml foreignobject desc title".split())
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: A tree's depth, and the formatting elements that go on; both larger than what pages have.
MOST_DEPTH, MOST_FORMATTING = 512, 64


def svg_case(attrs: dict[str, str]) -> dict[str, str]:
    return {SVG_ATTRIBUTES.get(k, k): v for k, v in attrs.items()}


class Builder(Mode):
    def __init__(self):
        self.document = Node("#document")
        self.html, self.head, self.body = Node("html"), Node("head"), Node("body")
        self.document.append(self.html)
        self.html.append(self.head)
        self.html.append(self.body)
        self.open: list[Node] = []
        self.at: list[int] = []  # places in open of the elements of STRUCTURE
        self.counts: Counter = Counter()
        self.formatting: list[Node | None] = []  # None: a marker, which formatting doesn't cross
        self.form: Node | None = None
        self.templates: list[Node] = []  # the open ones
        self.held: list[Node] = []  # all
        self.raw_in: Node | None = None
        self.in_head, self.quirks, self.fostering, self.skip_line, self.closed = True, True, False, False, False
        self.push(self.html)
        self.push(self.body)

    # the open elements

    def push(self, node: Node) -> None:
        if node.tag in STRUCTURE and not node.space:
            self.at.append(len(self.open))
        self.open.append(node)
        self.counts[node.tag] += 1
        node.open = True

    def cut(self, at: int) -> None:
        """Closes the open elements from a place on."""
        for node in self.open[at:]:
            node.open = False
            self.counts[node.tag] -= 1
        del self.open[at:]
        while self.at and self.at[-1] >= at:
            self.at.pop()

    def lift(self, node: Node, by: Node | None = None) -> None:
        """Takes one element out of the open ones, or puts another in its place; neither is of STRUCTURE."""
        k = self.place_of(node)
        node.open = False
        self.counts[node.tag] -= 1
        if by is not None:
            self.open[k] = by
            self.counts[by.tag] += 1
            by.open = True
        else:
            del self.open[k]
            self.at = [x - (x > k) for x in self.at]

    def place_of(self, node: Node) -> int:
        return next(k for k in range(len(self.open) - 1, -1, -1) if self.open[k] is node)

    def inside(self) -> str:
        """The tag whose rules hold."""
        return self.open[self.at[-1]].tag

    def within_table(self, tags) -> int | None:
        """The place of the innermost open one of tags in the innermost table, that itself included."""
        for k in reversed(self.at):
            tag = self.open[k].tag
            if tag in tags:
                return k
            if tag in ("table", "template", "html"):
                return None
        return None

    def scoped(self, tags, also=()) -> int | None:
        """The place of the innermost open one of tags, if no element around which they don't reach stands between."""
        if not any(self.counts[t] for t in tags):
            return None
        for k in range(len(self.open) - 1, 0, -1):
            node = self.open[k]
            if node.space:
                if node.tag in INTEGRATION:
                    return None
            elif node.tag in tags:
                return k
            elif node.tag in SCOPE or node.tag in also:
                return None
        return None

    def implied_ends(self, but: str = "") -> None:
        k = len(self.open)
        while self.open[k - 1].tag in IMPLIED_END and self.open[k - 1].tag != but:
            k -= 1
        self.cut(k)

    def close(self, tags, also=()) -> bool:
        k = self.scoped(tags, also)
        if k is not None:
            self.cut(k)
        return k is not None

    def close_p(self) -> None:
        self.close(("p",), ("button",))

    # where things go

    def spot(self, parent: Node | None = None) -> tuple[Node, Node | None]:
        """The parent, and the child that what comes goes before, None at its end."""
        parent = parent or self.open[-1]
        if self.fostering and parent.tag in ROW_PARTS:
            k = next((k for k in reversed(self.at) if self.open[k].tag in ("table", "template")), 0)
            found = self.open[k]
            if found.tag == "table" and found.parent is not None:
                return found.parent, found
            return (found if found.tag == "template" else self.open[max(k - 1, 1)]), None
        if len(self.open) > MOST_DEPTH and parent is self.open[-1]:
            return self.open[MOST_DEPTH - 1], None
        return parent, None

    def place(self, node, parent: Node | None = None) -> None:
        to, before = self.spot(parent)
        to.put(node, before)

    def insert(self, tag: str, attrs: dict[str, str] | None = None, push: bool = True, space: str = "") -> Node:
        node = Node(tag, attrs, space)
        self.place(node)
        if push:
            self.push(node)
        return node

    def text(self, data: str) -> None:
        to, before = self.spot()
        k = len(to.children) if before is None else to.index(before)
        last = to.children[k - 1] if k else None
        if type(last) is Text:
            last.extend(data)
        else:
            to.put(Text(data), before)

    # formatting elements

    def remember(self, node: Node) -> None:
        alike = []
        for k in range(len(self.formatting) - 1, -1, -1):
            other = self.formatting[k]
            if other is None:
                break
            if other.tag == node.tag and other.attrs == node.attrs:
                alike.append(k)
        if len(alike) >= 3:
            del self.formatting[alike[-1]]
        self.formatting.append(node)
        if len(self.formatting) > MOST_FORMATTING:
            del self.formatting[next(k for k, x in enumerate(self.formatting) if x is not None)]

    def reopen(self) -> None:
        """Formatting elements that an end of something around them has closed go on here."""
        k = len(self.formatting)
        while k and (node := self.formatting[k - 1]) is not None and not node.open:
            k -= 1
        for j in range(k, len(self.formatting)):
            old = self.formatting[j]
            self.formatting[j] = self.insert(old.tag, dict(old.attrs))

    def to_marker(self) -> None:
        while self.formatting and self.formatting.pop() is not None:
            pass

    def known(self, tag: str) -> Node | None:
        """The last formatting element of a tag, none beyond a marker."""
        for node in reversed(self.formatting):
            if node is None or node.tag == tag:
                return node
        return None

    def forget(self, node: Node) -> None:
        self.formatting = [x for x in self.formatting if x is not node]

    def adopt(self, tag: str) -> None:
        """An end tag of a formatting element: blocks that were begun in it and go on beyond are parted from it."""
        here = self.open[-1]
        if here.tag == tag and not any(x is here for x in self.formatting):
            self.cut(len(self.open) - 1)
            return
        for _ in range(8):
            node = self.known(tag)
            if node is None:
                self.end_other(tag)
                return
            if not node.open:
                self.forget(node)
                return
            k = self.place_of(node)
            if any(x.tag in SCOPE and not x.space for x in self.open[k + 1 :]):
                return
            block_at = next((j for j in range(k + 1, len(self.open)) if self.open[j].tag in SPECIAL or self.open[j].space and self.open[j].tag in INTEGRATION), None)
            if block_at is None:
                self.cut(k)
                self.forget(node)
                return
            self.part(node, k, block_at)

    def part(self, node: Node, k: int, block_at: int) -> None:
        """The block leaves node, taking copies of the formatting between, and holds a copy of node around what was in it."""
        block, around = self.open[block_at], self.open[k - 1]
        after, last = node, block  # the copy of node is remembered behind `after`
        for steps, middle in enumerate(reversed(self.open[k + 1 : block_at]), 1):
            if steps > 3:
                self.forget(middle)
            if not any(x is middle for x in self.formatting):
                self.lift(middle)
                continue
            copy = Node(middle.tag, dict(middle.attrs))
            self.formatting = [copy if x is middle else x for x in self.formatting]
            self.lift(middle, copy)
            if last is block:
                after = copy
            last.remove()
            copy.append(last)
            last = copy
        last.remove()
        fostering, self.fostering = self.fostering, around.tag in ROW_PARTS
        self.place(last, around)
        self.fostering = fostering
        copy = Node(node.tag, dict(node.attrs))
        for child in block.children:
            copy.append(child)
        block.children = []
        block.append(copy)
        new = next(j for j, x in enumerate(self.formatting) if x is after) + 1
        self.formatting.insert(new, copy)
        self.forget(node)
        self.lift(node)
        place = self.place_of(block) + 1
        self.open.insert(place, copy)
        self.at = [x + (x >= place) for x in self.at]
        self.counts[copy.tag] += 1
        copy.open = True

    # tokens

    def take(self, t: Token) -> None:
        if t.kind == "doctype":
            said = t.data.lower()
            self.quirks = not re.match(r"html\b", said) or bool(re.search(r'"-//w3c//dtd html (?:3\.2|4\.0)[ "/]', said)) or bool(re.search(r'"-//w3c//dtd html 4\.01 (?:transitional|frameset)//[^"]*"\s*\Z', said))
            return
        if self.skip_line:
            self.skip_line = False
            if t.kind == "text":
                t = t._replace(data=t.data.removeprefix("\n"))
                if not t.data:
                    return
        if self.in_head:
            if t.kind == "text" and self.raw_in is None:
                t = t._replace(data=t.data.lstrip("\t\n\f\r "))
            if self.before_body(t):
                return
        if t.kind == "comment":
            if not self.closed:
                self.place(Comment(t.data))
            return
        if self.closed and (t.kind != "text" or t.data.strip(SPACE)):
            self.closed = t.kind == "end" and t.data in ("body", "html")
        here = self.open[-1]
        if here.space and not (here.tag in INTEGRATION and t.kind != "end") and self.foreign(t):
            pass
        elif t.kind == "text":
            self.characters(t.data)
        else:
            (self.start if t.kind == "start" else self.end)(t)
        self.cdata = bool(self.open[-1].space)

    def before_body(self, t: Token) -> bool:
        """Whether t is of the head; else the body has begun."""
        if t.kind == "comment":
            return True
        if t.kind == "text":
            if self.raw_in is not None:
                self.raw_in.append(Text(t.data))
                return True
            if not t.data:
                return True
        elif t.kind == "end":
            if t.data not in ("body", "html", "br"):
                self.raw_in = None
                return True
        elif t.data in ("html", "head"):
            target = self.html if t.data == "html" else self.head
            for key, value in t.attrs.items():
                target.attrs.setdefault(key, value)
            return True
        elif t.data in HEAD and t.data != "template":
            node = Node(t.data, t.attrs)
            self.head.append(node)
            if t.data in RAW:
                self.raw, self.raw_in = t.data, node
            return True
        self.in_head, self.raw_in = False, None
        return False

    def characters(self, data: str) -> None:
        blank, here, inside = not data.strip("\t\n\f\r "), self.open[-1].tag, self.inside()
        if here in RAW or inside == "select" or blank and (here in ROW_PARTS or here == "colgroup"):
            self.text(data)
        elif here == "colgroup":
            self.cut(self.at[-1])
            self.characters(data)
        elif inside in ROW_PARTS:
            self.fostered(lambda: (self.reopen(), self.text(data)))
        else:
            self.reopen()
            self.text(data)

    def fostered(self, act) -> None:
        before, self.fostering = self.fostering, True
        act()
        self.fostering = before

    def start(self, t: Token) -> None:
        tag, inside = t.data, self.inside()
        if tag in ("html", "body"):
            target = self.html if tag == "html" else self.body
            for key, value in t.attrs.items():
                target.attrs.setdefault(key, value)
        elif inside == "select":
            self.start_in_select(t)
        elif inside == "colgroup":
            if tag == "col":
                self.insert(tag, t.attrs, push=False)
            else:
                self.cut(self.at[-1])
                self.start(t)
        elif inside in ("caption", "td", "th") and tag in TABLE_PARTS:
            if self.end_part(inside):
                self.start(t)
        elif inside in ROW_PARTS:
            self.start_in_table(t, inside)
        elif inside == "template" and tag in TABLE_PARTS:
            self.insert(tag, t.attrs, push=tag != "col")
        else:
            self.start_in_body(t)

    def start_in_table(self, t: Token, inside: str) -> None:
        """Sections, rows and cells; those that are missing around them are made."""
        tag, top = t.data, self.at[-1] + 1
        if tag in ("td", "th"):
            self.cut(top)
            if inside == "tr":
                self.insert(tag, t.attrs)
                self.formatting.append(None)
            else:
                self.insert("tbody" if inside == "table" else "tr")
                self.start(t)
        elif tag == "tr" and inside != "tr":
            self.cut(top)
            if inside == "table":
                self.insert("tbody")
            self.insert("tr", t.attrs)
        elif tag in TABLE_PARTS and inside != "table":
            self.cut(self.at[-1])
            self.start(t)
        elif tag in TABLE_PARTS:
            self.cut(top)
            if tag == "col":
                self.insert("colgroup")
                self.start(t)
            else:
                self.insert(tag, t.attrs)
                if tag == "caption":
                    self.formatting.append(None)
        elif tag == "table":
            self.cut(self.within_table(("table",)) or len(self.open))
            self.start(t)
        elif tag in ("style", "script", "template"):
            self.start_in_body(t)
        elif tag == "input" and t.attrs.get("type", "").lower() == "hidden":
            self.insert(tag, t.attrs, push=False)
        elif tag == "form":
            if self.form is None:
                self.form = self.insert(tag, t.attrs, push=False)
        else:
            self.fostered(lambda: self.start_in_body(t))

    def start_in_select(self, t: Token) -> None:
        tag, here = t.data, self.open[-1].tag
        if tag in ("option", "optgroup", "hr"):
            if here == "option":
                self.cut(len(self.open) - 1)
            if tag != "option" and self.open[-1].tag == "optgroup":
                self.cut(len(self.open) - 1)
            self.insert(tag, t.attrs, push=tag != "hr")
        elif tag in ("script", "template"):
            self.start_in_body(t)
        elif tag in ("select", "input", "keygen", "textarea") or tag in TABLE_PARTS | {"table"} and self.counts["table"]:
            self.cut(self.at[-1])
            if tag != "select":
                self.start(t)

    def start_in_body(self, t: Token) -> None:
        tag, attrs = t.data, t.attrs
        if tag in ("head", "frame", "frameset") or tag in TABLE_PARTS:
            return
        if tag in BLOCKS or tag in HEADINGS or tag in ("form", "hr", "plaintext", "xmp", "li", "dd", "dt", "table"):
            if tag == "form" and self.form is not None and not self.templates:
                return
            if tag in ("li", "dd", "dt"):
                self.end_item(("li",) if tag == "li" else ("dd", "dt"))
            if tag != "table" or not self.quirks:
                self.close_p()
            if tag in HEADINGS and self.open[-1].tag in HEADINGS:
                self.cut(len(self.open) - 1)
            if tag == "xmp":
                self.reopen()
            node = self.insert(tag, attrs, push=tag != "hr")
            self.skip_line = tag in ("pre", "listing")
            if tag == "form" and not self.templates:
                self.form = node
            if tag in ("plaintext", "xmp"):
                self.raw = tag
            return
        if tag in HEAD or tag in ("textarea", "iframe", "noembed"):
            node = self.insert(tag, attrs, push=tag not in VOID)
            if tag in RAW:
                self.raw = tag
            elif tag == "template":
                self.formatting.append(None)
                self.templates.append(node)
                self.held.append(node)
            self.skip_line = tag == "textarea"
            return
        if tag == "image":
            tag = "img"
        if tag == "a" and (old := self.known("a")) is not None:
            self.adopt("a")
            self.forget(old)
            if old.open:
                self.lift(old)
        if tag == "button" and (k := self.scoped(("button",))) is not None:
            self.cut(k)
        if tag in ("option", "optgroup") and self.open[-1].tag == "option":
            self.cut(len(self.open) - 1)
        if tag in ("rb", "rtc", "rp", "rt"):
            if self.scoped(("ruby",)) is not None:
                self.implied_ends("rtc" if tag in ("rp", "rt") else "")
        elif tag not in ("param", "source", "track"):
            self.reopen()
            if tag == "nobr" and self.scoped(("nobr",)) is not None:
                self.adopt("nobr")
                self.reopen()
        if tag in ("svg", "math"):
            self.insert(tag, svg_case(attrs) if tag == "svg" else attrs, push=not t.closed, space=tag)
            return
        node = self.insert(tag, attrs, push=tag not in VOID)
        if tag in FORMATTING:
            self.remember(node)
        elif tag in MARKED:
            self.formatting.append(None)

    def end_item(self, tags) -> None:
        """An item ends where the next one begins, unless a block other than address, div and p stands between."""
        if not any(self.counts[t] for t in tags):
            return
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k].tag
            if tag in tags:
                self.cut(k)
                return
            if tag in SPECIAL and tag not in ("address", "div", "p"):
                return

    def end(self, t: Token) -> None:
        tag, inside = t.data, self.inside()
        if tag in ("body", "html"):
            self.closed = inside == "html"
        elif tag == "template":
            if self.counts["template"]:
                self.cut(next(k for k in reversed(self.at) if self.open[k].tag == "template"))
                self.to_marker()
                self.templates.pop()
        elif inside == "select":
            if tag == "select":
                self.cut(self.at[-1])
            elif tag in ("option", "optgroup"):
                if tag == "optgroup" and self.open[-1].tag == "option" and self.open[-2].tag == "optgroup":
                    self.cut(len(self.open) - 1)
                if self.open[-1].tag == tag:
                    self.cut(len(self.open) - 1)
            elif tag in TABLE_PARTS | {"table"} and self.within_select(tag):
                self.cut(self.at[-1])
                self.end(t)
        elif inside == "colgroup":
            if tag != "col":
                self.cut(self.at[-1])
                if tag != "colgroup":
                    self.end(t)
        elif tag in TABLE_PARTS or tag == "table":
            self.end_part(tag)
        elif inside in ROW_PARTS:
            self.fostered(lambda: self.end_in_body(t))
        else:
            self.end_in_body(t)

    def within_select(self, tag: str) -> bool:
        select = self.at.pop()
        found = self.within_table((tag,)) is not None
        self.at.append(select)
        return found

    def end_part(self, tag: str) -> bool:
        """The end of a table or a part of one, with all that is open in it; none if it isn't open in this table."""
        k = None if tag == "col" else self.within_table((tag,))
        if k is None:
            return False
        marked = sum(self.open[j].tag in ("caption", "td", "th") for j in self.at if j >= k)
        self.cut(k)
        for _ in range(marked):
            self.to_marker()
        return True

    def end_in_body(self, t: Token) -> None:
        tag = t.data
        if tag == "p":
            if self.scoped(("p",), ("button",)) is None:
                self.insert("p")
            self.close_p()
        elif tag == "br":
            self.reopen()
            self.insert("br", {}, push=False)
        elif tag == "form" and not self.templates:
            node, self.form = self.form, None
            if node is not None and node.open and self.scoped(("form",)) is not None:
                self.implied_ends()
                self.lift(node)
        elif tag == "li":
            self.close(("li",), ("ol", "ul"))
        elif tag in HEADINGS:
            self.close(HEADINGS)
        elif tag in BLOCKS or tag in ("button", "dd", "dt", "form"):
            self.close((tag,))
        elif tag in MARKED:
            if self.close((tag,)):
                self.to_marker()
        elif tag in FORMATTING:
            self.adopt(tag)
        else:
            self.end_other(tag)

    def end_other(self, tag: str) -> None:
        if not self.counts[tag]:
            return
        for k in range(len(self.open) - 1, 1, -1):
            node = self.open[k]
            if node.tag == tag and not node.space:
                self.cut(k)
                return
            if node.tag in SPECIAL and not node.space:
                return

    def foreign(self, t: Token) -> bool:
        """What belongs to SVG or MathML; an element of HTML that can't stand there ends it."""
        if t.kind == "text":
            self.text(t.data)
            return True
        if t.kind == "start":
            if t.data in BREAKOUT or t.data == "font" and t.attrs.keys() & {"color", "face", "size"}:
                k = len(self.open) - 1
                while self.open[k].space and self.open[k].tag not in INTEGRATION:
                    k -= 1
                self.cut(k + 1)
                return False
            space = self.open[-1].space
            self.insert(t.data, svg_case(t.attrs) if space == "svg" else t.attrs, push=not t.closed, space=space)
            return True
        for k in range(len(self.open) - 1, 0, -1):
            if not self.open[k].space:
                return False
            if self.open[k].tag == t.data:
                self.cut(k)
                return True
        return False


def parse(html: str) -> Node:
    """The document of any markup: html with head and body."""
    builder = Builder()
    for token in tokens(html, builder):
        builder.take(token)
    for node in builder.held:
        node.content, node.children = node.children, []
    return builder.document
