"""A document tree from markup, simple selectors, and markup from the tree again."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import escape

VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW_TEXT = frozenset("iframe noembed noframes noscript plaintext script style xmp".split())
# Names of SVG that have capitals.
SVG_TAGS = {x.lower(): x for x in "altGlyph altGlyphDef altGlyphItem animateColor animateMotion animateTransform clipPath feBlend feColorMatrix feComponentTransfer feComposite feConvolveMatrix feDiffuseLighting feDisplacementMap feDistantLight feDropShadow feFlood feFuncA feFuncB feFuncG feFuncR feGaussianBlur feImage feMerge feMergeNode feMorphology feOffset fePointLight feSpecularLighting feSpotLight feTile feTurbulence foreignObject glyphRef linearGradient radialGradient textPath".split()}
SVG_ATTRIBUTES = {x.lower(): x for x in "attributeName attributeType baseFrequency baseProfile calcMode clipPathUnits diffuseConstant edgeMode filterUnits glyphRef gradientTransform gradientUnits kernelMatrix kernelUnitLength keyPoints keySplines keyTimes lengthAdjust limitingConeAngle markerHeight markerUnits markerWidth maskContentUnits maskUnits numOctaves pathLength patternContentUnits patternTransform patternUnits pointsAtX pointsAtY pointsAtZ preserveAlpha preserveAspectRatio primitiveUnits refX refY repeatCount repeatDur requiredExtensions requiredFeatures specularConstant specularExponent spreadMethod startOffset stdDeviation stitchTiles surfaceScale systemLanguage tableValues targetX targetY textLength viewBox viewTarget xChannelSelector yChannelSelector zoomAndPan".split()}
SPACE = "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


class Text:
    """A piece of text, which may grow piece by piece."""

    __slots__ = ("_parts", "parent")

    def __init__(self, data: str):
        self._parts, self.parent = [data], None

    @property
    def data(self) -> str:
        if len(self._parts) > 1:
            self._parts = ["".join(self._parts)]
        return self._parts[0]

    def extend(self, data: str) -> None:
        self._parts.append(data)


class Comment(Text):
    __slots__ = ()


class Node:
    """An element. space: svg or math for those, else empty. content: what a template holds, which is no part of the document."""

    __slots__ = ("attrs", "children", "content", "open", "parent", "space", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, space: str = ""):
        self.tag, self.attrs, self.children, self.parent, self.space, self.open, self.content = tag, attrs or {}, [], None, space, False, None

    def append(self, child) -> None:
        child.parent = self
        self.children.append(child)

    def index(self, child) -> int:
        """The place of a child; one of the last is found at once."""
        return next(k for k in range(len(self.children) - 1, -1, -1) if self.children[k] is child)

    def put(self, child, before=None) -> None:
        """Adds a child before another one, or at the end."""
        child.parent = self
        self.children.insert(len(self.children) if before is None else self.index(before), child)

    def elements(self) -> Iterator[Node]:
        """Descendants in document order, as the tree is now."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self) -> str:
        """What the platform calls textContent: all text below, comments not."""
        out, stack = [], list(reversed(self.children))
        while stack:
            x = stack.pop()
            if isinstance(x, Node):
                stack += reversed(x.children)
            elif not isinstance(x, Comment):
                out.append(x.data)
        return "".join(out)

    def remove(self) -> None:
        if self.parent is not None:
            del self.parent.children[self.parent.index(self)]
            self.parent = None

    def select(self, selector: str) -> list[Node]:
        tests = parse_selector(selector)
        return [n for n in self.elements() if any(matches(n, t) for t in tests)]

    def first(self, selector: str) -> Node | None:
        tests = parse_selector(selector)
        return next((n for n in self.elements() if any(matches(n, t) for t in tests)), None)


_SIMPLE = re.compile(r"""([A-Za-z][A-Za-z0-9]*|\*)|\.([\w-]+)|#([\w-]+)|\[\s*([\w-]+)\s*(?:([*^$~|]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+))\s*)?\]""")


@lru_cache(1024)
def parse_selector(selector: str) -> tuple[tuple[tuple[str, str, str, str], ...], ...]:
    """Comma lists of tag, .class, #id and attribute tests on one element."""
    out = []
    for part in re.split(r",(?![^\[]*\])", selector):
        at, tests, part = 0, [], part.strip()
        while at < len(part):
            m = _SIMPLE.match(part, at)
            if not m:
                raise ValueError(f"selector {selector!r}: only tests of one element are known")
            if m[1]:
                tests.append(("tag", m[1].lower(), "", ""))
            elif m[2]:
                tests.append(("class", m[2], "", ""))
            elif m[3]:
                tests.append(("attr", "id", "=", m[3]))
            else:
                tests.append(("attr", m[4].lower(), m[5] or "", m[6] or m[7] or m[8] or ""))
            at = m.end()
        if not tests:
            raise ValueError(f"selector {selector!r} is empty")
        out.append(tuple(tests))
    return tuple(out)


def matches(node: Node, tests: tuple[tuple[str, str, str, str], ...]) -> bool:
    for kind, name, how, value in tests:
        if kind == "tag":
            if name not in ("*", node.tag):
                return False
        elif kind == "class":
            if name not in node.attrs.get("class", "").split():
                return False
        else:
            got = node.attrs.get(name)
            if got is None or how == "=" and got != value or how == "*=" and (not value or value not in got) or how == "^=" and (not value or not got.startswith(value)) or how == "$=" and (not value or not got.endswith(value)) or how == "~=" and value not in got.split() or how == "|=" and got != value and not got.startswith(value + "-"):
                return False
    return True


class Rules:
    """Many selectors at once: what an element has is looked up, by tag, class and attribute, and all [x*=] of an attribute are one pattern."""

    def __init__(self, selectors: tuple[str, ...]):
        self.tags, self.classes, self.equal, self.begins, self.tagged, self.rest = set(), set(), {}, {}, {}, []
        parts: dict[str, list[str]] = {}
        for tests in (t for s in selectors for t in parse_selector(s)):
            kind, name, how, value = tests[0]
            if len(tests) > 1:
                (self.tagged.setdefault(name, []) if kind == "tag" and name != "*" else self.rest).append(tests)
            elif kind == "tag" and name != "*":
                self.tags.add(name)
            elif kind == "class":
                self.classes.add(name)
            elif how == "=":
                self.equal.setdefault(name, set()).add(value)
            elif how == "^=" and value:
                self.begins[name] = (*self.begins.get(name, ()), value)
            elif how == "*=" and value:
                parts.setdefault(name, []).append(re.escape(value))
            else:
                self.rest.append(tests)
        self.holds = {name: re.compile("|".join(values)) for name, values in parts.items()}

    def hit(self, node: Node) -> bool:
        if node.tag in self.tags:
            return True
        if node.attrs:
            for name, value in node.attrs.items():
                if name == "class" and self.classes and not self.classes.isdisjoint(value.split()):
                    return True
                if name in self.holds and self.holds[name].search(value) or name in self.equal and value in self.equal[name] or name in self.begins and value.startswith(self.begins[name]):
                    return True
        tests = self.tagged.get(node.tag)
        return bool(tests and any(matches(node, t) for t in tests) or self.rest and any(matches(node, t) for t in self.rest))


rules = lru_cache(64)(Rules)


def inner_html(node: Node) -> str:
    """The markup of what stands below node, comments kept."""
    out: list[str] = []
    stack: list = list(reversed(node.children))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif isinstance(x, Comment):
            out.append(f"<!--{x.data}-->")
        elif isinstance(x, Text):
            raw = x.parent is not None and x.parent.tag in RAW_TEXT
            out.append(x.data if raw else escape(x.data, quote=False).replace("\u00a0", "&nbsp;"))
        else:
            attrs = "".join(f' {k}="{v.replace("&", "&amp;").replace(chr(34), "&quot;").replace(chr(160), "&nbsp;")}"' for k, v in x.attrs.items())
            tag = SVG_TAGS.get(x.tag, x.tag) if x.space == "svg" else x.tag
            out.append(f"<{tag}{attrs}>")
            if x.tag not in VOID or x.space:
                stack.append(f"</{tag}>")
                stack += reversed(x.content or x.children)
    return "".join(out)
