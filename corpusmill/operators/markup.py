"""Markup as tags, text and comments: each character is read a bounded number of times."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from html.entities import html5
from typing import NamedTuple

BREAK = r"\t\n\f\r "
_MARK = re.compile(r"<(/?[A-Za-z]|[/!?])")
_NAME = re.compile(rf"[^{BREAK}/>]+")
_SKIP = re.compile(rf"[{BREAK}/]*")
_KEY = re.compile(rf"=?[^{BREAK}/>=]*")
_EQUALS = re.compile(rf"[{BREAK}]*=[{BREAK}]*")
_BARE = re.compile(rf"[^{BREAK}>]+")
_COMMENT_END = re.compile(r"--!?>")
_REFERENCE = re.compile(r"&(?:#[xX]?[0-9A-Fa-f]+;?|([A-Za-z][A-Za-z0-9]*)([;=]?))")
_SCRIPT = re.compile(rf"<!--|-->|<(/?)script(?=[{BREAK}/>])", re.I)


class Token(NamedTuple):
    """kind is start, end, text, comment or doctype; closed tells of a start tag that ends with a slash."""

    kind: str
    data: str
    attrs: dict[str, str] | None = None
    closed: bool = False


class Mode:
    """What the reader of tokens tells their source: the element whose raw content follows, and whether CDATA is text here."""

    raw: str | None = None
    cdata = False


def _reference(m: re.Match) -> str:
    name, end = m[1], m[2]
    if name is None:
        return unescape(m[0])
    if end == ";":
        return html5.get(name + ";", m[0])
    return m[0] if end else html5.get(name, m[0])


def attribute_text(value: str) -> str:
    """Character references of an attribute: one without a semicolon is none if = or a letter follows, as in a query string."""
    return _REFERENCE.sub(_reference, value) if "&" in value else value


def _attributes(html: str, at: int) -> tuple[dict[str, str], bool, int] | None:
    """The attributes from a tag's name on, whether it ends with a slash, and where it ends; None if it doesn't."""
    found: dict[str, str] = {}
    while True:
        m = _SKIP.match(html, at)
        at = m.end()
        if at >= len(html):
            return None
        if html[at] == ">":
            return found, m[0].endswith("/"), at + 1
        m = _KEY.match(html, at)
        key, at, value = m[0].lower(), m.end(), ""
        if m := _EQUALS.match(html, at):
            at = m.end()
            quote = html[at : at + 1]
            if quote in ('"', "'"):
                end = html.find(quote, at + 1)
                if end < 0:
                    return None
                value, at = html[at + 1 : end], end + 1
            elif m := _BARE.match(html, at):
                value, at = m[0], m.end()
        found.setdefault(key, attribute_text(value))


@lru_cache(64)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[{BREAK}/>])", re.I)


def _raw_until(html: str, at: int, tag: str) -> int:
    """Where raw content ends. A script's own comments may hold a script and its end."""
    if tag != "script":
        m = _raw_end(tag).search(html, at)
        return m.start() if m else len(html)
    depth = 0  # 1 in a comment, 2 in a script there
    for m in _SCRIPT.finditer(html, at):
        if m[0] == "<!--":
            depth = max(depth, 1)
        elif m[0] == "-->":
            depth = 0
        elif not m[1]:
            depth = 2 if depth else 0
        elif depth == 2:
            depth = 1
        else:
            return m.start()
    return len(html)


def tokens(html: str, mode: Mode) -> Iterator[Token]:
    """A tag that the end cuts off is dropped. mode.raw is asked after each start tag, and is None again after its content."""
    html = html.replace("\r\n", "\n").replace("\r", "\n").replace("\0", "")
    at, n = 0, len(html)
    while at < n:
        if mode.raw is not None:
            tag, mode.raw = mode.raw, None
            end = n if tag == "plaintext" else _raw_until(html, at, tag)
            if end > at:
                data = html[at:end]
                yield Token("text", unescape(data) if tag in ("title", "textarea") else data)
            at = end
            continue
        m = _MARK.search(html, at)
        start = m.start() if m else n
        if start > at:
            yield Token("text", unescape(html[at:start]) if "&" in html[at:start] else html[at:start])
        at = start
        if at >= n:
            return
        kind = html[at + 1] if not m[1][-1].isalpha() else ""
        if kind == "!" and html.startswith("<!--", at):
            short = next((s for s in ("<!-->", "<!--->") if html.startswith(s, at)), None)
            m = None if short else _COMMENT_END.search(html, at + 4)
            yield Token("comment", "" if short else html[at + 4 : m.start() if m else n])
            at = at + len(short) if short else m.end() if m else n
        elif kind == "!" and mode.cdata and html.startswith("<![CDATA[", at):
            end = html.find("]]>", at)
            yield Token("text", html[at + 9 : end if end >= 0 else n])
            at = end + 3 if end >= 0 else n
        elif kind:
            if at + 2 >= n and kind == "/":
                yield Token("text", "</")
                return
            end = html.find(">", at + 1)
            end = n if end < 0 else end
            said = html[at + (1 if kind == "?" else 2) : end]
            if kind == "!" and said[:7].lower() == "doctype":
                yield Token("doctype", said[7:].strip())
            elif said or kind != "/":
                yield Token("comment", said)
            at = end + 1
        else:
            ends = len(m[1]) > 1
            name = _NAME.match(html, at + 1 + ends)
            rest = _attributes(html, name.end())
            if rest is None:
                return
            attrs, closed, at = rest
            yield Token("end", name[0].lower()) if ends else Token("start", name[0].lower(), attrs, closed)
