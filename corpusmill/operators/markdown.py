"""Markdown of a document tree, by rules of our own.

ATX headings, fenced code, `*` bullets, `**` strong and `_` emphasis, inline links and
images, `* * *` rules, two spaces and a line feed for br. Characters that would be marks
are escaped. Tables have no form of their own: their cells stay as text.
"""

from __future__ import annotations

import re

from corpusmill.operators.dom import Comment, Node, Text

BLANKS = re.compile(r"[ \t\r\n]+")
BLOCKS = frozenset(
    "address article aside audio blockquote body canvas center dd dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html isindex li main menu nav noframes noscript ol output p pre section table tbody td tfoot th thead tr ul video".split()
)
SILENT = frozenset(("script", "style", "noscript", "head", "template"))
ESCAPES = (
    (re.compile(r"\\"), r"\\\\"),
    (re.compile(r"\*"), r"\\*"),
    (re.compile(r"^-", re.M), r"\\-"),
    (re.compile(r"^\+ ", re.M), r"\\+ "),
    (re.compile(r"^(=+)", re.M), r"\\\1"),
    (re.compile(r"^(#{1,6}) ", re.M), r"\\\1 "),
    (re.compile(r"`"), r"\\`"),
    (re.compile(r"^~~~", re.M), r"\\~~~"),
    (re.compile(r"\["), r"\\["),
    (re.compile(r"\]"), r"\\]"),
    (re.compile(r"^>", re.M), r"\\>"),
    (re.compile(r"_"), r"\\_"),
    (re.compile(r"^(\d+)\. ", re.M), r"\1\\. "),
)


#: What some pattern above may begin with; most texts have none of it.
MARKS = re.compile(r"[\\*`\[\]_]|^(?:[-=>#]|\+ |~~~|\d+\. )", re.M)


def escaped(text: str) -> str:
    if not MARKS.search(text):
        return text
    for pattern, by in ESCAPES:
        text = pattern.sub(by, text)
    return text


def _joined(parts: list[tuple[str, bool]]) -> str:
    """Blocks two line feeds apart, inline parts as they come, with single spaces between."""
    out = ""
    for text, block in parts:
        if block:
            text = text.strip("\n")
            if not text.strip():
                continue
            out = (out.rstrip() + "\n\n" if out.strip() else "") + text + "\n\n"
        else:
            if not out or out.endswith("\n") or out.endswith(" ") and not out.endswith("  \n"):
                text = text.lstrip(" ")
            out += text
    return out.strip("\n")


def _flank(text: str, mark: str) -> str:
    inner = text.strip(" ")
    if not inner:
        return text
    left, right = text[: len(text) - len(text.lstrip(" "))], text[len(text.rstrip(" ")) :]
    return f"{left}{mark}{inner}{mark}{right}"


def _fence(code: str) -> str:
    longest = max((len(m) for m in re.findall(r"^`{3,}", code, re.M)), default=2)
    return "`" * max(3, longest + 1)


def _inline_code(text: str) -> str:
    text = re.sub(r"\r?\n|\r", " ", text)
    if not text:
        return ""
    mark = "`"
    while mark in re.findall("`+", text):
        mark += "`"
    pad = " " if text.startswith("`") or text.endswith("`") or re.fullmatch(r" .*?[^ ].* ", text) else ""
    return f"{mark}{pad}{text}{pad}{mark}"


def _render(node: Node, depth: int = 0) -> list[tuple[str, bool]]:
    parts: list[tuple[str, bool]] = []
    for child in node.children:
        if isinstance(child, Comment):
            continue
        if isinstance(child, Text):
            text = BLANKS.sub(" ", child.data)
            if text:
                parts.append((escaped(text), False))
            continue
        parts += _element(child, depth)
    return parts


def _element(node: Node, depth: int) -> list[tuple[str, bool]]:
    tag = node.tag
    if tag in SILENT:
        return []
    if depth > 400:  # deeper markup is text alone
        return [(escaped(" ".join(node.text().split())), False)]
    if tag == "br":
        return [("  \n", False)]
    if tag == "hr":
        return [("* * *", True)]
    if tag == "img":
        src, alt, title = (node.attrs.get(k, "") for k in ("src", "alt", "title"))
        return [(f"![{escaped(alt)}]({src}" + (f' "{title}"' if title else "") + ")", False)] if src else []
    if tag == "pre":
        code = next((c for c in node.children if isinstance(c, Node)), None)
        language = re.search(r"language-(\S+)", code.attrs.get("class", "")) if code is not None and code.tag == "code" else None
        text = node.text().removesuffix("\n")
        fence = _fence(text)
        return [(f"{fence}{language[1] if language else ''}\n{text}\n{fence}", True)]
    if tag == "code":
        return [(_inline_code(node.text()), False)]
    if re.fullmatch("h[1-6]", tag):
        text = " ".join(_joined(_render(node, depth + 1)).split())
        return [("#" * int(tag[1]) + " " + text, True)] if text else []
    if tag == "blockquote":
        text = _joined(_render(node, depth + 1))
        return [("\n".join(("> " + line).rstrip() for line in text.split("\n")), True)] if text.strip() else []
    if tag in ("ul", "ol"):
        return [(_list(node, depth), True)]
    inner = _render(node, depth + 1)
    if tag in BLOCKS:
        return [(_joined(inner), True)]
    if any(block for _, block in inner):
        return inner
    text = "".join(t for t, _ in inner)
    if tag in ("strong", "b"):
        return [(_flank(text, "**"), False)]
    if tag in ("em", "i"):
        return [(_flank(text, "_"), False)]
    if tag == "a" and node.attrs.get("href"):
        href = node.attrs["href"].replace("(", r"\(").replace(")", r"\)")
        title = node.attrs.get("title", "").replace('"', r"\"")
        return [(f"[{text}]({href}" + (f' "{title}"' if title else "") + ")", False)]
    return [(text, False)]


def _list(node: Node, depth: int) -> str:
    items, number = [], int(node.attrs.get("start", "1")) if re.fullmatch(r"-?\d+", node.attrs.get("start", "1")) else 1
    for child in node.children:
        if isinstance(child, Node):
            if child.tag in ("ul", "ol"):
                text = _list(child, depth + 1)
            else:
                text = _joined(_render(child, depth + 1)) if child.tag == "li" else _joined(_element(child, depth + 1))
            mark = "*   " if node.tag == "ul" else f"{number}.  "
            number += 1
            items.append(mark + text.strip().replace("\n\n", "\n" if depth > 50 else "\n\n").replace("\n", "\n    "))
    return "\n".join(items)


def markdown(node: Node) -> str:
    return _joined(_render(node)).strip("\t\r\n ")
