"""Labelled pages of many templates, and the fit of the block classifier on them.

Pages are drawn from a seed: their layout (semantic elements, named or bare div, tables),
what stands around the article, and what the article has in it. Words of content begin with
c and words of boilerplate with b, so that each block tells its own label; the classifier
does not see words. fit() is a logistic regression on FIT_PAGES pages, a bounded number, and
the scale of smoothness is the one with the fewest wrong labels on TUNE_PAGES other pages.
A test fits again and compares with the constants in html_extract.
"""

from __future__ import annotations

import random
from collections.abc import Callable

import numpy as np

from corpusmill.llm.html_extract import FEATURES, blocks, features, labels

FIT_PAGES, TUNE_PAGES = 1500, 500
SCALES = (0.0, 0.5, 1.0, 1.5, 2.0)
PENALTY = 1.0
#: Names that tell the classifier nothing: of content, with words of boilerplate among others, and of boilerplate.
PLAIN_NAMES = ("market-share", "legal-history", "form-theory", "tags-explained", "key-facts", "figure-note", "reply-to-critics", "reviews", "step-3")
OTHER_NAMES = ("gnav", "hdr", "rail", "dfp", "slot-2", "xq", "blk", "zone-7", "outbrain", "u-bottom")

CONTENT_NAMES = ("content", "post-body", "entry-content", "article-body", "story", "main-text", "prose")
BOILER_NAMES = {
    "nav": ("nav", "menu", "navbar", "topbar"), "side": ("sidebar", "widget", "aside-box"), "foot": ("footer", "site-footer", "copyright"), "ad": ("ad", "advert", "promo", "sponsored"),
    "notice": ("cookie-notice", "alert", "notice"), "comments": ("comments", "comment-list", "disqus"), "related": ("related", "recommended", "teaser"), "share": ("share", "social"),
}


class Page:
    """One drawn page."""

    def __init__(self, seed: int):
        self.pick = random.Random(seed)
        self.style = self.pick.choice(("semantic", "semantic", "main", "named", "named", "bare", "table", "text", "form"))

    def words(self, kind: str, low: int, high: int, end: str = ".") -> str:
        n = self.pick.randint(low, high)
        return " ".join(kind + "xyzvw"[self.pick.randrange(5)] * self.pick.randint(1, 8) for _ in range(n)) + (end if self.pick.random() < 0.85 else "")

    def links(self, kind: str, n: int, tag: str = "li") -> str:
        return "".join(f"<{tag}><a href='/{k}'>{self.words(kind, 1, 6, '')}</a></{tag}>" for k in range(n))

    def paragraph(self, kind: str, long: bool = True) -> str:
        text = self.words(kind, 12, 70) if long else self.words(kind, 2, 9)
        if self.pick.random() < 0.3:
            text += f" <a href=x>{self.words(kind, 1, 4, '')}</a> {self.words(kind, 1, 12)}"
        return f"<p>{text}{self.pick.choice(('</p>', '</p>', ''))}"

    def part(self, role: str, inner: str, tag: str | None = None) -> str:
        """A piece of boilerplate: an element of its kind, a named one, or a bare one."""
        how = self.pick.random()
        if self.style in ("semantic", "main") and tag and how < 0.8:
            return f"<{tag}>{inner}</{tag}>"
        if self.style in ("bare", "table", "text") and how < 0.6:
            return f"<div>{inner}</div>"
        if how > 0.9:
            return f'<div class="{self.pick.choice(OTHER_NAMES)}">{inner}</div>'
        return f'<div class="{self.pick.choice(BOILER_NAMES[role])}">{inner}</div>'

    def article(self) -> str:
        out = [f"<h1>{self.words('c', 2, 10, '')}</h1>"]
        for _ in range(self.pick.randint(2, 9)):
            what = self.pick.random()
            if what < 0.5:
                out.append(self.paragraph("c", self.pick.random() < 0.75))
            elif what < 0.55:
                out.append(self.paragraph("c").replace("<p>", f'<p class="{self.pick.choice(PLAIN_NAMES)}">', 1))
            elif what < 0.62:
                out.append(f"<h2>{self.words('c', 1, 8, '')}</h2>")
            elif what < 0.65:
                out.append(f"<h2><a href=h>{self.words('c', 1, 8, '')}</a></h2>")
            elif what < 0.68:
                out.append(f"<ul>{self.links('c', self.pick.randint(1, 5))}</ul>")
            elif what < 0.75:
                out.append("<ul>" + "".join(f"<li>{self.words('c', 1, 14)}" for _ in range(self.pick.randint(2, 6))) + "</ul>")
            elif what < 0.8:
                out.append(f"<table><tr><td>{self.words('c', 1, 3, '')}<td>{self.words('c', 1, 3, '')}</table>")
            elif what < 0.85:
                out.append(f"<blockquote>{self.words('c', 6, 30)}</blockquote>")
            elif what < 0.9:
                out.append(f"<div>{self.words('c', 2, 40)}</div>")
            else:
                role = self.pick.choice(("ad", "share", "notice", "related", "comments"))
                inner = self.paragraph("b", self.pick.random() < 0.6)
                name = self.pick.choice(BOILER_NAMES[role])
                out.append(self.pick.choice((f"<aside>{inner}</aside>", f'<p class="{name}">{inner[3:]}', f'<div class="{name}">{inner}</div>', f'<div class="{name}">{inner}</div>')))
        body = "".join(out)
        if self.style in ("semantic", "main") and self.pick.random() < 0.5:
            body = f'<div class="{self.pick.choice(CONTENT_NAMES)}">{body}</div>'
        if self.style == "semantic":
            body = f'<article{self.pick.choice(("", " class=post", " class=story"))}>{body}</article>'
            return f"<main>{body}</main>" if self.pick.random() < 0.5 else body
        if self.style == "text":
            return "".join(self.words("c", 3, 60) + self.pick.choice(("<br><br>", "<hr>", "<p>" if k else "<hr>")) for k in range(self.pick.randint(1, 6)))
        if self.style == "form":
            return f'<div class="{self.pick.choice(CONTENT_NAMES)}">{body}</div>'
        if self.style == "main":
            return f"<main><div>{body}</div></main>"
        if self.style == "named":
            return f'<div class="{self.pick.choice(CONTENT_NAMES)}">{body}</div>'
        return f"<td>{body}</td>" if self.style == "table" else f"<div>{body}</div>"

    def html(self) -> str:
        pick = self.pick
        top = self.part("nav", f"<ul>{self.links('b', pick.randint(3, 12))}</ul>", "nav")
        if pick.random() < 0.5:
            top = self.part("nav", f"<a href='/'>{self.words('b', 1, 4, '')}</a>", "header") + top
        if pick.random() < 0.4:
            top += self.part("notice", self.paragraph("b", pick.random() < 0.5))
        if pick.random() < 0.5:
            top += self.part("ad", self.paragraph("b", pick.random() < 0.5))
        low = ""
        if pick.random() < 0.4:
            low += self.part("related", "".join(f"<p><a href=r>{self.words('b', 3, 25)}</a></p>" for _ in range(pick.randint(2, 6))), "aside")
        if pick.random() < 0.4:
            low += self.part("side", f"<h3>{self.words('b', 1, 4, '')}</h3>{self.paragraph('b', pick.random() < 0.6)}", "aside")
        if pick.random() < 0.4:
            low += f'<div class="{pick.choice(BOILER_NAMES["comments"])}">' + "".join(self.paragraph("b") for _ in range(pick.randint(1, 6))) + "</div>"
        low += self.part("foot", self.words("b", 2, 25), "footer")
        middle = self.article()
        if self.style == "table":
            return f"<html><body><table><tr><td>{top}</td></tr><tr>{middle}</tr><tr><td>{low}</td></tr></table></body></html>"
        wrap = ("<form id=f>", "</form>") if self.style == "form" else ("", "")
        return f"<html><head><title>t</title></head><body>{wrap[0]}{top}{middle}{low}{wrap[1]}</body></html>"


def labelled(seeds: range) -> list[tuple[list, list[bool]]]:
    """The blocks of each page, and whether each is content."""
    out = []
    for seed in seeds:
        found = blocks(Page(seed).html())
        out.append((found, [b.text[0] == "c" for b in found]))
    return out


def fit(pages: int = FIT_PAGES, penalty: float = PENALTY) -> tuple[float, ...]:
    """Weights of FEATURES by Newton steps of a penalised logistic regression."""
    rows = labelled(range(pages))
    x = np.array([features(b) for found, _ in rows for b in found], float)
    y = np.array([k for _, said in rows for k in said], float)
    w, ridge = np.zeros(len(FEATURES)), penalty * np.eye(len(FEATURES))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if abs(step).max() < 1e-9:
            break
    return tuple(round(float(v), 2) for v in w)


def wrong_labels(rows: list, weights: tuple[float, ...], scale: float, label: Callable = labels) -> tuple[int, int, int]:
    """(blocks, labels that are wrong, labels that the cut has changed from the sign of the score)."""
    n = wrong = changed = 0
    for found, said in rows:
        scores = [sum(w * v for w, v in zip(weights, features(b), strict=True)) for b in found]
        got = label(found, scores, scale)
        n += len(found)
        wrong += sum(a != b for a, b in zip(got, said, strict=True))
        changed += sum(a != (s > 0) for a, s in zip(got, scores, strict=True))
    return n, wrong, changed


def tuned(weights: tuple[float, ...], pages: int = TUNE_PAGES) -> float:
    """The scale of smoothness with the fewest wrong labels; the smaller one of equals."""
    rows = labelled(range(FIT_PAGES, FIT_PAGES + pages))
    return min(SCALES, key=lambda s: (wrong_labels(rows, weights, s)[1], s))
