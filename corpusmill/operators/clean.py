"""The passes that take what is no content out of a page's body, in their order.

Each pass walks the tree once. What an element says is a range of the body's whole text, so
that no text is built again for every element around it: the cost is linear in the page,
however deep its markup.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable

from corpusmill.config import COURSE_BLOCKS, COURSE_HREF, COURSE_IMAGES, COURSE_TEXTS, LATE_SELECTORS, THANKS, SiteProfile
from corpusmill.operators.dom import SPACE, Comment, Node, rules

HEADING = re.compile(r"h([1-6])")
SECTION_HEADINGS = frozenset(("h2", "h3", "h4", "h5"))
#: Characters that make a pattern more than the text that it finds.
SPECIAL = re.compile(r"[\\.^$*+?{}\[\]|()]")
SAID = re.compile(f"[^{SPACE}]+")


class Flat:
    """The text of a tree, and of each element in document order where in it its own begins and ends."""

    def __init__(self, root: Node):
        self.nodes: list[Node] = []
        self.begin: dict[Node, int] = {}
        self.end: dict[Node, int] = {}
        parts, at, stack = [], 0, [(root, False)]
        while stack:
            x, left = stack.pop()
            if left:
                self.end[x] = at
            elif isinstance(x, Node):
                if x is not root:
                    self.nodes.append(x)
                self.begin[x] = at
                stack.append((x, True))
                stack += [(c, False) for c in reversed(x.children)]
            elif not isinstance(x, Comment):
                parts.append(x.data)
                at += len(x.data)
        self.text = "".join(parts)
        runs = [m.span() for m in SAID.finditer(self.text)]
        self.run_begin, self.run_end = [a for a, _ in runs], [b for _, b in runs]

    def stripped(self, node: Node) -> tuple[int, int]:
        """The range of a node's text without space at its ends."""
        a, b = self.begin[node], self.end[node]
        k = bisect_right(self.run_end, a)
        a = max(a, self.run_begin[k]) if k < len(self.run_begin) else b
        k = bisect_left(self.run_begin, b) - 1
        b = min(b, self.run_end[k]) if k >= 0 else a
        return (a, b) if a < b else (a, a)


class Finder:
    """Which ranges of a text a pattern is found in: by all its places if it is plain text, else by a search of the range."""

    def __init__(self, text: str, pattern: re.Pattern):
        self.text, self.pattern = text, pattern
        plain = not SPECIAL.search(pattern.pattern)
        found = [m.span(1) for m in re.finditer(f"(?=({pattern.pattern}))", text, pattern.flags & (re.I | re.A))] if plain else None
        self.places = found

    def inside(self, a: int, b: int) -> bool:
        if self.places is None:
            return bool(self.pattern.search(self.text[a:b]))
        k = bisect_left(self.places, (a, 0))
        return k < len(self.places) and self.places[k][1] <= b


def drop(nodes: Iterable[Node]) -> None:
    """Removes nodes from their parents, each parent's children in one pass."""
    gone, parents = set(), {}
    for n in nodes:
        if n.parent is not None:
            gone.add(id(n))
            parents[id(n.parent)] = n.parent
            n.parent = None
    for p in parents.values():
        p.children = [c for c in p.children if id(c) not in gone]


def outermost(nodes: Iterable[Node], flagged: set[int]) -> list[Node]:
    """Of flagged nodes (by id), in document order, those that stand in no other."""
    out, within = [], set()
    for n in nodes:
        if n.parent is not None and id(n.parent) in within:
            within.add(id(n))
        elif id(n) in flagged:
            within.add(id(n))
            out.append(n)
    return out


def drop_selected(body: Node, selectors: tuple[str, ...]) -> None:
    """Each match of a selector with all below it. As matches go whole, one walk does what one selector after another would."""
    hit, gone, stack = rules(selectors).hit, [], [body]
    while stack:
        for c in stack.pop().children:
            if isinstance(c, Node):
                if hit(c):
                    gone.append(c)
                elif c.children:
                    stack.append(c)
    drop(gone)


def drop_heading_sections(body: Node, patterns: list[re.Pattern]) -> None:
    """Headings h2 to h5 that match, with the sibling elements up to one of their level or above."""
    found = [h for h in body.elements() if h.tag in SECTION_HEADINGS and any(p.search(h.text().strip(SPACE)) for p in patterns)]
    if not found:
        return
    flagged, gone = {id(h) for h in found}, []
    for parent in {id(h.parent): h.parent for h in found}.values():
        level = 0  # of the heading whose section goes
        for c in parent.children:
            if isinstance(c, Node):
                m = HEADING.fullmatch(c.tag)
                if m and int(m[1]) <= level:
                    level = 0
                if not level and id(c) in flagged:
                    level = int(c.tag[1])
                if level:
                    gone.append(c)
    drop(gone)


def drop_noise(body: Node, patterns: list[re.Pattern], wrappers: bool = True) -> None:
    """div, p and section elements whose text matches; with wrappers, the outermost goes with all below it, else those that hold no other match."""
    text = body.text()
    if all(not SPECIAL.search(p.pattern) and not p.search(text) for p in patterns):
        return
    flat = Flat(body)
    finders = [Finder(flat.text, p) for p in patterns]
    found = [n for n in flat.nodes if n.tag in ("div", "p", "section") and any(f.inside(*flat.stripped(n)) for f in finders)]
    if wrappers:
        drop(outermost(flat.nodes, {id(n) for n in found}))
        return
    flagged, holders = {id(n) for n in found}, set()
    for n in found:
        p = n.parent
        while p is not None and id(p) not in holders:
            holders.add(id(p))
            p = p.parent
    drop(n for n in found if id(n) in flagged and id(n) not in holders)


def drop_course_blocks(body: Node) -> None:
    """For each link to a course, the nearest block above it that speaks of one; without such a block, nothing."""
    text = body.text()
    if not any(t in text for t in COURSE_BLOCKS):
        return
    flat = Flat(body)
    places = sorted((m.start(), m.start() + len(t)) for t in COURSE_BLOCKS for m in re.finditer(f"(?={re.escape(t)})", flat.text))
    begins = [a for a, _ in places]
    following = list(range(len(places) + 1))  # the place itself, or one behind it if it went with a block

    def alive(k: int) -> int:
        while following[k] != k:
            following[k] = following[following[k]]
            k = following[k]
        return k

    def spoken(a: int, b: int) -> Iterable[int]:
        """The places inside a range that are still there."""
        k = alive(bisect_left(begins, a))
        while k < len(places) and begins[k] < b:
            if places[k][1] <= b:
                yield k
            k = alive(k + 1)

    gone: list[Node] = []
    above: dict[int, Node | None] = {}  # of blocks that say nothing of a course, and never will: where to go on

    def next_up(block: Node | None) -> Node | None:
        passed = []
        while block is not None and id(block) in above:
            passed.append(id(block))
            block = above[id(block)]
        above.update(dict.fromkeys(passed, block))
        return block

    for link in (n for n in flat.nodes if n.tag == "a"):
        text = flat.text[flat.begin[link] : flat.end[link]]
        if COURSE_HREF not in link.attrs.get("href", "") and not any(t in text for t in COURSE_TEXTS):
            continue
        block = next_up(link.parent)
        while block is not None and block is not body:
            heard = list(spoken(flat.begin[block], flat.end[block]))
            if heard:
                gone.append(block)
                above[id(block)] = None  # what is in it has nothing around it any more
                for k in heard:
                    following[k] = k + 1
                break
            above[id(block)] = block.parent
            block = next_up(block)
    drop(gone)


def drop_exact_text(body: Node, text: str) -> None:
    if text not in body.text():
        return
    flat, found = Flat(body), set()
    for n in flat.nodes:
        a, b = flat.stripped(n)
        if b - a == len(text) and flat.text.startswith(text, a):
            found.add(id(n))
    drop(outermost(flat.nodes, found))


def clean(body: Node, profile: SiteProfile, selectors: tuple[str, ...] | None = None) -> None:
    drop_selected(body, (*(profile.exclude_selectors if selectors is None else selectors), *profile.exclude_elements))
    drop_heading_sections(body, profile.headings())
    drop_noise(body, profile.noises(), profile.noise_takes_wrappers)
    drop_course_blocks(body)
    drop_exact_text(body, THANKS)
    drop_selected(body, (COURSE_IMAGES, *LATE_SELECTORS))  # images say nothing, so they may go with the last
