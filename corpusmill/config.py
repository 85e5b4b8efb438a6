"""What a site looks like, and how a crawl runs."""

from __future__ import annotations

import argparse
import datetime as dt
import re
from dataclasses import dataclass, field

#: The elements that are no content, by selector, in the order in which they go.
EXCLUDE_SELECTORS = (
    "nav", "header", "footer", ".navbar", ".sidebar", "#kendonav", "#navContainer", "#sfVersionSelector", ".breadcrumb", ".k-treeview", '[data-role="treeview"]',
    ".promo", ".cta", ".call-to-action", '[class*="promo"]', '[class*="banner"]',
    ".feedback", ".rating", ".article-feedback", '[class*="feedback"]', '[class*="rating"]', '[class*="helpful"]',
    ".training", ".courses", ".learn-more", '[class*="training"]', '[class*="course"]',
    ".cookie", ".consent", '[class*="cookie"]', '[class*="consent"]', '[class*="privacy"]',
    'img[src*="bat.bing.com"]', 'img[src*="analytics"]', 'img[src*="adsct"]', 'img[src*="tracking"]',
    ".social", ".share", '[class*="social"]', '[class*="share"]',
    ".related", ".next-article", '[class*="related"]', '[class*="next"]',
)
#: Elements without text of the page.
EXCLUDE_ELEMENTS = ("script", "style", "noscript", "iframe")
#: Headings whose section goes ({product} is the profile's), and texts whose block goes.
HEADING_PATTERNS = (r"^NEW TO {product}\?", r"^Want to learn more\?", r"^Was this article helpful\?", r"^Would you like to submit additional feedback\?", r"^Next article$")
NOISE_PATTERNS = ("We use cookies to personalize content", "Cookie Settings", "Cookies Settings Accept Cookies")
#: What marks links to courses, and the blocks around them.
COURSE_HREF, COURSE_TEXTS, COURSE_BLOCKS = "/services/education/", ("free lesson", "free on-demand video course"), ("This free lesson", "free on-demand video course")
THANKS = "Thank you for your feedback!"
BREADCRUMB, BREADCRUMB_ITEMS = '.sf-breadcrumb, nav[aria-label*="breadcrumb"]', 'a, span[aria-current="page"]'
LATE_SELECTORS = ('[onclick*="__doPostBack"]', 'a[href^="javascript:"]')
COURSE_IMAGES = 'img[src*="course_book"]'


@dataclass(frozen=True)
class SiteProfile:
    """Everything that is particular to a site. path_prefix has no slash at its end."""

    base_url: str = "https://docs.example.com/documentation/product"
    path_prefix: str = "/documentation/product"
    product: str = "the product"
    corpus_title: str = "Documentation"
    exclude_selectors: tuple[str, ...] = EXCLUDE_SELECTORS
    exclude_elements: tuple[str, ...] = EXCLUDE_ELEMENTS
    heading_patterns: tuple[str, ...] = HEADING_PATTERNS
    noise_patterns: tuple[str, ...] = NOISE_PATTERNS
    #: A noise text may match a wrapper of the whole page first, and take it along. False looks at the innermost block.
    noise_takes_wrappers: bool = True

    def headings(self) -> list[re.Pattern]:
        return [re.compile(p.replace("{product}", re.escape(self.product)), re.I) for p in self.heading_patterns]

    def noises(self) -> list[re.Pattern]:
        return [re.compile(p, re.I) for p in self.noise_patterns]


#: A profile that takes the links of any site.
ANY_SITE = SiteProfile(base_url="http", path_prefix="")


@dataclass(frozen=True)
class CrawlOptions:
    """Options of a run. max_pages None is without limit; an empty output_dir is the default one."""

    output_dir: str = "./output"
    max_pages: int | None = 100
    stale_seconds: float = 86_400
    now: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc))

    def __post_init__(self):
        if not self.output_dir:
            object.__setattr__(self, "output_dir", "./output")

    @property
    def progress_dir(self) -> str:
        return f"{self.output_dir.rstrip('/')}/progress"


def parse_arguments(argv: list[str]) -> CrawlOptions:
    """[max_pages] [stale_seconds]: leading digits count, `Infinity` or nothing is without limit.

    Anything else ends the program with the usage and status 1.
    """

    def number(text: str | None, name: str, default):
        if text is None or text == "":
            return default
        if text == "Infinity":
            return None
        found = re.match(r"\s*[+-]?\d+", text)
        if not found:
            parser.print_usage()
            raise SystemExit(1)
        return int(found[0])

    parser = argparse.ArgumentParser(prog="corpusmill")
    parser.add_argument("max_pages", nargs="?")
    parser.add_argument("stale_seconds", nargs="?")
    got = parser.parse_args(argv)
    stale = number(got.stale_seconds, "stale_seconds", 86_400)
    return CrawlOptions(max_pages=number(got.max_pages, "max_pages", None), stale_seconds=float("inf") if stale is None else stale)


def hours_and_minutes(seconds: float) -> str:
    return f"{int(seconds // 3600)}h {int(seconds % 3600 // 60)}m"
