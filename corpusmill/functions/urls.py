"""URL algebra as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.weburl import ORIGIN, PATH, SEGMENTS, hrefs_of, let, percent_encoded, url_href, without_dots

LINK = r"(?i)<a[^>]+href=[\"']([^\"']+)[\"'][^>]*>"


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def clean_url(url: Column) -> Column:
    """url without fragment and query."""
    return F.substring_index(F.substring_index(url, "#", 1), "?", 1)


def extract_version(url: Column, prefix: str) -> Column:
    """The number behind the prefix, if a slash follows it; else null."""
    found = F.regexp_extract(url, f"{_quoted(prefix)}/([0-9]+)/", 1)
    return F.when(found != "", found)


def canonical_url(url: Column, prefix: str) -> Column:
    """url without its first version; one version alone goes."""
    return F.regexp_replace(url, f"(?s)^(.*?){_quoted(prefix)}/[0-9]+/", "$1" + prefix.replace("\\", "\\\\").replace("$", "\\$") + "/")


def url_path(url: Column) -> Column:
    """The path of url in normal form; null if url isn't absolute. Whether its host can be one is not asked."""
    plain = rf"^{ORIGIN}({SEGMENTS}|/?)(?:[?#](?s:.*))?\z"
    web = r"(?i)^(?:https?|ftp|wss?):[/\\]*[^/\\?#]+([^?#]*)"
    found = F.when(F.regexp_like(url, F.lit(web)), F.translate(F.regexp_extract(url, web, 1), "\\", "/")).otherwise(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1))
    whole = let(found, lambda p: let(without_dots(p), lambda x: percent_encoded(x, PATH)))
    path = F.when(F.regexp_like(url, F.lit(plain)), F.regexp_extract(url, plain, 1)).when(F.regexp_like(url, F.lit(rf"{web}|^[A-Za-z][A-Za-z0-9+.-]*://")), whole)
    return F.when((path == "") & F.regexp_like(url, F.lit(web)), "/").otherwise(path)


def url_to_filename(url: Column, prefix: str, extension: str = ".json") -> Column:
    """A file name of letters, digits, _ and -; null for what is no absolute URL."""
    name = url_path(url)
    name = F.regexp_replace(name, f"^{_quoted(prefix)}/?", "") if prefix else F.regexp_replace(name, "^/", "")
    name = F.regexp_replace(name, "[^A-Za-z0-9_-]", "_")
    name = F.regexp_replace(F.regexp_replace(name, "_+", "_"), r"^_|_\z", "")
    return F.concat(F.when(name == "", "index").otherwise(name), F.lit(extension))


def swap_extension(filename: Column, extension: str) -> Column:
    return F.regexp_replace(filename, r"\.json\z", extension)


def redirect_filename(url: Column, prefix: str) -> Column:
    return url_to_filename(url, prefix, ".redirect.json")


def resolve_href(href: Column, base: Column) -> Column:
    """href as an absolute URL; null if that can't be. An href that begins with http stays as it is."""
    return F.when(base.isNotNull() & href.startswith("http"), href).otherwise(url_href(href, base))


def raw_hrefs(html: Column) -> Column:
    """The href of each anchor tag, as the pattern finds it: the last one of a tag, entities as they are."""
    return F.regexp_extract_all(html, F.lit(LINK), F.lit(1))


def links_below(hrefs: Column, full: Column, base_url: str, prefix: str) -> Column:
    """The distinct clean ones of full, below base_url, whose hrefs have the prefix, in order of their first place."""
    pairs = F.filter(F.arrays_zip(hrefs.alias("href"), full.alias("full")), lambda x: F.contains(x["href"], F.lit(prefix)) & F.coalesce(x["full"].startswith(base_url), F.lit(False)))
    return F.array_distinct(F.transform(pairs, lambda x: clean_url(x["full"])))


def extract_links(html: Column, url: Column, base_url: str, prefix: str) -> Column:
    """The links of a page's markup as links_below() has them; an href that begins with http is taken as it is."""
    own = F.filter(raw_hrefs(html), lambda h: F.contains(h, F.lit(prefix)))
    kept = lambda hrefs: F.transform(F.arrays_zip(hrefs.alias("h"), hrefs_of(hrefs, url).alias("u")), lambda x: F.when(x["h"].startswith("http"), x["h"]).otherwise(x["u"]))
    return let(own, lambda hrefs: links_below(hrefs, kept(hrefs), base_url, prefix))
