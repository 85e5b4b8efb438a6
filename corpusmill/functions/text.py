"""White space, front matter and sizes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space of the web, without the line feed.
SPACE = "\t\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def js_trim(text: Column) -> Column:
    return F.trim(text, F.lit(SPACE + "\n"))


def trim_line_ends(text: Column) -> Column:
    """Each line without space at its end: lines are cut and joined, as a pattern would be tried at every character."""
    return F.array_join(F.transform(F.split(text, "\n"), lambda line: F.rtrim(line, F.lit(SPACE))), "\n")


def normalize_whitespace(markdown: Column) -> Column:
    """Lines without space at their ends, one blank line at most in a row, no space around the whole."""
    return js_trim(F.regexp_replace(trim_line_ends(markdown), r"\n{3,}", "\n\n"))


def coalesce_empty(*columns: Column) -> Column:
    """The first that is neither null nor empty; the last one as it is."""
    out = columns[-1]
    for c in reversed(columns[:-1]):
        out = F.when((c.isNotNull()) & (c != ""), c).otherwise(out)
    return out


def breadcrumb_trail(breadcrumb: Column) -> Column:
    return F.array_join(breadcrumb, " > ")


def frontmatter(title: Column, heading: Column, url: Column, breadcrumb: Column) -> Column:
    """The lines above a page's Markdown, without blank ones."""
    trail = F.when(F.coalesce(F.size(breadcrumb), F.lit(0)) > 0, F.concat(F.lit("**Breadcrumb:** "), breadcrumb_trail(breadcrumb))).otherwise("")
    lines = F.array(F.concat(F.lit("# "), F.coalesce(coalesce_empty(heading, title), F.lit(""))), F.concat(F.lit("**URL:** "), url), trail, F.lit("---"))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def content_to_markdown(title: Column, heading: Column, url: Column, breadcrumb: Column, body: Column) -> Column:
    return F.concat_ws("\n", frontmatter(title, heading, url, breadcrumb), normalize_whitespace(body))


def preview(text: Column, characters: int = 300) -> Column:
    return F.regexp_replace(F.substring(text, 1, characters), r"\n+", "\n")


def utf16_length(text: Column) -> Column:
    """The length in UTF-16 units, in which the web counts."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("long")


def megabytes(units: Column) -> Column:
    """A size with two decimals, from a length: texts need not be built to say how large they would be."""
    return F.call_function("format_number", units / 1024 / 1024, F.lit("0.00"))


def iso_time(timestamp: Column) -> Column:
    """UTC with milliseconds, for a session in UTC."""
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def page_is_fresh(crawled_at: Column, now: Column, stale_seconds: float) -> Column:
    """Younger than the threshold; a missing time is stale, a threshold of 0 makes all stale."""
    if stale_seconds == 0:
        return F.lit(False)
    return F.coalesce(F.unix_micros(now) - F.unix_micros(crawled_at) < F.lit(stale_seconds * 1_000_000), F.lit(False))


def redirect_is_fresh(cached_at: Column, now: Column, stale_seconds: float) -> Column:
    """Not yet as old as the threshold; a missing time is fresh, a threshold of 0 or less makes all fresh."""
    if stale_seconds <= 0:
        return F.lit(True)
    return ~F.coalesce(F.unix_micros(now) - F.unix_micros(cached_at) >= F.lit(stale_seconds * 1_000_000), F.lit(False))
