"""Page extraction: one Arrow pass over the markup gives all that is read from the tree."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.config import BREADCRUMB, BREADCRUMB_ITEMS, SiteProfile
from corpusmill.functions.text import content_to_markdown
from corpusmill.functions.urls import links_below
from corpusmill.functions.weburl import hrefs_of, let, url_href
from corpusmill.operators.clean import clean
from corpusmill.operators.dom import SPACE, inner_html, rules
from corpusmill.operators.markdown import markdown
from corpusmill.operators.tree import parse

FIELDS = pa.struct([("title", pa.string()), ("heading", pa.string()), ("text", pa.string()), ("html", pa.string()), ("breadcrumb", pa.list_(pa.string())), ("hrefs", pa.list_(pa.string())), ("base", pa.string()), ("body_md", pa.string()), ("error", pa.string())])
COLUMNS = "title string, heading string, text string, html string, breadcrumb array<string>, hrefs array<string>, base string, body_md string, error string"


#: Rows of a batch that are in Python at a time.
SLICE = 64


def extract_one(html: str | None, profile: SiteProfile, selectors: tuple[str, ...] | None = None, fields: frozenset[str] = frozenset(FIELDS.names)) -> dict:
    """All fields of a page; those not among fields stay empty. A page that fails gives its error, and stops nothing."""
    out = dict.fromkeys(("title", "heading", "text", "html", "body_md"), "") | {"breadcrumb": [], "hrefs": [], "base": None, "error": None}
    try:
        document = parse(html or "")
        first, trails = {}, rules((BREADCRUMB,))
        for n in document.elements():
            if n.tag == "a" and "href" in n.attrs:
                out["hrefs"].append(n.attrs["href"])
            elif n.tag in ("title", "h1") or n.tag == "base" and "href" in n.attrs:
                first.setdefault(n.tag, n)
            if n.attrs and "trail" not in first and trails.hit(n):
                first["trail"] = n
        if "title" in first:
            out["title"] = " ".join(first["title"].text().split())
        if "trail" in first:
            out["breadcrumb"] = [t for t in (n.text().strip(SPACE) for n in first["trail"].select(BREADCRUMB_ITEMS)) if t]
        if "h1" in first:
            out["heading"] = first["h1"].text().strip(SPACE)
        if "base" in first:
            out["base"] = first["base"].attrs["href"]
        if not fields & {"text", "html", "body_md"}:
            return out
        body = document.children[0].children[-1]
        clean(body, profile, selectors)
        # the cleaned body stands in no page, so its text is that of its text nodes
        if "text" in fields:
            out["text"] = body.text().strip(SPACE)
        if "html" in fields:
            out["html"] = inner_html(body)
        if "body_md" in fields:
            out["body_md"] = markdown(body)
    except Exception as error:  # one page's markup must not stop the others
        out["error"] = f"{type(error).__name__}: {error}"
    return out


def extract_pages(pages: DataFrame, profile: SiteProfile, selectors: tuple[str, ...] | None = None, keep: tuple[str, ...] = ("page_id",), fields: tuple[str, ...] = tuple(FIELDS.names)) -> DataFrame:
    """keep, url, the fields of extract_one, links (clean, below the profile's base) and md of every page.

    Of fields that aren't asked for only empty values are made.
    """
    asked = frozenset(fields)
    names = [*keep, "url"]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*names).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                rows = pa.array([extract_one(h, profile, selectors, asked) for h in batch.column(len(names)).to_pylist()], FIELDS)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *rows.flatten()], names=[*names, *(f.name for f in FIELDS)])

    found = pages.select(*names, "html").mapInArrow(run, f"{kept}, {COLUMNS}")
    # a step of its own: the analyzer counts how deep one step's expressions are
    found = found.withColumn("base", F.when(F.col("base").isNull(), F.col("url")).otherwise(F.coalesce(url_href(F.col("base"), F.col("url")), F.col("url"))))
    # a link that can't be resolved is what it says
    full = lambda hrefs: F.transform(F.arrays_zip(hrefs.alias("h"), hrefs_of(hrefs, F.col("base")).alias("u")), lambda x: F.coalesce(x["u"], x["h"]))
    own = F.filter("hrefs", lambda h: F.contains(h, F.lit(profile.path_prefix)))
    return found.withColumns(
        {
            "links": let(own, lambda hrefs: links_below(hrefs, full(hrefs), profile.base_url, profile.path_prefix)),
            "md": content_to_markdown(F.col("title"), F.col("heading"), F.col("url"), F.col("breadcrumb"), F.col("body_md")),
        }
    ).drop("hrefs", "base")
