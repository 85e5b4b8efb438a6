"""Whole runs: a crawl over a snapshot, the regeneration of Markdown, and a sample."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.config import CrawlOptions, SiteProfile
from corpusmill.functions.text import content_to_markdown, preview, utf16_length
from corpusmill.functions.urls import clean_url
from corpusmill.operators.crawl import crawl_rounds
from corpusmill.operators.dedup import last_write
from corpusmill.operators.extract import extract_pages
from corpusmill.operators.links import edges, page_links
from corpusmill.sources.corpus import corpus_header, corpus_lines, summary
from corpusmill.sources.tables import written


def crawl_snapshot(pages: DataFrame, profile: SiteProfile, options: CrawlOptions, cached: DataFrame | None = None, redirects: DataFrame | None = None, seeds: DataFrame | None = None, leads: DataFrame | None = None, ord_: str | None = None) -> dict[str, DataFrame]:
    """A crawl by breadth of a snapshot (url, html).

    cached: url, md of pages taken over, free of the limit. redirects: source, target,
    cachedAt known before. leads: source, target of what fetches are led to; those known
    before lead too. seeds: url; the base URL is always one, after them. ord_: the column by
    which the last of several rows of a URL counts; without it the largest html does. Gives
    pages (extracted, with ord and md), corpus (seq, value), summary, tried (every attempt),
    visited (with redirect sources, finals and failed attempts) and redirects.
    """
    spark = pages.sparkSession
    snapshot = last_write(pages.select(clean_url(F.col("url")).alias("url"), "html", (F.col(ord_) if ord_ else F.col("html")).alias("ord")), F.col("url"))
    snapshot = written(snapshot.select("url", "html"), "snapshot")
    redirects = redirects if redirects is not None else spark.createDataFrame([], "source string, target string, cachedAt timestamp")
    follow = redirects.select("source", "target") if leads is None else leads.select("source", "target").union(redirects.select("source", "target").join(leads.select("source"), "source", "left_anti"))
    graph = written(edges(page_links(snapshot, profile, key="url").select("url", "pos", "link")), "graph")
    start = spark.createDataFrame([(profile.base_url, 1 << 62)], "url string, ord long")
    start = start if seeds is None else start.union(seeds.select("url", F.lit(0).cast("long")))
    have = cached.select("url") if cached is not None else spark.createDataFrame([], "url string")
    done = crawl_rounds(graph, snapshot, start, profile.path_prefix, follow, redirects, have, options.max_pages)
    saved = done.tried.where("saved").select(F.col("final").alias("url"), "round", "number")
    fresh = extract_pages(snapshot.join(saved, "url"), profile, keep=("round", "number"))
    fresh = written(fresh.withColumn("ord", F.struct("round", "number", "url")), "pages")
    none = F.struct(F.lit(-1).alias("round"), F.lit(0).cast("long").alias("number"), "url").alias("ord")
    old = cached.select("url", "md", none) if cached is not None else fresh.select("url", "md", "ord").limit(0)
    numbered = written(_numbered(old.select("url", "md", "ord").union(fresh.select("url", "md", "ord"))), "numbered")
    n_old, n_new = old.count(), done.tried.count()
    header = spark.range(1).select(corpus_header(profile.corpus_title, F.lit(options.now), F.lit(n_old + n_new), F.lit(n_old), F.lit(n_new))).first()[0]
    visited = done.visited.withColumn("ord", F.struct("round", "number", "step", "url"))
    return {
        "pages": fresh, "corpus": corpus_lines(numbered, header), "summary": summary(visited, n_old, n_new, profile, options.now), "tried": done.tried,
        "visited": visited.select("url", "ord"), "redirects": done.redirects,
    }


def _numbered(rows: DataFrame) -> DataFrame:
    """rows with a number that rises with ord in its place: a sort by ranges, with no task that sees all."""
    ranged = written(rows.orderBy("ord").withColumn("__id", F.monotonically_increasing_id()), "ranged")
    return ranged.drop("ord").withColumnRenamed("__id", "ord")


def places(numbered: DataFrame, ord_: str = "ord") -> DataFrame:
    """numbered rows with place, counted from 1: numbers of _numbered() rise by partitions, and a count of each partition goes to the driver."""
    part, inside = F.shiftright(ord_, 33), F.col(ord_).bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r.part, r.n) for r in numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before = list(zip((p for p, _ in sizes), accumulate([0, *(n for _, n in sizes)]), strict=False))
    offsets = numbered.sparkSession.createDataFrame(before, "part long, before long")
    return numbered.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("place", inside + F.col("before") + 1).drop("part", "before")


def regenerate(records: DataFrame, profile: SiteProfile, options: CrawlOptions) -> dict[str, DataFrame]:
    """Markdown anew from stored records (filename, url, title, heading, breadcrumb, html), in order of file names.

    A record without html counts as an error. Gives pages, corpus and counts.
    """
    spark = records.sparkSession
    good = records.where("html is not null and url is not null")
    # the stored html is clean already: nothing more is taken out of it
    plain = SiteProfile(base_url=profile.base_url, path_prefix=profile.path_prefix, exclude_selectors=(), exclude_elements=("template",), heading_patterns=(), noise_patterns=())
    body = extract_pages(good, plain, keep=("filename",)).select("filename", "body_md")
    pages = good.join(body, "filename").withColumn("md", content_to_markdown(F.col("title"), F.col("heading"), F.col("url"), F.col("breadcrumb"), F.col("body_md")))
    numbered = written(_numbered(pages.select("url", "filename", "md", F.col("filename").alias("ord"))), "numbered")
    good_record = F.col("html").isNotNull() & F.col("url").isNotNull()
    counts = records.agg(F.count_if(good_record).alias("success"), F.count_if(~good_record).alias("error"))
    n = counts.first()["success"]
    header = spark.range(1).select(corpus_header(profile.corpus_title, F.lit(options.now), F.lit(n), regenerated=True)).first()[0]
    return {"pages": numbered, "corpus": corpus_lines(numbered, header), "counts": counts}


def sample(pages: DataFrame, urls: list[str], profile: SiteProfile) -> DataFrame:
    """ord, url, title, heading, sizes in the web's units, and a preview of the given pages."""
    spark: SparkSession = pages.sparkSession
    wanted = spark.createDataFrame(list(enumerate(urls)), "ord int, url string")
    found = extract_pages(pages.join(F.broadcast(wanted) if len(urls) < 10_000 else wanted, "url"), profile, keep=("ord",))
    return found.select("ord", "url", "title", "heading", utf16_length(F.col("text")).alias("text_length"), utf16_length(F.col("html")).alias("html_length"), preview(F.col("text")).alias("preview"), "md")
