"""The folder in which a crawl keeps its pages and redirects: sources and sinks.

A page is three files with one stem: .json, .html and .md. Records are read with an
explicit schema; what can't be parsed counts as stale, or as no redirect, and stops nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.config import CrawlOptions, SiteProfile
from corpusmill.functions.text import iso_time, page_is_fresh, redirect_is_fresh
from corpusmill.functions.urls import extract_links, redirect_filename, url_to_filename
from corpusmill.operators.dedup import last_write
from corpusmill.sources import folder as folder_source

PAGE = "url string, title string, heading string, breadcrumb array<string>, text string, crawledAt string"
REDIRECT = "source string, target string, cachedAt string"


def parsed_time(text: Column) -> Column:
    """A time from what JSON has: an ISO string, or milliseconds; null if it is neither."""
    return F.coalesce(F.try_to_timestamp(text), F.when(F.regexp_like(text, F.lit(r"^-?\d+$")), F.timestamp_millis(text.cast("long"))))


#: Names in the folder that are no page.
NO_PAGES = ".redirect.json,_summary.json"


def _stems(spark: SparkSession, folder: str, kinds: str, **more: str) -> DataFrame:
    """stem and the files of kinds of every record; an absent or empty folder gives no rows."""
    folder_source.register(spark)
    return spark.read.format("stems").option("kinds", kinds).options(**more).load(folder)


def valid_redirects(rows: DataFrame, options: CrawlOptions) -> DataFrame:
    """source, target, cachedAt of the redirect records (source, target, cachedAt: string) that are still valid."""
    rows = rows.where("source is not null and target is not null").withColumn("cachedAt", parsed_time(F.col("cachedAt")))
    return rows.where(redirect_is_fresh(F.col("cachedAt"), F.lit(options.now), options.stale_seconds)).select("source", "target", "cachedAt")


def read_redirects(spark: SparkSession, options: CrawlOptions) -> DataFrame:
    """source, target, cachedAt of the redirects that are still valid."""
    return valid_redirects(_stems(spark, options.progress_dir, "redirect_json").select(F.from_json("redirect_json", REDIRECT).alias("r")).select("r.*"), options)


def lookup_redirect(spark: SparkSession, url: str, profile: SiteProfile, options: CrawlOptions) -> str | None:
    """Where a still valid redirect leads from url."""
    name = spark.range(1).select(redirect_filename(F.lit(url), profile.path_prefix)).first()[0]
    if name is None:
        return None
    found = _stems(spark, options.progress_dir, "redirect_json").where(F.col("stem") == name.removesuffix(".redirect.json"))
    row = found.select(F.from_json("redirect_json", REDIRECT).alias("r")).select("r.*").first()
    if row is None or row.target is None:
        return None
    fresh = spark.createDataFrame([row], REDIRECT).where(redirect_is_fresh(parsed_time(F.col("cachedAt")), F.lit(options.now), options.stale_seconds))
    return None if fresh.isEmpty() else row.target


def _pretty(**fields: Column) -> Column:
    """A JSON object of strings and lists of strings, two spaces deep, as a crawl writes its records."""
    text = lambda c: F.when(c.isNull(), "null").otherwise(F.regexp_extract(F.to_json(F.struct(c.alias("x"))), r'(?s)^\{"x":(.*)\}\z', 1))

    def shown(name: str) -> Column:
        c = fields[name]
        if name != "breadcrumb":
            return F.concat(F.lit(f'  "{name}": '), text(c))
        items = F.array_join(F.transform(c, lambda x: F.concat(F.lit("    "), text(x))), ",\n")
        return F.concat(F.lit(f'  "{name}": '), F.when(F.coalesce(F.size(c), F.lit(0)) <= 0, "[]").otherwise(F.concat(F.lit("[\n"), items, F.lit("\n  ]"))))

    return F.concat(F.lit("{\n"), F.concat_ws(",\n", *map(shown, fields)), F.lit("\n}"))


def save_redirects(redirects: DataFrame, profile: SiteProfile, options: CrawlOptions) -> None:
    """A file for each source (source, target) that has a name; the executors write. Of repeated names the largest source stays, with its largest target."""
    folder_source.register(redirects.sparkSession)
    rows = last_write(redirects.withColumn("name", redirect_filename(F.col("source"), profile.path_prefix)).where("name is not null").withColumn("ord", F.struct("source", "target")), F.col("name"), "ord")
    made = _pretty(source=F.col("source"), target=F.col("target"), cachedAt=iso_time(F.lit(options.now).cast("timestamp")))
    rows.select(F.regexp_replace("name", r"\.redirect\.json\z", "").alias("stem"), made.alias("redirect_json")).write.format("stems").option("kinds", "redirect_json").mode("append").save(options.progress_dir)


def save_redirect(spark: SparkSession, source: str, target: str, profile: SiteProfile, options: CrawlOptions) -> str | None:
    """The same for one source: the name of its file."""
    row = spark.createDataFrame([(source, target)], "source string, target string")
    save_redirects(row, profile, options)
    return row.select(redirect_filename(F.col("source"), profile.path_prefix)).first()[0]


def page_records(pages: DataFrame, profile: SiteProfile, now: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """The JSON fields of extracted pages, with html, md and the file name beside them."""
    return pages.select(*keep, "url", "title", "heading", F.coalesce("breadcrumb", F.array().cast("array<string>")).alias("breadcrumb"), "text", iso_time(now).alias("crawledAt"), "html", "md", url_to_filename(F.col("url"), profile.path_prefix).alias("filename"))


def chosen_records(pages: DataFrame, profile: SiteProfile, options: CrawlOptions, ord_: str = "ord") -> DataFrame:
    """One record for each file name: that of the page with the largest ord, as a later write leaves it."""
    rows = page_records(pages, profile, F.lit(options.now), keep=(ord_,))
    return last_write(rows.where("filename is not null"), F.col("filename"), ord_).drop(ord_)


def save_table(pages: DataFrame, profile: SiteProfile, options: CrawlOptions, path: str, ord_: str = "ord") -> None:
    """The records as one table, written by the executors: the form for snapshots of any size, in any store."""
    chosen_records(pages, profile, options, ord_).write.mode("overwrite").parquet(path)


def save_records(records: DataFrame, folder: str) -> None:
    """Records (filename and the JSON fields, html, md) as files of their own, three a page, null for a file that is not there. The executors write."""
    folder_source.register(records.sparkSession)
    made = _pretty(**{k: F.col(k) for k in ("url", "title", "heading", "breadcrumb", "text", "crawledAt")})
    rows = records.select(F.regexp_replace("filename", r"\.json\z", "").alias("stem"), made.alias("json"), "html", "md")
    rows.write.format("stems").mode("append").save(folder)


def save_pages(pages: DataFrame, profile: SiteProfile, options: CrawlOptions, ord_: str = "ord") -> None:
    """The three files of each page; the last write of a name stays."""
    chosen = chosen_records(pages, profile, options, ord_)
    save_records(chosen.withColumns({c: F.coalesce(c, F.lit("")) for c in ("html", "md")}), options.progress_dir)


def judged(records: DataFrame, options: CrawlOptions) -> DataFrame:
    """records (url, crawledAt: string, html, md among others) with complete, and fresh: complete and young."""
    complete = F.col("html").isNotNull() & F.col("md").isNotNull()
    young = page_is_fresh(parsed_time(F.col("crawledAt")), F.lit(options.now), options.stale_seconds) & F.col("url").isNotNull()
    return records.withColumn("complete", complete).withColumn("fresh", young & complete)


def read_pages(spark: SparkSession, options: CrawlOptions, bodies: bool = True) -> DataFrame:
    """filename, the JSON fields, html, md, complete and fresh of every page record of the folder; without bodies html and md only say whether they are there."""
    found = _stems(spark, options.progress_dir, "json,html,md", without=NO_PAGES, bodies=str(bodies).lower())
    records = found.select(F.concat("stem", F.lit(".json")).alias("filename"), F.from_json("json", PAGE).alias("r"), "html", "md")
    return judged(records.select("filename", "r.*", "html", "md"), options)


def cache_summary(pages: DataFrame) -> DataFrame:
    """One row: how many page records are fresh, and how many are not."""
    return pages.agg(F.count_if("fresh").alias("fresh"), F.count_if(~F.col("fresh")).alias("stale"))


def resume_seeds(pages: DataFrame, profile: SiteProfile) -> DataFrame:
    """url: what the fresh pages' html links to and is not fresh itself."""
    fresh = pages.where("fresh")
    links = fresh.select(F.explode(extract_links(F.col("html"), F.col("url"), profile.base_url, profile.path_prefix)).alias("url")).distinct()
    return links.join(fresh.select("url"), "url", "left_anti")
