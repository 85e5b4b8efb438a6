"""Links of pages as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.config import SiteProfile
from corpusmill.functions.urls import extract_links


def page_links(pages: DataFrame, profile: SiteProfile, key: str = "page_id") -> DataFrame:
    """key, url, pos, link: the distinct links of each page, by the pattern, in order."""
    links = extract_links(F.col("html"), F.col("url"), profile.base_url, profile.path_prefix)
    return pages.select(key, "url", F.posexplode(links).alias("pos", "link"))


def link_counts(links: DataFrame) -> DataFrame:
    """One row: n_links, with repeats across pages, and n_distinct."""
    return links.agg(F.count("*").alias("n_links"), F.count_distinct("link").alias("n_distinct"))


def new_links(links: DataFrame, visited: DataFrame) -> DataFrame:
    """The distinct links that are not among visited (url)."""
    return links.select(F.col("link").alias("url")).distinct().join(visited.select("url").distinct(), "url", "left_anti")


def edges(links: DataFrame) -> DataFrame:
    """src, dst, pos."""
    return links.select(F.col("url").alias("src"), F.col("link").alias("dst"), "pos")
