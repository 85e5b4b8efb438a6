"""Which of several copies of a page stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.urls import canonical_url, extract_version, url_to_filename


def dedup_versions(urls: DataFrame, prefix: str, url: str = "url", ord_: str = "ord") -> DataFrame:
    """One row for each canonical URL: that without a version, else the one found first.

    An aggregate that keeps one row while it reads, so a page in any number of versions
    never meets in one task as a whole.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in urls.columns))
    rank = F.struct(extract_version(F.col(url), prefix).isNotNull().alias("versioned"), F.col(ord_).alias("ord"), F.col(url).alias("url"))
    return urls.groupBy(canonical_url(F.col(url), prefix).alias("__canonical")).agg(F.min_by(row, rank).alias("__row")).select("__row.*", F.col("__canonical").alias("canonical"))


def last_write(rows: DataFrame, key: Column, ord_: str = "ord") -> DataFrame:
    """For each key the row with the largest ord: what a later write leaves."""
    row = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    return rows.groupBy(key.alias("__key")).agg(F.max_by(row, F.col(ord_)).alias("__row")).select("__row.*")


def last_write_by_filename(pages: DataFrame, prefix: str, url: str = "url", ord_: str = "ord") -> DataFrame:
    return last_write(pages.withColumn("filename", url_to_filename(F.col(url), prefix)), F.col("filename"), ord_)


def filename_collisions(pages: DataFrame, prefix: str, url: str = "url") -> DataFrame:
    """filename and n_urls of every file name that several URLs share."""
    names = pages.select(url_to_filename(F.col(url), prefix).alias("filename"), F.col(url).alias("url"))
    return names.groupBy("filename").agg(F.count_distinct("url").alias("n_urls")).where("n_urls > 1")
