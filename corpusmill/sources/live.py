"""Fetching pages over the network, one row for each URL.

A snapshot table is the usual source; this one is for sites without. Each URL is tried
three times, with 10, 20 and 30 seconds of patience; a status is no error, its page is
taken as it is, and ok says whether it was one of success.
"""

from __future__ import annotations

import urllib.error
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AGENT = "Mozilla/5.0 (X11; Linux x86_64) corpusmill"
ATTEMPTS, PATIENCE = 3, 10.0


def fetch_one(url: str, attempts: int = ATTEMPTS, patience: float = PATIENCE) -> dict:
    error = None
    for attempt in range(1, attempts + 1):
        try:
            try:
                answer = urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": AGENT}), timeout=patience * attempt)
            except urllib.error.HTTPError as e:
                answer = e
            with answer:
                charset = answer.headers.get_content_charset() or "utf-8"
                return {"final_url": answer.geturl(), "status": answer.status, "ok": 200 <= answer.status < 300, "html": answer.read().decode(charset, "replace"), "error": None}
        except (OSError, ValueError, LookupError) as e:
            error = f"{type(e).__name__}: {e}"
    return {"final_url": None, "status": None, "ok": False, "html": None, "error": error}


def fetch_pages(urls: DataFrame, url: str = "url", attempts: int = ATTEMPTS, patience: float = PATIENCE) -> DataFrame:
    """url, final_url, status, ok, html, error of every row."""
    kind = pa.struct([("final_url", pa.string()), ("status", pa.int32()), ("ok", pa.bool_()), ("html", pa.string()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                at = batch.column(0)[k].as_py()
                row = pa.array([fetch_one(at or "", attempts, patience)], kind)
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.string()), *row.flatten()], names=["url", *(f.name for f in kind)])

    return urls.select(F.col(url).alias("url")).mapInArrow(run, "url string, final_url string, status int, ok boolean, html string, error string")


def redirects_of(fetched: DataFrame, now) -> DataFrame:
    """source, target, cachedAt of what the fetches were led to."""
    from corpusmill.functions.urls import clean_url

    final = clean_url(F.col("final_url"))
    return fetched.where(final.isNotNull() & (final != F.col("url"))).select(F.col("url").alias("source"), final.alias("target"), F.lit(now).alias("cachedAt"))
