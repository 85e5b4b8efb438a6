"""The page transforms over a stream of snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.config import SiteProfile
from corpusmill.functions.urls import canonical_url, clean_url
from corpusmill.operators.extract import extract_pages

SNAPSHOT = "page_id long, url string, html string, fetched_at timestamp"


def page_stream(spark: SparkSession, folder: str, schema: str = SNAPSHOT, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def first_of_each_page(stream: DataFrame, profile: SiteProfile, within: str = "1 day", time: str = "fetched_at") -> DataFrame:
    """The first arrival of each canonical URL; its state goes once the watermark has passed it."""
    keyed = stream.withColumn("canonical", canonical_url(clean_url(F.col("url")), profile.path_prefix))
    return keyed.withWatermark(time, within).dropDuplicatesWithinWatermark(["canonical"])


def extracted_stream(stream: DataFrame, profile: SiteProfile, within: str = "1 day") -> DataFrame:
    return extract_pages(first_of_each_page(stream, profile, within), profile, keep=("page_id", "canonical"))


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Takes all that is there and ends; run again, it goes on where it was."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
