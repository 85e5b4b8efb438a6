"""python -m corpusmill --pages PATH [--base-url URL --prefix PATH --product NAME --title TITLE --output DIR] [max_pages [stale_seconds]]

Crawls a page snapshot (Parquet with url, html) as far as links lead from the base URL,
takes over what the output folder holds and is fresh, and writes the pages, the corpus
and the summary below the output folder. Ends with status 1 on errors.
"""

from __future__ import annotations

import argparse
import dataclasses
import sys

from corpusmill.config import SiteProfile, hours_and_minutes, parse_arguments


def main(argv: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="corpusmill", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--pages", required=True)
    parser.add_argument("--output", default="./output")
    parser.add_argument("--base-url", default=SiteProfile.base_url)
    parser.add_argument("--prefix", default=SiteProfile.path_prefix)
    parser.add_argument("--product", default=SiteProfile.product)
    parser.add_argument("--title", default=SiteProfile.corpus_title)
    known, rest = parser.parse_known_args(argv)
    options = dataclasses.replace(parse_arguments(rest), output_dir=known.output)
    profile = SiteProfile(base_url=known.base_url, path_prefix=known.prefix, product=known.product, corpus_title=known.title)

    from pyspark.sql import SparkSession

    from corpusmill.plans.runs import crawl_snapshot
    from corpusmill.sources import progress
    from corpusmill.sources.corpus import write_corpus_file

    spark = SparkSession.builder.appName("corpusmill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    print(f"pages: {options.max_pages or 'no limit'}, kept for {hours_and_minutes(options.stale_seconds) if options.stale_seconds != float('inf') else 'ever'}")
    stored = progress.read_pages(spark, options)
    cached = stored.where("fresh").select("url", "md")
    got = crawl_snapshot(spark.read.parquet(known.pages), profile, options, cached, progress.read_redirects(spark, options), progress.resume_seeds(stored, profile))
    progress.save_pages(got["pages"], profile, options)
    write_corpus_file(got["corpus"], f"{options.output_dir}/llms-full.txt")
    got["summary"].write.mode("overwrite").json(f"{options.output_dir}/_summary.json")
    row = got["summary"].select("cachedPages", "newlyFetchedPages").first()
    print(f"done: {row.cachedPages + row.newlyFetchedPages} pages ({row.cachedPages} kept, {row.newlyFetchedPages} new)")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
