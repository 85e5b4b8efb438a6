"""The concatenated corpus and the summary of a run."""

from __future__ import annotations

import datetime as dt
import os
import re
import uuid
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.config import SiteProfile
from corpusmill.functions.text import iso_time
from corpusmill.sources.folder import opened
from corpusmill.sources.tables import written


def corpus_header(title: str, generated: Column, total: Column, cached: Column | None = None, fetched: Column | None = None, regenerated: bool = False) -> Column:
    """The lines above the pages: of a crawl with its counts, of a regeneration, or of a sample."""
    lines = [F.lit(f"# {title}"), F.lit(""), F.concat(F.lit("**Generated:** "), iso_time(generated)), F.concat(F.lit("**Total Pages:** "), total.cast("string"))]
    if cached is not None and fetched is not None:
        lines += [F.concat(F.lit("**Cached Pages:** "), cached.cast("string")), F.concat(F.lit("**Newly Fetched Pages:** "), fetched.cast("string"))]
    if regenerated:
        lines.append(F.lit("**Regenerated from cache:** true"))
    return F.array_join(F.array(*lines, F.lit(""), F.lit("---"), F.lit("")), "\n")


def corpus_lines(pages: DataFrame, header: str, ord_: str = "ord", md: str = "md") -> DataFrame:
    """seq, value: the corpus as ordered pieces that stand a line feed apart. Nothing is gathered."""
    body = pages.select(F.col(ord_).cast("long").alias("seq"), F.concat(F.lit("\n\n"), F.coalesce(F.col(md), F.lit(""))).alias("value"))
    first = pages.sparkSession.range(1).select(F.lit(-(1 << 62)).alias("seq"), F.lit(header).alias("value"))
    return first.union(body)


def write_corpus(lines: DataFrame, path: str) -> None:
    """Ordered part files: each holds a range of seq, and their concatenation is the corpus with a line feed at its end."""
    lines.orderBy("seq").select("value").write.mode("overwrite").text(path)


def corpus_ranges(lines: DataFrame) -> DataFrame:
    """seq, value, begin, n_bytes: where in the one file of a corpus each piece stands.

    Pieces are sorted by ranges and written; sums run inside a range, and of each range one
    number goes to the driver, which adds them up: no task sees all.
    """
    ranged = written(lines.select("seq", "value").orderBy("seq").withColumn("id", F.monotonically_increasing_id()), "corpus")
    sized = ranged.withColumn("part", F.shiftright("id", 33)).withColumn("n_bytes", F.octet_length("value").cast("long"))
    # a line feed stands between two pieces, none behind the last
    totals = sorted((r.part, r.n) for r in sized.groupBy("part").agg(F.sum(F.col("n_bytes") + 1).alias("n")).collect())
    before = zip((p for p, _ in totals), accumulate([0, *(n for _, n in totals)]), strict=False)
    offsets = lines.sparkSession.createDataFrame(list(before), "part long, before long")
    inside = F.coalesce(F.sum(F.col("n_bytes") + 1).over(Window.partitionBy("part").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sized.withColumn("inside", inside).join(F.broadcast(offsets), "part").select("seq", "value", (F.col("before") + F.col("inside")).alias("begin"), "n_bytes")


def write_corpus_file(lines: DataFrame, path: str) -> DataFrame:
    """The corpus as one file, byte by byte as its format says; gives seq, begin, n_bytes of its pieces.

    In a folder that all executors mount (a path, or file:), each task writes its pieces at
    their places in a file that has its length from the start; a task that is tried again
    writes the same bytes. Elsewhere the parts are written by Spark and joined by the store
    (concat and truncate, which HDFS has); a store that can't keeps them as write_corpus does,
    and says so by an error. The file gets its name when all of it is there.
    """
    spark = lines.sparkSession
    ranges = written(corpus_ranges(lines), "ranges")
    total = ranges.agg(F.max(F.col("begin") + F.col("n_bytes"))).first()[0] or 0
    if "://" in path and not path.startswith("file:"):
        write_corpus(ranges.select("seq", "value"), f"{path}.parts")
        _joined(spark, f"{path}.parts", path, total)
        return ranges.drop("value")
    target = re.sub("^file:/+", "/", path)
    building = f"{target}.{uuid.uuid4().hex}"
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with open(building, "wb") as f:
        f.truncate(total)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, file = 0, os.open(building, os.O_WRONLY)
        try:
            for batch in batches:
                for value, begin in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                    data = value.as_py().encode()
                    data += b"\n" if begin + len(data) < total else b""
                    while data:
                        done = os.pwrite(file, data, begin)
                        data, begin, n = data[done:], begin + done, n + done
            os.fsync(file)
        finally:
            os.close(file)
        yield pa.RecordBatch.from_pydict({"n": [n]})

    put_bytes = ranges.select("value", "begin").mapInArrow(put, "n long").agg(F.sum("n")).first()[0] or 0
    if put_bytes != total:
        raise OSError(f"{put_bytes} of {total} bytes of the corpus were written")
    os.replace(building, target)
    return ranges.drop("value")


def _joined(spark: SparkSession, parts: str, path: str, total: int) -> None:
    """One file of ordered part files, by the store itself: nothing is copied."""
    at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    files = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(str(s.getPath()) for s in files.listStatus(at(parts)) if s.getPath().getName().startswith("part-") and s.getLen())
    files.delete(at(path), False)
    files.rename(at(names[0]), at(path))
    if names[1:]:
        rest = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(names) - 1)
        for k, name in enumerate(names[1:]):
            rest[k] = at(name)
        files.concat(at(path), rest)
    files.truncate(at(path), total)


def read_ranges(ranges: DataFrame, path: str) -> DataFrame:
    """seq and the bytes of each range (seq, begin, n_bytes) of a file, each read where it stands."""

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, name = opened(path)
        with files.open_input_file(name) as f:
            for batch in batches:
                for k in range(0, batch.num_rows, 64):
                    some = batch.slice(k, 64)
                    data = [f.read_at(n, at) for at, n in zip(some.column(1).to_pylist(), some.column(2).to_pylist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([some.column(0), pa.array(data, pa.binary())], names=["seq", "data"])

    return ranges.select("seq", "begin", "n_bytes").mapInArrow(get, "seq long, data binary")


def corpus_text(pages: DataFrame, header: Column, ord_: str = "ord", md: str = "md") -> DataFrame:
    """One row with the whole corpus, for corpora that one value can hold; write_corpus() has no bound."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(ord_).alias("o"), F.concat(F.lit("\n\n"), F.coalesce(F.col(md), F.lit(""))).alias("m"))))
    return pages.agg(parts.alias("p"), F.count("*").alias("n")).select(F.array_join(F.concat(F.array(header), F.transform("p", lambda x: x["m"])), "\n").alias("corpus"))


def summary(visited: DataFrame, cached: int, fetched: int, profile: SiteProfile, now: dt.datetime, ord_: str = "ord") -> DataFrame:
    """One row with the fields of a run's summary; totalPages counts what was fetched."""
    urls = F.transform(F.array_sort(F.collect_list(F.struct(ord_, "url"))), lambda x: x["url"])
    return visited.agg(urls.alias("pages")).select(
        F.lit(fetched).cast("long").alias("totalPages"), F.lit(cached).cast("long").alias("cachedPages"), F.lit(fetched).cast("long").alias("newlyFetchedPages"), F.lit(now).alias("crawledAt"), F.lit(profile.base_url).alias("baseUrl"), "pages"
    )
