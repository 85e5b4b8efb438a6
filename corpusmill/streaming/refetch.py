"""Which arrivals of a page a cache with a lifetime takes: in a batch, and in a stream with state.

Of the arrivals of one page, in the order of their times, the first is taken, and then each
that comes when the last one taken is no longer fresh: stale_seconds old, or more. Others
find a fresh page and are let go. Equal times go by their ids; a lifetime of 0 takes all.

The stream gives the rows that the batch gives, in whatever order and batches they arrive
within the watermark: arrivals wait in the state of their page until the watermark has
passed their time, and a timer takes them on in order. The state of a page that is fresh no
more, and for which nothing waits, goes. Rows later than the watermark are let go.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

ROW = StructType([StructField("key", StringType()), StructField("at", LongType()), StructField("id", LongType())])


def _arrivals(rows: DataFrame, key: str, time: str, id_: str) -> DataFrame:
    """key, at (microseconds) and id of the rows that have a key and a time."""
    return rows.select(F.col(key).cast("string").alias("key"), F.unix_micros(F.col(time).cast("timestamp")).alias("at"), F.col(id_).cast("long").alias("id")).where("key is not null and at is not null")


def refetches(rows: DataFrame, stale_seconds: float, key: str = "url", time: str = "fetched_at", id_: str = "page_id") -> DataFrame:
    """key, at, id of the arrivals that are taken.

    A task reads its pages' arrivals in order and holds the last one taken alone, however many
    arrivals a page has.
    """
    stale = int(stale_seconds * 1_000_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, last = None, 0
        for batch in batches:
            taken = []
            for k, (name, at) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if name != here or at - last >= stale:
                    taken.append(k)
                    here, last = name, at
            yield batch.take(pa.array(taken, pa.int64()))

    found = _arrivals(rows, key, time, id_)
    return found.repartition("key").sortWithinPartitions("key", "at", "id").mapInArrow(run, ROW)


class Cache(StatefulProcessor):
    """The state of a page: when it was last taken, and the arrivals that the watermark has not passed."""

    def __init__(self, stale_seconds: float):
        self.stale = int(stale_seconds * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", StructType([StructField("at", LongType())]))
        self.waiting = handle.getMapState("waiting", StructType([StructField("at", LongType()), StructField("id", LongType())]), StructType([StructField("n", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        timers = set()
        for frame in rows:
            for at, id_ in zip(frame["at"].tolist(), frame["id"].tolist(), strict=True):
                one = (at, id_)
                n = self.waiting.getValue(one)[0] if self.waiting.containsKey(one) else 0
                self.waiting.updateValue(one, (n + 1,))
                timers.add(-(-at // 1000))
        for t in timers:
            self.handle.registerTimer(t)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        due = sorted((k[0], k[1], v[0]) for k, v in self.waiting.iterator() if k[0] <= now)
        last, taken = self.last.get()[0] if self.last.exists() else None, []
        for at, id_, n in due:
            self.waiting.removeKey((at, id_))
            for _ in range(n):
                if last is None or at - last >= self.stale:
                    taken.append((key[0], at, id_))
                    last = at
        if taken:
            self.last.update((last,))
            self.handle.registerTimer(-(-(last + self.stale) // 1000))
        elif last is not None and now >= last + self.stale and not any(True for _ in self.waiting.keys()):
            self.last.clear()
        if taken:
            yield pd.DataFrame(taken, columns=["key", "at", "id"])

    def close(self) -> None:
        pass


def refetch_stream(stream: DataFrame, stale_seconds: float, within: str = "1 day", key: str = "url", time: str = "fetched_at", id_: str = "page_id") -> DataFrame:
    """The same of a stream. The session's state store must be one with column families (RocksDB)."""
    timed = stream.withColumn("__time", F.col(time).cast("timestamp")).withWatermark("__time", within)
    rows = timed.select("__time", F.col(key).cast("string").alias("key"), F.unix_micros("__time").alias("at"), F.col(id_).cast("long").alias("id")).where("key is not null and at is not null")
    return rows.groupBy("key").transformWithStateInPandas(Cache(stale_seconds), ROW, "Append", "EventTime")


def upsert_latest(stream: DataFrame, path: str, checkpoint: str, key: str = "key") -> StreamingQuery:
    """Keeps of each key the latest row (by at, id) as a table: each batch writes the next version from the last, so a batch that is done again gives the same."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old, new = f"{path}/version={number - 1}", f"{path}/version={number}"
        files = spark._jvm.org.apache.hadoop.fs.Path(old)
        there = files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files)
        whole = batch.unionByName(spark.read.schema(batch.schema).parquet(old)) if there else batch
        row = F.struct(*batch.columns)
        whole.groupBy(key).agg(F.max_by(row, F.struct("at", "id")).alias("row")).select("row.*").write.mode("overwrite").parquet(new)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
