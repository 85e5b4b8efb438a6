import datetime as dt
import random

import pytest

from corpusmill.streaming.refetch import refetch_stream, refetches, upsert_latest

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "page_id long, url string, fetched_at timestamp"


def brute(rows, stale):
    last, out = {}, []
    for i, url, at in sorted((r for r in rows if r[1] is not None and r[2] is not None), key=lambda r: (r[1], r[2], r[0])):
        if url not in last or (at - last[url]).total_seconds() >= stale:
            last[url] = at
            out.append((url, i))
    return sorted(out)


def arrivals(n, seed=3):
    pick = random.Random(seed)
    return [(k, f"u{min(pick.randrange(9), 3)}", T0 + dt.timedelta(seconds=pick.randrange(4000), milliseconds=pick.randrange(3))) for k in range(n)]


@pytest.mark.parametrize("stale", [0, 1, 60, 86_400])
def test_batch(spark, stale):
    rows = [*arrivals(400), (1000, None, T0), (1001, "u1", None), (7, "u2", T0), (7, "u2", T0)]
    got = refetches(spark.createDataFrame(rows, SCHEMA), stale)
    assert sorted((r.key, r.id) for r in got.collect()) == brute(rows, stale)
    assert refetches(spark.createDataFrame([], SCHEMA), stale).count() == 0


def test_stream_equals_batch_in_any_order(spark, tmp_path):
    """Arrivals out of order within the watermark, in several batches, one of them after a restart."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = sorted(arrivals(200), key=lambda r: r[2])
    pick = random.Random(5)
    mixed = sorted(rows, key=lambda r: r[2] + dt.timedelta(seconds=pick.randrange(500)))
    ends = [(9000 + k, "end", T0 + dt.timedelta(days=k + 1)) for k in range(3)]
    try:
        for part in (mixed[:90], mixed[90:], ends[:2], ends[2:]):
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
            refetch_stream(stream, 60, within="10 minutes").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/at").trigger(availableNow=True).start().awaitTermination(120)
        got = spark.read.parquet(f"{tmp_path}/out").where("key <> 'end'").collect()
        assert sorted((r.key, r.id) for r in got) == brute(rows, 60)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_upsert(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([("a", k, 10 + k), (f"b{k}", k, k)], "key string, at long, id long").write.mode("append").parquet(f"{tmp_path}/in")
        upsert_latest(spark.readStream.schema("key string, at long, id long").parquet(f"{tmp_path}/in"), f"{tmp_path}/t", f"{tmp_path}/at").awaitTermination(60)
    got = spark.read.parquet(f"{tmp_path}/t/version=2").collect()
    assert sorted(map(tuple, got)) == [("a", 2, 12), ("b0", 0, 0), ("b1", 1, 1), ("b2", 2, 2)]
