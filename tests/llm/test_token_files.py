import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm.chunks import tokenizer
from corpusmill.llm import token_files
from corpusmill.llm.token_files import Encoder, Segment, buckets_of, build, has_settings, read_ids, tokens_at, write_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=900), max_size=4))
def test_codes_round_trip(docs):
    ids = np.array([x for d in docs for x in d], np.uint32)
    s = Segment(build(ids, np.arange(len(docs)), np.array([len(d) for d in docs], np.int64)))
    assert s.all().tolist() == ids.tolist()
    assert [s[i] for i in range(0, len(ids), 7)] == ids[::7].tolist()
    assert [s.document(k).tolist() for k in range(len(docs))] == docs
    assert all(s.between(i, j).tolist() == ids[i:j].tolist() for i in range(0, len(ids), 211) for j in range(i, len(ids), 307))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abS'st1,. \n\t\r 　é漢🙂Σς́")) | st.characters(codec="utf-8"), max_size=40), max_size=4))
def test_chunks_equal_whole_texts(batch):
    batch += [" ".join(batch), "Don't we'll ŠÉİ ªº 1234 ½ x²--'s '' 'S'S ÀÉ", *batch]
    want = [e.ids for e in tokenizer(PATH).encode_batch(batch, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in Encoder(PATH).encode(batch)] == want


def test_files(spark, tmp_path):
    rows = [(5, "The cat sat", "x"), (3, None, "y"), (9, "", "z"), (-4, "special <|endoftext|> string", "q"), (7, "long word " * 30_000, ""), (5, "The cat sat", "x"), (None, "No key", "")]
    rows += [(100 + i, f"Text number {i}", "") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(5)
    write_ids(df, PATH, 2, f"file://{tmp_path}/f")
    got = sorted(read_ids(spark, f"file://{tmp_path}/f").collect(), key=lambda r: r.start)
    at = 0
    assert [r.doc_id for r in got] == sorted((x[0] for x in rows), key=lambda k: (k is not None, k or 0))
    for r, (key, text, _) in zip(got, sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)), strict=True):
        ids = [*tokenizer(PATH).encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (key, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    flat = [x for r in got for x in r.ids]
    places = [0, 1, 5, len(flat) - 1, len(flat) // 2, 60_000, 60_001, len(flat), -1, None, 5]
    asked = spark.createDataFrame([(p,) for p in places], "position long")
    found = {r.position: r.token for r in tokens_at(spark, f"file://{tmp_path}/f", asked).collect()}
    assert found == {p: flat[p] for p in set(places) - {None, -1, len(flat)}}
    write_ids(df.limit(0), PATH, 2, f"file://{tmp_path}/none")
    assert tokens_at(spark, f"file://{tmp_path}/none", asked).count() == 0
    assert read_ids(spark, f"file://{tmp_path}/none").count() == 0


def test_frequent_keys_are_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_TOKENS", 64)
    edges = np.array([3, 5, 5, 5, 9])
    pick = np.random.default_rng(1)
    keys, hashes = np.sort(pick.choice([1, 3, 4, 5, 5, 5, 7, 9, 11], 2000)), pick.integers(-(1 << 63), (1 << 63) - 1, 2000)
    order = np.lexsort((hashes, keys))
    got = buckets_of(keys[order], hashes[order], edges)
    assert (np.diff(got) >= 0).all() and set(got.tolist()) == set(range(6)) and len(set(got[keys[order] == 5].tolist())) == 4
    rows = [(None if k % 3 else 7, f"text number {k} of many") for k in range(300)] + [(None, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    write_ids(df, PATH, 2, f"file://{tmp_path}/f")
    got = sorted(read_ids(spark, f"file://{tmp_path}/f").collect(), key=lambda r: r.start)
    want = sorted((k is not None, [*tokenizer(PATH).encode(t or "", add_special_tokens=False).ids, 2]) for k, t in rows)
    assert sorted((r.doc_id is not None, r.ids) for r in got) == want
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda k: (k is not None, k or 0))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))
    assert spark.read.parquet(f"file://{tmp_path}/f").select("bucket").distinct().count() == 4


def test_other_tokenizers_encode_whole_texts():
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert has_settings(tokenizer(PATH)) and not has_settings(tokenizer(other))
    batch = ["The Cat  sat\n on", "", "a <|endoftext|> b", "É漢 x" * 50]
    want = [e.ids for e in tokenizer(other).encode_batch(batch, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in Encoder(other).encode(batch)] == want


def test_one_position_opens_its_segments_alone(spark, tmp_path):
    path = f"file://{tmp_path}/f"
    rows = [(k, f"text number {k} " * 400) for k in range(400)]
    write_ids(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), PATH, 2, path)
    assert spark.read.parquet(path).count() > 6
    found = tokens_at(spark, path, spark.createDataFrame([(3,)], "position long"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    payload = next(line for line in plan.splitlines() if "FileScan" in line and "payload" in line)
    assert "In(bucket" in payload or "EqualTo(bucket" in payload, payload
    assert found.count() == 1
    seen = found._jdf.queryExecution().executedPlan().toString()
    broadcasts = seen.split("BroadcastExchange")[1:]
    assert all("payload" not in b.split("FileScan")[1].splitlines()[0] for b in broadcasts if "FileScan" in b)
    many = tokens_at(spark, path, spark.range(0, 200_000, 7).withColumnRenamed("id", "position"))
    assert many.count() == len(range(0, 200_000, 7))
