"""Token-id files of directly addressable codes: any token is read without decoding a block.

A segment splits each id into 8-bit chunks, one level for each. Level 0 has the low chunk
of every id; a bitmap says which ids go on, and level k+1 has a chunk for those alone. A
rank directory counts the ones before each 512 bits, so that the place of an id on the
next level is one directory entry and the population count of at most 64 bytes. A document
is read in the same way: one rank a level says where its chunks begin there.

A file set is a Parquet folder whose rows are segments of about SEGMENT_TOKENS ids, since
Spark's committers make such folders whole or absent in any store, also when executors are
lost on the way. Payloads are not compressed, and row groups are small, so a lookup reads
the few segments that it asks for and nothing is inflated. Segments are ordered by (bucket,
seq); buckets are ranges of doc_id between quantiles of the whole table, and a doc_id that
fills several of them is split by a hash of the text, so that no task gets more than a share
of the rows. The ids of a bucket start where those of the buckets before it end. Only the
totals of the buckets, one number each, go to the driver.

Defined results: a null or empty text has only the end id; rows with a null doc_id come
first; rows with the same doc_id follow each other by a hash of their text, repeated rows
each have their place; a very long text is one document of a longer segment; other columns
are not read; an empty table gives a file set with no segments; a position outside of the
file set gives no token.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.chunks import ChunkCache, tokenizer
from corpusmill.llm.common import shuffle_partitions, slices, texts, worker_state, written

MAGIC = b"DAC1"
DIRECTORY_BITS = 512
#: Ids of a segment before the next one begins; a document is never split.
SEGMENT_TOKENS = 1 << 16
ROW_GROUP_BYTES = 8 << 20
SLICE = 128
NO_ID = -(1 << 63)


def _directory(bits: np.ndarray) -> np.ndarray:
    """Ones before each block of DIRECTORY_BITS bits."""
    blocks = np.add.reduceat(bits.astype(np.uint32), np.arange(0, len(bits), DIRECTORY_BITS)) if len(bits) else np.zeros(0, np.uint32)
    return np.concatenate([[0], np.cumsum(blocks)]).astype("<u4")


def build(ids: np.ndarray, doc_ids: np.ndarray, counts: np.ndarray) -> bytes:
    """A segment of the ids of some documents, in order."""
    out = [MAGIC, struct.pack("<qq", len(counts), len(ids)), doc_ids.astype("<i8").tobytes(), np.concatenate([[0], np.cumsum(counts)]).astype("<i8").tobytes()]
    rest = ids.astype(np.uint32)
    levels = []
    while True:
        more = rest > 255
        last = not more.any()
        levels.append((rest & 255).astype(np.uint8).tobytes())
        levels.append(b"" if last else np.packbits(more, bitorder="little").tobytes())
        levels.append(b"" if last else _directory(more).tobytes())
        if last:
            break
        rest = rest[more] >> 8
    out.append(struct.pack(f"<i{len(levels)}q", len(levels) // 3, *map(len, levels)))
    return b"".join(out + levels)


class Segment:
    """Reads a segment's bytes in place."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment")
        self.n_docs, self.n_tokens = struct.unpack_from("<qq", data, 4)
        self.doc_ids = np.frombuffer(data, "<i8", self.n_docs, 20)
        self.offsets = np.frombuffer(data, "<i8", self.n_docs + 1, 20 + 8 * self.n_docs)
        at = 28 + 16 * self.n_docs
        (n,) = struct.unpack_from("<i", data, at)
        sizes = struct.unpack_from(f"<{3 * n}q", data, at + 4)
        at += 4 + 24 * n
        self.levels = []
        for k in range(n):
            chunk = np.frombuffer(data, np.uint8, sizes[3 * k], at)
            bitmap = np.frombuffer(data, np.uint8, sizes[3 * k + 1], at + sizes[3 * k])
            ranks = np.frombuffer(data, "<u4", sizes[3 * k + 2] // 4, at + sizes[3 * k] + sizes[3 * k + 1])
            self.levels.append((chunk, bitmap, ranks))
            at += sum(sizes[3 * k : 3 * k + 3])

    def _rank(self, level: int, i: int) -> int:
        """How many ids before the i-th of a level go on to the next one."""
        _, bitmap, ranks = self.levels[level]
        block = i // DIRECTORY_BITS
        inside = np.unpackbits(bitmap[block * DIRECTORY_BITS // 8 : (i >> 3) + 1], bitorder="little")[: i - block * DIRECTORY_BITS]
        return int(ranks[block]) + int(inside.sum())

    def __getitem__(self, i: int) -> int:
        """The i-th id of the segment, by ranks alone."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for level, (chunk, bitmap, _) in enumerate(self.levels):
            value |= int(chunk[i]) << (8 * level)
            if not len(bitmap) or not bitmap[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(level, i)
        return value

    def between(self, i: int, j: int, level: int = 0) -> np.ndarray:
        """The ids from the i-th up to the j-th: one rank a level, and the chunks that are asked for."""
        chunk, bitmap, _ = self.levels[level]
        here = chunk[i:j].astype(np.uint32)
        if len(bitmap) and j > i:
            more = np.unpackbits(bitmap[i >> 3 : (j + 7) >> 3], bitorder="little")[i & 7 :][: j - i].view(bool)
            n = int(more.sum())
            if n:
                at = self._rank(level, i)
                here[more] |= self.between(at, at + n, level + 1) << np.uint32(8)
        return here

    def document(self, k: int) -> np.ndarray:
        return self.between(int(self.offsets[k]), int(self.offsets[k + 1]))

    def all(self) -> np.ndarray:
        return self.between(0, self.n_tokens)


#: Characters whose lower case, composition and class are plain: printable ones below U+0180.
ODD = re.compile("[^\\n -~\u00a1-\u00ac\u00ae-\u012f\u0131-\u017f]|<[|]")
#: The tokenizer's pre-tokens in a lower-cased text of such characters: letters, a digit,
#: a contraction, or what is left of the visible characters.
LETTER, DIGIT = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
PRE_TOKEN = re.compile(f"[{LETTER}]+|[{DIGIT}]|'(?:s|t|re|ve|m|ll|d)|[^\\s{LETTER}{DIGIT}]+")
WORD_ENTRIES = 500_000


def byte_characters() -> str:
    """The character that a byte-level tokenizer has for each byte: itself if it shows, else one from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return "".join(chr(b) if b in shown else chr(next(spare)) for b in range(256))


class WordIds(dict):
    """Ids of pre-tokens as little-endian 32-bit bytes; emptied over its bound."""

    def __init__(self, tok):
        self.tokenize, self.characters = tok.model.tokenize, byte_characters()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORD_ENTRIES:
            self.clear()
        form = word if word.isascii() else word.encode().decode("latin-1").translate(self.characters)
        value = np.array([t.id for t in self.tokenize(form)], "<u4").tobytes()
        if len(word) <= 48:
            self[word] = value
        return value


#: The settings of a tokenizer that the shorter way below stands for; any other one encodes whole texts.
SETTINGS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def has_settings(tok) -> bool:
    """Whether a tokenizer is a BPE with SETTINGS whose added tokens all begin with <|."""
    said = json.loads(tok.to_str())
    return said["model"]["type"] == "BPE" and all(said[k] == v for k, v in SETTINGS.items()) and all(t["content"].startswith("<|") and not t["normalized"] for t in said["added_tokens"])


class Encoder:
    """Little-endian 32-bit ids of whole texts, by a cache of ids of their parts.

    A text of plain characters is cut into the tokenizer's pre-tokens, whose ids are those
    of the text one after another. Any other text is cut at spaces alone: the tokenizer
    drops white space and no pre-token holds any, so it may encode the chunks by themselves.
    """

    def __init__(self, path: str):
        self.tok = tokenizer(path)
        self.short = has_settings(self.tok)
        self.words, self.chunks = WordIds(self.tok), ChunkCache(self.encoded, entries=50_000)

    def encoded(self, chunks: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(chunks, add_special_tokens=False)]

    def encode(self, batch: list[str]) -> list[bytes]:
        if not self.short:
            return self.encoded(batch)
        get, cut, odd = self.words.__getitem__, PRE_TOKEN.findall, ODD.search
        split = [t.replace("\n", " ").split(" ") if odd(t) else None for t in batch]
        chunk = self.chunks.known({c for s in split if s for c in s}).__getitem__
        return [b"".join(map(chunk, s)) if s else b"".join(map(get, cut(t.lower()))) for t, s in zip(batch, split, strict=True)]


def bounds(docs: DataFrame, buckets: int, doc_id: str = "doc_id") -> list[int]:
    """buckets - 1 doc_ids, in order, that split the rows of docs into about equal shares; a frequent one occurs several times."""
    if buckets < 2:
        return []
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))
    return sorted(docs.agg(F.percentile_approx(key, [k / buckets for k in range(1, buckets)], 100 * buckets)).first()[0] or [])


def buckets_of(keys: np.ndarray, hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The bucket of each key. One that is an edge is dealt by ranges of the hash to all buckets that meet there."""
    low, high = np.searchsorted(edges, keys, side="left"), np.searchsorted(edges, keys, side="right")
    share = (hashes.astype(np.float64) + 2.0**63) / 2.0**64
    return (low + np.minimum((share * (high - low + 1)).astype(np.int64), high - low)).astype(np.int32)


def write_ids(docs: DataFrame, tokenizer_path: str, end_id: int, path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encodes every text, appends end_id, and writes segments in ascending doc_id order to path."""
    buckets = max(1, shuffle_partitions(docs.sparkSession))
    edges = np.array(bounds(docs, buckets, doc_id), np.int64)
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state("token_files", tokenizer_path, lambda: Encoder(tokenizer_path))
        for part in slices(batches, SLICE):
            keys, hashes = part.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False), part.column(2).to_numpy()
            ids = [x + end for x in encoder.encode(texts(part.column(1)))]
            packed = [np.frombuffer(x, "<u4").astype("<u2").tobytes() if narrow else x for x in ids]
            yield pa.RecordBatch.from_arrays([pa.array(buckets_of(keys, hashes, edges)), part.column(0), part.column(2), pa.array(packed, pa.binary())], names=["bucket", "doc_id", "hash", "ids"])

    narrow = max(tokenizer(tokenizer_path).get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16
    width = "<u2" if narrow else "<u4"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, start, seq, held, n = None, 0, 0, [], 0

        def flush() -> pa.RecordBatch:
            ids = [np.frombuffer(x, width) for _, x in held]
            keys = np.array([NO_ID if k is None else k for k, _ in held], np.int64)
            data = build(np.concatenate(ids), keys, np.array([len(x) for x in ids]))
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in ((bucket, pa.int32()), (seq, pa.int32()), (start, pa.int64()), (len(ids), pa.int64()), (n, pa.int64()), (data, pa.binary()))],
                names=["bucket", "seq", "start", "n_docs", "n_tokens", "payload"],
            )

        for batch in batches:
            for b, k, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                size = len(ids) // (2 if narrow else 4)
                if held and (b != bucket or n + size > SEGMENT_TOKENS):
                    yield flush()
                    seq, start, held, n = seq + 1, start + n, [], 0
                if b != bucket:
                    bucket, seq, start = b, 0, 0
                held.append((k, ids))
                n += size
        if held:
            yield flush()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("hash", F.xxhash64("text"))
    dealt = rows.mapInArrow(encode, "bucket int, doc_id long, hash long, ids binary").repartitionById(buckets, F.col("bucket"))
    dealt.sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_first(), "hash", "ids").mapInArrow(pack, FILES).write.option("compression", "none").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


#: Segments that a condition names, and positions that are broadcast, at most.
FEW_SEGMENTS, FEW_PLACES = 2000, 500_000
FILES = "bucket int, seq int, start long, n_docs long, n_tokens long, payload binary"


def _files(spark: SparkSession, path: str) -> tuple[DataFrame, dict[int, int]]:
    """The segments, and for each bucket the number of ids before it."""
    files = spark.read.schema(FILES).parquet(path)
    totals = sorted((r.bucket, r.n) for r in files.groupBy("bucket").agg(F.sum("n_tokens").alias("n")).collect())
    return files, dict(zip([b for b, _ in totals], accumulate([0, *(n for _, n in totals)]), strict=False))


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """position, token of each distinct position (long) of a file set, by ranks in the segments that hold them.

    Segments and positions meet by stripes of SEGMENT_TOKENS positions, without their payloads.
    The segments asked for, if they are few, then go as a condition to the scan of payloads,
    which skips files and row groups that have none of them; each id is looked up without
    decoding the others. A payload is never broadcast.
    """
    files, base = _files(spark, path)
    starts = spark.createDataFrame(list(base.items()), "bucket int, base long")  # a row for each bucket
    segments = files.join(F.broadcast(starts), "bucket").select("bucket", "seq", (F.col("base") + F.col("start")).alias("begin"), "n_tokens")
    stripe = lambda c: F.call_function("div", c, F.lit(SEGMENT_TOKENS))
    striped = segments.where("n_tokens > 0").withColumn("stripe", F.explode(F.sequence(stripe(F.col("begin")), stripe(F.col("begin") + F.col("n_tokens") - 1))))
    asked = positions.select(F.col("position").cast("long").alias("position")).where("position >= 0").distinct().withColumn("stripe", stripe(F.col("position")))
    found = striped.join(asked, "stripe").where((F.col("position") >= F.col("begin")) & (F.col("position") < F.col("begin") + F.col("n_tokens")))
    # the places of a segment are as many as it has ids, at most
    places = written(found.groupBy("bucket", "seq", "begin").agg(F.sort_array(F.collect_list(F.col("position") - F.col("begin"))).alias("places")), "places")
    wanted = places.select("bucket", "seq").limit(FEW_SEGMENTS + 1).collect()
    if len(wanted) > FEW_SEGMENTS:
        payloads = files.hint("merge")
    else:
        payloads = files.where(F.col("bucket").isin(sorted({r.bucket for r in wanted})) & F.col("seq").isin(sorted({r.seq for r in wanted})))
        few = (places.agg(F.sum(F.size("places"))).first()[0] or 0) <= FEW_PLACES
        places = F.broadcast(places) if few else places.hint("merge")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            begin, at, segment = batch.column(0)[0].as_py(), batch.column(1)[0].as_py(), Segment(batch.column(2)[0].as_py())
            yield pa.RecordBatch.from_arrays([pa.array([begin + i for i in at], pa.int64()), pa.array([segment[i] for i in at], pa.int64())], names=["position", "token"])

    return places.join(payloads.select("bucket", "seq", "payload"), ["bucket", "seq"]).select("begin", "places", "payload").mapInArrow(look, "position long, token long")


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and ids of every document of a file set.

    start counts the ids of all documents before; the checksum is that of the ids as
    little-endian 32-bit integers. Without with_ids, the lists stay in the workers.
    """
    files, base = _files(spark, path)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, start, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                segment = Segment(data)
                at = segment.offsets
                for k in range(0, segment.n_docs, SLICE):
                    upto = min(k + SLICE, segment.n_docs)
                    keys, ids = segment.doc_ids[k:upto], [segment.document(j).astype("<u4") for j in range(k, upto)]
                    lists = [pa.ListArray.from_arrays(pa.array((at[k : upto + 1] - at[k]).astype(np.int32)), pa.array(np.concatenate(ids).view("<i4")))] if with_ids else []
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys, pa.int64(), mask=keys == NO_ID),
                            pa.array(base[bucket] + start + at[k:upto], pa.int64()),
                            pa.array(np.diff(at[k : upto + 1]), pa.int64()),
                            pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                            *lists,
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids],
                    )

    return files.select("bucket", "start", "payload").mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
