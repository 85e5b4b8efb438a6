"""Benchmark decontamination by spaced seeds and substitution-tolerant overlaps.

A seed is the hash of five words of a window at the positions that a fixed mask keeps; the
others are ignored, so a replaced word spoils only the masks that read it. An item is found
in a text if, on some diagonal, WINDOW words in line (all of its words if it has fewer)
agree at SHARE percent of the places. The four masks cover every way in which such a window
can differ: whatever words are replaced, some mask fits between them, so no item is missed
(a test goes through all patterns). An item of fewer than MIN_SEEDED words may differ
nowhere, and is looked up as a whole: it is found where all its words stand in line.

1. The seeds of the items are a table, however many there are, and two bitmaps of bounded
   size (2**MOST_BITS bits each) say which seeds it may have.
2. One pass over the texts keeps, of texts with seeds in both bitmaps, those seeds, a
   fingerprint of the text and the hashes of its words. Texts that are equal are one from
   here on.
3. Seeds are joined with the items' seeds: each hit gives an item and a diagonal. The words
   of the text along the diagonal are cut out, joined with the item's words and compared.
   All joins read written tables and stand apart from aggregates, so that the rows of a
   frequent seed, item or text are split among tasks. Nothing but the bitmaps and counts
   goes to the driver, and no step looks at the texts once more for more items.

Words are white-space chunks without their characters other than letters and digits,
lower-cased; chunks that leave nothing are skipped.

Defined results: a null or empty text holds no item; an item without words, or with a null
text, is no item; a null doc_id or item_id is passed on; repeated rows each give rows,
repeated items too; of several diagonals the best window counts; a very long text is read
whole; an empty table on either side gives no rows, and clean() then keeps all; other
columns are not read by find_items(), and clean() passes them on inside a struct, where
their names clash with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import named, slices, texts, whole_row, worker_state, written

#: Positions that each mask keeps.
MASKS = ((0, 1, 2, 5, 6), (0, 1, 3, 5, 6), (0, 2, 3, 5, 7), (0, 1, 4, 8, 9))
WINDOW, SHARE, MIN_SEEDED = 13, 80, 8
CACHE_WORDS = 300_000
#: Bits of a bitmap: about BITS_A_SEED for each seed, and 2**MOST_BITS (16 MB) at most.
BITS_A_SEED, LEAST_BITS, MOST_BITS = 64, 20, 27
#: Hits of a text that are gathered in one row.
LINES = 4096
#: Fingerprints of contaminated texts that are broadcast; with more of them, the join shuffles.
BROADCAST_ROWS = 1_000_000

_draw = np.random.default_rng(77)
SALTS = _draw.integers(0, 1 << 63, (len(MASKS), 5), np.uint64) * np.uint64(2) + np.uint64(1)
SHORT_SALTS = _draw.integers(0, 1 << 63, (MIN_SEEDED, MIN_SEEDED), np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """64-bit hashes of normalised chunks, 0 for those that leave nothing; emptied over its bound."""

    def __missing__(self, chunk: str) -> int:
        word = "".join(filter(str.isalnum, chunk.lower()))
        value = (xxhash.xxh3_64_intdigest(word.encode()) | 1) if word else 0
        if len(chunk) <= 48:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[chunk] = value
        return value


def word_hashes(text: str, known: WordHashes) -> np.ndarray:
    chunks = text.split()
    h = np.fromiter(map(known.__getitem__, chunks), np.uint64, len(chunks))
    return h[h != 0]


def _hashed(h: np.ndarray, n: int, places: tuple[int, ...], salts: np.ndarray) -> np.ndarray:
    out = np.zeros(max(n, 0), np.uint64)
    for at, salt in zip(places, salts, strict=False):
        out += h[at : at + len(out)] * salt
    out ^= out >> np.uint64(31)
    return out * np.uint64(0x9E3779B97F4A7C15)


def seeds(h: np.ndarray, mask: int) -> np.ndarray:
    """The seed of each window of h under a mask."""
    return _hashed(h, len(h) - MASKS[mask][-1], MASKS[mask], SALTS[mask])


def short_seeds(h: np.ndarray, n: int) -> np.ndarray:
    """The hash of each n words in line, for whole items of n words."""
    return _hashed(h, len(h) - n + 1, tuple(range(n)), SHORT_SALTS[n])


def best_window(same: np.ndarray, size: int) -> int:
    """The most places of size in line that are true."""
    if len(same) < size:
        return 0
    total = np.concatenate([[0], same.cumsum()])
    return int((total[size:] - total[:-size]).max())


def needed(n_words: int) -> tuple[int, int]:
    """(words in line that are compared, places that must agree) for an item of n_words words."""
    size = min(WINDOW, n_words)
    return size, math.ceil(size * SHARE / 100) if n_words >= MIN_SEEDED else size


def _batch(columns: list, schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema, strict=True)], names=[n for n, _ in schema])


def item_table(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, item (a 128-bit hash of its words), n, words of every item that has words, written."""
    schema = [("item_id", pa.int64()), ("item", pa.binary()), ("n", pa.int32()), ("words", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in slices(batches):
            words = [word_hashes(t, known) for t in texts(batch.column(1))]
            rows = [(i, xxhash.xxh3_128_digest(w.tobytes()), len(w), w.tobytes()) for i, w in zip(batch.column(0).to_pylist(), words, strict=True) if len(w)]
            if rows:
                yield _batch(list(zip(*rows, strict=True)), schema)

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    return written(rows.mapInArrow(run, "item_id long, item binary, n int, words binary"), "items")


def seed_table(distinct: DataFrame) -> DataFrame:
    """seed, item, n, at: the seeds of each item and where in it they stand, written."""
    schema = [("seed", pa.int64()), ("item", pa.binary()), ("n", pa.int32()), ("at", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            for item, n, data in zip(*(batch.column(k).to_pylist() for k in ("item", "n", "words")), strict=True):
                h = np.frombuffer(data, np.uint64)
                found = [seeds(h, m) for m in range(len(MASKS))] if n >= MIN_SEEDED else [short_seeds(h, n)]
                keys, at = np.concatenate(found), np.concatenate([np.arange(len(f)) for f in found])
                yield _batch([keys.view(np.int64), [item] * len(keys), [n] * len(keys), at.astype(np.int32)], schema)

    return written(distinct.select("item", "n", "words").mapInArrow(run, "seed long, item binary, n int, at int"), "seeds")


def bitmaps(table: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """(bits, bitmap of the seeds' upper bits, bitmap of their lower bits)."""
    count = table.count()
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(BITS_A_SEED * max(count, 1)))))
    upper, lower = F.shiftrightunsigned("seed", 64 - bits), F.col("seed").bitwiseAND(F.lit((1 << bits) - 1))
    out = []
    for h in (upper, lower):
        rows = table.select((h + 1).alias("h")).groupBy(F.bitmap_bucket_number("h").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("m")).collect()
        bitmap = np.zeros((1 << bits) // 8, np.uint8)
        for r in rows:  # buckets of 32768 bits; Spark counts both them and the values in them from one
            bitmap[(r.b - 1) * 4096 : r.b * 4096] = np.frombuffer(r.m, np.uint8)
        out.append(bitmap)
    return bits, *out


def maybe(found: np.ndarray, bits: int, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """The places of the seeds that both bitmaps have."""
    h = found >> np.uint64(64 - bits)
    at = np.flatnonzero((upper[h >> np.uint64(3)] >> (h & np.uint64(7)).astype(np.uint8)) & 1)
    h = found[at] & np.uint64((1 << bits) - 1)
    return at[((lower[h >> np.uint64(3)] >> (h & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)]


HIT = np.dtype([("seed", "<i8"), ("at", "<i4")])


def text_keys(text: str) -> dict:
    """Two 64-bit hashes of a text, in the JVM: its fingerprint."""
    return {"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit(7), text)}


def texts_with_seeds(docs: DataFrame, table: DataFrame, lengths: list[int], doc_id: str, text: str) -> DataFrame:
    """doc_id, k1, k2, words, hits of every row whose text may have a seed of the items, written."""
    bits, *maps = bitmaps(table)
    shared = docs.sparkSession.sparkContext.broadcast(maps)
    schema = [("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("words", pa.binary()), ("hits", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_state("decontaminate", None, WordHashes)
        upper, lower = shared.value
        for batch in slices(batches):
            rows = []
            for key, k1, k2, t in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                h = word_hashes(t, known)
                hits = []
                for found in [seeds(h, m) for m in range(len(MASKS))] + [short_seeds(h, n) for n in lengths]:
                    at = maybe(found, bits, upper, lower)
                    if len(at):
                        some = np.empty(len(at), HIT)
                        some["seed"], some["at"] = found[at].view(np.int64), at
                        hits.append(some)
                if hits:
                    rows.append((key, k1, k2, h.tobytes(), np.concatenate(hits).tobytes()))
            if rows:
                yield _batch(list(zip(*rows, strict=True)), schema)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text <> ''").withColumns(text_keys("text")).select("doc_id", "k1", "k2", "text")
    return written(rows.mapInArrow(run, "doc_id long, k1 long, k2 long, words binary, hits binary"), "hits")


def overlaps(distinct: DataFrame, table: DataFrame, found: DataFrame) -> DataFrame:
    """k1, k2, item, n, n_match of each item in each text (k1, k2, words, hits, distinct), written.

    The lines along which a text and items may agree are gathered by text, LINES hits a part,
    and the text's words meet them once a part, not once a line.
    """

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            for k1, k2, data in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                hits = np.frombuffer(data, HIT)
                parts = pa.array(np.full(len(hits), 1 + len(hits) // LINES, np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hits), k1)), pa.array(np.full(len(hits), k2)), pa.array(hits["seed"].copy()), pa.array(hits["at"].copy()), parts], names=["k1", "k2", "seed", "place", "parts"])

    hits = found.select("k1", "k2", "hits").mapInArrow(opened, "k1 long, k2 long, seed long, place int, parts int")
    lines = written(hits.join(table, "seed").select("k1", "k2", "parts", "item", "n", (F.col("place") - F.col("at")).alias("shift")), "lines")
    part_of = F.pmod(F.xxhash64("item", "shift"), F.col("parts")).alias("part")
    lines = written(lines.groupBy("k1", "k2", part_of).agg(F.collect_set(F.struct("item", "n", "shift")).alias("lines")), "lines")
    along = [("k1", pa.int64()), ("k2", pa.int64()), ("item", pa.binary()), ("n", pa.int32()), ("start", pa.int32()), ("part", pa.binary())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of a text that stand beside those of the item; start is the item's first of them."""
        for batch in slices(batches, 64):
            for k1, k2, found, data in zip(*(batch.column(k).to_pylist() for k in ("k1", "k2", "lines", "words")), strict=True):
                for at in range(0, len(found), LINES):
                    rows = []
                    for line in found[at : at + LINES]:
                        item, n, shift = line["item"], line["n"], line["shift"]
                        start, end = max(0, -shift), min(n, len(data) // 8 - shift)
                        rows.append((k1, k2, item, n, start, data[8 * (start + shift) : 8 * (end + shift)]))
                    yield _batch(list(zip(*rows, strict=True)), along)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = [*along[:4], ("n_match", pa.int32())]
        for batch in slices(batches):
            rows = []
            for k1, k2, item, n, start, part, data in zip(*(batch.column(k).to_pylist() for k in ("k1", "k2", "item", "n", "start", "part", "words")), strict=True):
                size, least = needed(n)
                match = best_window(np.frombuffer(part, np.uint64) == np.frombuffer(data, np.uint64)[start : start + len(part) // 8], size)
                if match >= least:
                    rows.append((k1, k2, item, n, match))
            if rows:
                yield _batch(list(zip(*rows, strict=True)), schema)

    parts = written(lines.join(found.select("k1", "k2", "words"), ["k1", "k2"]).select("k1", "k2", "lines", "words").mapInArrow(cut, "k1 long, k2 long, item binary, n int, start int, part binary"), "parts")
    checked = written(parts.join(distinct.select("item", "words"), "item").select("k1", "k2", "item", "n", "start", "part", "words").mapInArrow(verify, "k1 long, k2 long, item binary, n int, n_match int"), "checked")
    return written(checked.groupBy("k1", "k2", "item", "n").agg(F.max("n_match").alias("n_match")), "found")


def _search(docs: DataFrame, items: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(items with their ids, rows that may hold one, items in distinct texts)."""
    named = item_table(items)
    distinct = written(named.groupBy("item").agg(F.first("n").alias("n"), F.first("words").alias("words")), "distinct")
    table = seed_table(distinct)
    lengths = sorted(r.n for r in distinct.where(F.col("n") < MIN_SEEDED).select("n").distinct().collect())
    rows = texts_with_seeds(docs, table, lengths, doc_id, text)
    found = written(rows.groupBy("k1", "k2").agg(F.first("words").alias("words"), F.first("hits").alias("hits")), "texts")
    return named, rows, overlaps(distinct, table, found)


def find_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, n_match (of the best window), n_window, n_item_words: one row for each item found in a text."""
    named, rows, found = _search(docs, items, doc_id, text)
    out = rows.select("doc_id", "k1", "k2").join(found, ["k1", "k2"]).join(named.select("item_id", "item"), "item")
    return out.select("doc_id", "item_id", "n_match", F.least(F.lit(WINDOW), F.col("n")).alias("n_window"), F.col("n").alias("n_item_words"))


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs in which no item is found, with the columns of docs."""
    found = _search(docs, items, doc_id, text)[2].select("k1", "k2").distinct()
    n = found.count()
    if not n:
        return docs
    rows = docs.select(whole_row(docs).alias("row"), named(text).alias("text")).withColumns(text_keys("text"))
    return rows.join(F.broadcast(found) if n <= BROADCAST_ROWS else found, ["k1", "k2"], "left_anti").select("row.*")


ORACLE = r"""WITH d AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '\S+'), lambda x: regexp_replace(lower(x), '[^\p{L}\p{N}]', '', 'g')), lambda x: x <> '') AS w FROM documents),
    i AS (SELECT item_id, list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '\S+'), lambda x: regexp_replace(lower(x), '[^\p{L}\p{N}]', '', 'g')), lambda x: x <> '') AS w FROM benchmark),
    dw AS (SELECT doc_id, len(w) AS len, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS p FROM d),
    iw AS (SELECT item_id, len(w) AS n, least(13, len(w)) AS size, CASE WHEN len(w) < 8 THEN len(w) ELSE ceil(least(13, len(w)) * 0.8) END AS need, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS p FROM i),
    m AS (SELECT doc_id, item_id, dw.p - iw.p AS shift, n, size, need, least(n, len - (dw.p - iw.p)) - size AS last, iw.p AS p FROM dw JOIN iw ON dw.w = iw.w),
    g AS (SELECT * FROM m QUALIFY count(*) OVER (PARTITION BY doc_id, item_id, shift) >= need),
    a AS (SELECT DISTINCT doc_id, item_id, shift, size, least(p, last) AS a FROM g WHERE least(p, last) >= greatest(0, -shift)),
    c AS (SELECT a.doc_id, a.item_id, a.shift, a.a, g.n, g.size, g.need, count(*) AS n_match FROM a JOIN g ON a.doc_id = g.doc_id AND a.item_id = g.item_id AND a.shift = g.shift AND g.p BETWEEN a.a AND a.a + a.size - 1 GROUP BY ALL)
SELECT doc_id, item_id, max(n_match)::INTEGER AS n_match, size::INTEGER AS n_window, n::INTEGER AS n_item_words FROM c WHERE n_match >= need GROUP BY doc_id, item_id, size, n"""
