"""The highest-scoring documents of each item, by windows over postings in the order of doc_id.

Documents become postings of the items' terms in one pass, and are dealt out by ranges of
doc_id. A task reads its range in fixed windows of WINDOW documents in ascending doc_id. The
postings of a window are sorted by term; for each item the contributions of its terms are
added up in one array of the window's size, which a processor's cache holds, a bit set tells
which documents were met, and what reaches the item's worst kept score goes into its heap of
ten. The heaps of all tasks meet in a ranking of ten rows a task.

Counts come first: how many documents and terms there are, and in how many documents each of
the items' terms stands. Items go in blocks of at most BLOCK_TERMS terms, so that what a task
is told is bounded; each block reads the documents once.

Results: rows that share an item_id are one item with the terms of all (identical rows add
nothing), a null item_id among them. A null or empty text has no terms, an item without terms
no rows. Each row of documents is ranked for itself, also those that repeat a doc_id or have
none; equal scores are in ascending doc_id, null last. The terms of a single text, and the
distinct terms of a single item, must fit a task. Only the named columns are read. Empty
tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import slices, texts, written

K = 10
#: Documents of a window: its scores take 64 KB. Terms of a block of items, at most (one item's at least).
WINDOW, BLOCK_TERMS = 8192, 200_000
#: Fixed values of the score.
WEIGHT, UNIT, SATURATION, LENGTH_PART = 1000, 1_000_000_000, 8, 90
#: A-Z become a-z; letters, digits and all bytes of other characters stay; the rest is white space.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TERMS).split()


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term (binary), each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found = [sorted(set(terms(t))) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])

    kind = dict(items.select("item_id").dtypes)["item_id"]
    rows = items.select("item_id", F.col("text").alias("text")).mapInArrow(run, f"item_id {kind}, terms array<binary>")
    return rows.select("item_id", F.explode("terms").alias("term")).distinct()


def blocks(items: DataFrame, most: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items with their terms, in blocks of at most `most` terms. The driver has one block at a time."""
    found = items.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")).orderBy("item_id")
    block, size = [], 0
    for r in found.toLocalIterator():
        if block and size + len(r.terms) > most:
            yield block
            block, size = [], 0
        block.append((r.item_id, [bytes(t) for t in r.terms]))
        size += len(r.terms)
    if block:
        yield block


def postings(docs: DataFrame, asked: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), terms (numbers of asked ones) and tfs of every document that has a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, sizes, counts = [], [], []
            for k, text in enumerate(texts(batch.column(1))):
                found = terms(text)
                if found:
                    ids.append(k)
                    sizes.append(len(found))
                    counts.append([(asked[t], c) for t, c in Counter(found).items() if t in asked])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(sizes, pa.int64()), pa.array([[t for t, _ in c] for c in counts], pa.list_(pa.int32())), pa.array([[n for _, n in c] for c in counts], pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<bigint>")


class WindowScores:
    """The documents of one window: their postings by term, and a score array for one item at a time."""

    def __init__(self, ids: list, sizes: np.ndarray, counts: np.ndarray, numbers: np.ndarray, tfs: np.ndarray, weights: np.ndarray, n_docs: int, n_all: int):
        m = 100 - LENGTH_PART + (LENGTH_PART * sizes * n_docs) // n_all
        slot = np.repeat(np.arange(len(ids)), counts)
        order = np.argsort(numbers, kind="stable")
        self.ids, self.terms, self.slots = ids, numbers[order], slot[order]
        tf = tfs[order]
        self.adds = weights[self.terms] * ((UNIT * tf) // (1000 * tf + SATURATION * m[self.slots]))
        self.there, starts = np.unique(self.terms, return_index=True)
        self.starts = np.append(starts, len(self.terms))
        self.scores, self.met = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)

    def harvest(self, own: np.ndarray, heap: list, k: int) -> None:
        """Adds the item's terms up, and takes what is good enough into its heap of (score, later is worse, doc_id)."""
        at = np.searchsorted(self.there, own)
        hit = at[(at < len(self.there)) & (self.there[np.minimum(at, len(self.there) - 1)] == own)] if len(self.there) else at[:0]
        if not len(hit):
            return
        for t in hit:
            a, b = self.starts[t], self.starts[t + 1]
            slots = self.slots[a:b]
            self.scores[slots] += self.adds[a:b]
            self.met[slots] = True
        found = np.flatnonzero(self.met)
        got = self.scores[found]
        self.scores[found], self.met[found] = 0, False
        worst = max(heap[0][0] if len(heap) == k else 0, np.partition(got, len(got) - k)[len(got) - k] - 1 if len(got) > k else 0)
        good = found[got > worst], got[got > worst]
        # equal scores are taken by ascending doc_id, which is the order of the slots
        for slot, score in sorted(zip(*(g.tolist() for g in good), strict=True), key=lambda x: (-x[1], x[0])):
            doc = self.ids[slot]
            entry = (score, -math.inf if doc is None else -doc)
            if len(heap) < k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            else:
                break


def best_of(ranged: DataFrame, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_all: int, k: int) -> DataFrame:
    """item (its place in the block), doc_id, score: the k best of each item in each task."""
    told = ranged.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, weight = told.value
        heaps: list[list] = [[] for _ in own]

        def score(window: pa.Table) -> None:
            numbers, tfs = window.column("terms").combine_chunks(), window.column("tfs").combine_chunks()
            counts = np.diff(numbers.offsets.to_numpy()) if len(numbers) else np.empty(0, np.int64)
            w = WindowScores(window.column("doc_id").to_pylist(), window.column("n").to_numpy(), counts, numbers.flatten().to_numpy(), tfs.flatten().to_numpy(), weight, n_docs, n_all)
            for terms_of, heap in zip(own, heaps, strict=True):
                w.harvest(terms_of, heap, k)

        held, rows = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, WINDOW - rows)
                held.append(part)
                rows, at = rows + part.num_rows, at + part.num_rows
                if rows == WINDOW:
                    score(pa.Table.from_batches(held))
                    held, rows = [], 0
        if held:
            score(pa.Table.from_batches(held))
        kept = [(n, None if d == -math.inf else -d, s) for n, heap in enumerate(heaps) for s, d in heap]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in kept], pa.int32()), pa.array([x[1] for x in kept], pa.int64()), pa.array([x[2] for x in kept], pa.int64())], names=["item", "doc_id", "score"])

    return ranged.mapInArrow(run, "item int, doc_id long, score long")


def rank_block(spark: SparkSession, docs: DataFrame, block: list[tuple[object, list[bytes]]], kind: str, k: int) -> DataFrame:
    asked = {t: n for n, t in enumerate(sorted({t for _, own in block for t in own}))}
    found = written(postings(docs, asked), "postings")
    totals = found.agg(F.count("*").alias("n"), F.sum("n").alias("all")).first()
    df = np.zeros(len(asked))
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        df[r.t] = r["count"]
    weights = np.array([math.floor(WEIGHT * math.log((2 * totals.n + 2) / (2 * x + 1))) for x in df], np.int64)
    items = [np.array([asked[t] for t in own], np.int64) for _, own in block]
    # copies of a doc_id and null ones are spread by the size and the terms, where those differ
    ranged = found.repartitionByRange(F.col("doc_id").asc_nulls_last(), "n", F.xxhash64("terms", "tfs"), F.monotonically_increasing_id()).sortWithinPartitions(F.col("doc_id").asc_nulls_last())
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = best_of(ranged, items, weights, totals.n, totals["all"] or 1, k).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], f"item int, item_id {kind}")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of each item, scores above 0 only."""
    spark, kind = docs.sparkSession, dict(items.select("item_id").dtypes)["item_id"]
    found = [rank_block(spark, docs, b, kind, k) for b in blocks(written(item_terms(items), "item_terms"), block_terms)]
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionAll(more)
    return whole


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_MATCH = r"'[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+'"

ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_MATCH}) AS t FROM documents),
s AS (SELECT count(*)::BIGINT AS n, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, {_MATCH})) AS t FROM benchmark),
p AS (SELECT r, doc_id, len(t)::BIGINT AS size, unnest(t) AS t FROM d),
c AS (SELECT r, doc_id, size, t, count(*)::BIGINT AS tf FROM p WHERE t IN (SELECT t FROM i) GROUP BY ALL),
w AS (SELECT t, floor({WEIGHT} * ln((2 * any_value(n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM c, s GROUP BY t),
x AS (SELECT item_id, r, doc_id, sum(w * (({UNIT} * tf) // (1000 * tf + {SATURATION} * ({100 - LENGTH_PART} + ({LENGTH_PART} * size * n) // l))))::BIGINT AS score FROM i JOIN c USING (t) JOIN w USING (t), s GROUP BY item_id, r, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM x WHERE score > 0 QUALIFY rank <= {K}"""
