"""Token counts by a two-tier lookup of chunk lengths, with no shuffle of pre-tokens.

A byte-level BPE never merges across the boundary of a pre-token, and a single ASCII
space between two characters that are not white space always begins one. The unit looked
up is therefore the chunk between two such spaces: one or a few whole pre-tokens whose lengths add up.

Tier one is a compact table of the most frequent chunks of the whole corpus. It is made
by one pass in which each task counts chunks of at most HOT_CHARS characters, with at most
TASK_COUNTERS counters at a time, and hands on one row; these summaries, nothing else, are
merged FAN at a time under the same bounds until FAN are left for the driver. It has at most HOT_ENTRIES
entries, broadcast as one packed value of at most 2.3 MB at any corpus size. Tier two is a
bounded cache in each worker; what misses both is encoded by the tokenizer itself.

A space that touches other white space (another space, a line feed, a no-break space) may
not begin a pre-token, so no text is cut there; the chunk goes on to the next space that
does. Results never depend on what either tier holds.

Defined results: a null or empty text has 0 bytes and 0 tokens; a null doc_id is passed
on; repeated rows each give a row; a very long text or chunk is encoded whole and kept in no
tier; chunks of equal frequency go by their characters; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.chunks import ChunkCache, tokenizer
from corpusmill.llm.common import slices, texts, worker_state

HOT_ENTRIES = 16_384
HOT_CHARS = 32
#: Counters that a task keeps while it counts or merges, entries of the summary it hands on, and summaries merged by a task.
TASK_COUNTERS, TASK_TOP = 400_000, 16_384
FAN = 16
SLICE = 256

#: A space that begins a pre-token, whatever stands around it.
CUT = re.compile(r"(?<=\S) (?=\S)")


class Lengths:
    """Token counts of texts: the frequent tier, then this worker's cache, then the tokenizer."""

    def __init__(self, path: str, hot: dict[str, int]):
        self.tok = tokenizer(path)
        self.chunks = ChunkCache(lambda chunks: self.encoded([" " + c for c in chunks]), hot)

    def encoded(self, strings: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tok.encode_batch_fast(strings, add_special_tokens=False)]

    def counts(self, batch: list[str]) -> list[int]:
        split = [t.split(" ") for t in batch]
        touching = {c for c in set().union(*split) if not c or c[0].isspace() or c[-1].isspace()}
        if touching:
            split = [s if touching.isdisjoint(s) else CUT.split(t) for t, s in zip(batch, split, strict=True)]
        known = self.chunks.known({c for s in split for c in s[1:]})
        first = list({s[0] for s in split})
        heads = dict(zip(first, self.encoded(first), strict=True)) if first else {}
        get = known.__getitem__
        return [heads[s[0]] + sum(map(get, s[1:])) for s in split]


class Counters(Counter):
    """Counts of short strings, at most TASK_COUNTERS of them: over that, the largest quarter stays."""

    def prune(self) -> None:
        if len(self) > TASK_COUNTERS:
            least = sorted(self.values(), reverse=True)[TASK_COUNTERS // 4]
            for k in [k for k, n in self.items() if n <= least]:
                del self[k]

    def top(self) -> pa.RecordBatch:
        best = sorted(self.items(), key=lambda kv: (-kv[1], kv[0]))[:TASK_TOP]
        return pa.RecordBatch.from_arrays([pa.array([[k for k, _ in best]], pa.list_(pa.string())), pa.array([[n for _, n in best]], pa.list_(pa.int64()))], names=["chunk", "n"])


def frequent_chunks(docs: DataFrame, text: str = "text", entries: int = HOT_ENTRIES) -> list[str]:
    """The most frequent chunks of all texts. The driver gets FAN rows of TASK_TOP strings at most and merges them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counters()
        for batch in slices(batches):
            for t in texts(batch.column(0)):
                chunks = t.split(" ")[1:]
                if chunks and max(map(len, chunks)) > HOT_CHARS:
                    chunks = [c for c in chunks if len(c) <= HOT_CHARS]
                counts.update(chunks)
                counts.prune()
        if counts:
            yield counts.top()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counters()
        for batch in slices(batches, 1):
            counts.update(dict(zip(batch.column(0)[0].as_py(), batch.column(1)[0].as_py(), strict=True)))
            counts.prune()
        if counts:
            yield counts.top()

    schema = "chunk array<string>, n array<long>"
    parts = docs.select(F.col(text).alias("text")).mapInArrow(count, schema)
    n = parts.rdd.getNumPartitions()
    while n > FAN:
        n = -(-n // FAN)
        parts = parts.repartition(n).mapInArrow(merge, schema)
    total = Counters()
    for row in parts.toLocalIterator():
        total.update(dict(zip(row.chunk, row.n, strict=True)))
    return total.top().column(0)[0].as_py()[:entries]


def packed(table: dict[str, int]) -> tuple[bytes, bytes, bytes]:
    """A table of short strings and counts as three arrays: the strings' bytes, their ends, the counts."""
    keys = [k.encode() for k in table]
    return b"".join(keys), np.cumsum([len(k) for k in keys], dtype="<u4").tobytes(), np.array(list(table.values()), "<u2").tobytes()


def unpacked(table: tuple[bytes, bytes, bytes]) -> dict[str, int]:
    data, ends, counts = table[0], np.frombuffer(table[1], "<u4").tolist(), np.frombuffer(table[2], "<u2").tolist()
    return {data[i:j].decode(): n for i, j, n in zip([0, *ends], ends, counts, strict=False)}


def count_tokens(docs: DataFrame, path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row of docs, for the tokenizer file at path."""
    chunks = frequent_chunks(docs, text)
    table = dict(zip(chunks, [len(e.ids) for e in tokenizer(path).encode_batch_fast([" " + c for c in chunks], add_special_tokens=False)], strict=True)) if chunks else {}
    hot, stamp = docs.sparkSession.sparkContext.broadcast(packed(table)), uuid.uuid4().hex

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = worker_state("token_counts", (path, stamp), lambda: Lengths(path, unpacked(hot.value)))
        for part in slices(batches, SLICE):
            ns = lengths.counts(texts(part.column(1)))
            n_bytes = pc.fill_null(pc.cast(pc.binary_length(part.column(1)), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), n_bytes, pa.array(ns, pa.int64()), pa.array([n > limit for n in ns], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(lookup, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
