"""MinHash near-dedup with sequential Bayesian verification.

1. Each text gives its set of 5-word shingles as 64-bit hashes, a fingerprint of the set,
   and a signature of 128 minima. Texts with equal sets form a class, by an aggregate that
   combines before the shuffle; only its smallest doc_id goes on, so a group of copies of
   any size is one row from here.
2. Signatures are cut into 32 bands of 4, each kept as one 64-bit key; of a signature itself
   the lowest byte of each minimum stays, since that is what is compared. Classes that share a band are candidates. The pairs
   of a bucket are looked at in two rounds, and neither writes out all of them:
   a. Every class with the smallest one of each of its buckets. What passes is verified on
      the full sets; the links give components, which join near all of a group of copies.
   b. In buckets that still hold two components, every member that is not of the bucket's
      largest component with all members of other components. Members with a pair that
      passes are compared again with their full sets; there, members that a task has linked
      need no further comparison, so it gives a spanning forest of its links.
3. Signatures of a pair are compared in batches of 16; it is dropped once the posterior
   probability that its similarity reaches the threshold, given the agreements so far and a
   uniform prior, is below MISS (bytes agree a little more often than minima, which can only
   keep a pair). What survives is verified exactly.
4. Components of the verified links.

Both rounds deal a bucket's comparisons as a grid of bounded blocks, so that a bucket of any
size is split among tasks; a task holds one block and reads the other by it. Signatures go
there first, full sets only for what passed. A pair that shares a band is thus either joined
by verified links of round a, or compared in round b. A pair at the threshold shares no band
with probability (1 - 0.75**4)**32 = 5e-6.

Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased. A text of one to
four words is one shingle. Defined results: a null, empty or blank text has no shingles and
is linked with nothing; a row with a null doc_id has a null component and is kept; repeated
rows each give a row, and rows with the same doc_id are one node with the links of all its
texts; a very long text is read whole; ties go to the smaller doc_id; an empty table gives
an empty result; other columns are not read, and one_of_each() passes them on inside a
struct, where their names clash with nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import named, shuffle_partitions, slices, whole_row, worker_state, written
from corpusmill.llm.components import components

WORDS, PERCENT = 5, 75
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
BATCH, MISS = 16, 1e-6
#: A block of a bucket: members, and shingles of all its members, on average; a bucket has BLOCKS blocks of one
#: kind until a block would have more than BLOCK_MOST members, so that large buckets send each member not too often.
BLOCK_MEMBERS, BLOCKS, BLOCK_MOST, BLOCK_SHINGLES = 256, 64, 8192, 1 << 20
CACHE_WORDS = 300_000

_draw = np.random.default_rng(20_240_601)
A = (_draw.integers(0, 1 << 32, HASHES, np.uint64) | np.uint64(1)).astype(np.uint32)
B = _draw.integers(0, 1 << 32, HASHES, np.uint64).astype(np.uint32)
BAND_SALT = _draw.integers(0, 1 << 63, (ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
SHINGLE_SALT = _draw.integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; emptied when it is over its bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = worker_state("near_dedup", None, WordHashes)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    k = min(WORDS, len(words))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out += h[i : i + len(out)] * SHINGLE_SALT[i]
    return np.unique(mix(out))


def signature(found: np.ndarray) -> np.ndarray:
    """The minima of HASHES permutations of the shingles' upper 32 bits."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(out, (x[i : i + 1024, None] * A + B).min(axis=0), out=out)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A key of each band of each signature, as signed 64-bit integers."""
    with np.errstate(over="ignore"):
        parts = signatures.astype(np.uint64).reshape(len(signatures), BANDS, ROWS)
        keys = (parts @ BAND_SALT)[:, :, 0] + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(keys).view(np.int64)


def bound_table(percent: int = PERCENT, miss: float = MISS) -> list[int]:
    """For n = BATCH, 2 * BATCH ...: the fewest agreements of n at which a pair stays.

    With a uniform prior the posterior after m of n agreements is Beta(m + 1, n - m + 1),
    and its mass above t is P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        mass, m = 0.0, -1
        while mass < miss:
            m += 1
            mass += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets reach the similarity."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def passing(one: np.ndarray, others: np.ndarray, bounds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Which of the other signatures stay beside one, batch by batch, and in how many places they agree."""
    left, agree = np.arange(len(others)), np.zeros(len(others), np.int32)
    for k, bound in enumerate(bounds):
        if not len(left):
            break
        part = slice(k * BATCH, (k + 1) * BATCH)
        agree += (others[left, part] == one[part]).sum(axis=1, dtype=np.int32)
        stay = agree >= bound
        left, agree = left[stay], agree[stay]
    return left, agree


class Members:
    """Some members of a bucket: node, label (component so far), minor, size, sig, and sets if they are there."""

    def __init__(self, batch: pa.RecordBatch):
        self.node, self.label, self.n = (batch.column(k).to_numpy() for k in ("node", "label", "n"))
        self.minor = batch.column("minor").to_numpy(zero_copy_only=False)
        self.sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
        self.sets = [np.frombuffer(x, np.uint64) for x in batch.column("members").to_pylist()] if "members" in batch.schema.names else None

    def add(self, other: Members) -> None:
        for k in ("node", "label", "n", "minor", "sig"):
            setattr(self, k, np.concatenate([getattr(self, k), getattr(other, k)]))
        if self.sets is not None:
            self.sets += other.sets


def survivors(left: Members, right: Members, bounds: list[int], percent: int) -> list[tuple[int, int]]:
    """(place in left, place in right) of the pairs of different labels that pass, those that agree most first.

    left are minor members; of a pair of minor ones the smaller node is taken on the left.
    """
    out = []
    if len(left.node) <= len(right.node):
        for i in range(len(left.node)):
            test = (right.label != left.label[i]) & (~right.minor | (right.node > left.node[i])) & (100 * np.minimum(right.n, left.n[i]) >= percent * np.maximum(right.n, left.n[i]))
            at = np.flatnonzero(test)
            found, agree = passing(left.sig[i], right.sig[at], bounds)
            out += zip((-agree).tolist(), [i] * len(found), at[found].tolist(), strict=True)
    else:
        for j in range(len(right.node)):
            test = (left.label != right.label[j]) & (100 * np.minimum(left.n, right.n[j]) >= percent * np.maximum(left.n, right.n[j]))
            if right.minor[j]:
                test &= left.node < right.node[j]
            at = np.flatnonzero(test)
            found, agree = passing(right.sig[j], left.sig[at], bounds)
            out += zip((-agree).tolist(), at[found].tolist(), [j] * len(found), strict=True)
    return [(i, j) for _, i, j in sorted(out)]


class Labels(dict):
    """Labels that links have joined, as a task knows them."""

    def root(self, x: int) -> int:
        while x in self:
            x = self[x]
        return x


def fingerprint(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def signed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, print (of the set), bands (the keys), sig (lowest bytes) of every row; the last three null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(t or "") for t in batch.column(1).to_pylist()]
            full = [signature(f) for f in found if len(f)]
            keys, low = iter(band_keys(np.stack(full)) if full else ()), iter(full)
            columns = [
                (pa.int64(), [len(f) for f in found]),
                (pa.binary(), [fingerprint(f) if len(f) else None for f in found]),
                (pa.binary(), [next(keys).tobytes() if len(f) else None for f in found]),
                (pa.binary(), [next(low).astype(np.uint8).tobytes() if len(f) else None for f in found]),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for k, c in columns)], names=["doc_id", "n_shingles", "print", "bands", "sig"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, print binary, bands binary, sig binary")


def banded(classes: DataFrame) -> DataFrame:
    """key, node: one row for each band of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], names=["key", "node"])

    return classes.select("node", "bands").mapInArrow(run, "key long, node long")


def blocks_of(n: Column) -> Column:
    """The number of blocks of n members."""
    return F.least(F.ceil(n / BLOCK_MEMBERS), F.greatest(F.lit(BLOCKS), F.ceil(n / BLOCK_MOST)))


def compared(lefts: DataFrame, rights: DataFrame, payload: DataFrame, percent: int, what: str) -> DataFrame:
    """The comparisons of the left and right members (g, node, label, minor, n) of each g, as a grid of blocks.

    payload: node, sig and, for what = 'links', members. Gives g, u, v: for 'pairs' those that
    pass by signature, for 'flags' the members (u, v is null) that have such a pair, for
    'links' verified ones that span what each task has found to be linked.
    """
    both = written(lefts.withColumn("side", F.lit(0)).unionByName(rights.withColumn("side", F.lit(1))), "sides")
    shares = lambda side: F.greatest(F.lit(1), blocks_of(F.count_if(F.col("side") == side)), F.ceil(F.sum(F.when(F.col("side") == side, F.col("n")).otherwise(0)) / BLOCK_SHINGLES) if what == "links" else F.lit(1)).cast("int")
    # written, so that the join isn't tied to the aggregate and can split a hot bucket
    grid = written(both.groupBy("g").agg(shares(0).alias("rows"), shares(1).alias("columns")), "grid")
    dealt = both.join(grid, "g")
    own = F.when(F.col("side") == 0, F.col("rows")).otherwise(F.col("columns"))
    other = F.when(F.col("side") == 0, F.col("columns")).otherwise(F.col("rows"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), own).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), other - 1)))
    dealt = dealt.withColumns({"i": F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("other")), "j": F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("own"))})
    names = ["g", "i", "j", "side", "node", "label", "minor", "n", "sig"] + ["members"] * (what == "links")
    tasks = dealt.select(*names[:8]).join(payload, "node").select(*names)
    bounds = bound_table(percent)

    def found(left: Members, right: Members, g: int, labels: Labels) -> list[tuple[int, int, int | None]]:
        pairs = survivors(left, right, bounds, percent)
        if what == "pairs":
            return [(g, int(right.node[j]), int(left.node[i])) for i, j in pairs]
        if what == "flags":
            return [(g, x, None) for x in sorted({int(left.node[i]) for i, _ in pairs} | {int(right.node[j]) for _, j in pairs})]
        out = []
        for i, j in pairs:
            a, b = labels.root(int(left.label[i])), labels.root(int(right.label[j]))
            if a != b and linked(left.sets[i], right.sets[j], percent):
                labels[a] = b
                out.append((g, int(right.node[j]), int(left.node[i])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = left = None
        labels = Labels()
        for batch in slices(batches, 256):
            at = np.stack([batch.column(k).to_numpy() for k in ("g", "i", "j", "side")])
            cuts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            out = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                g, i, j, side = at[:, a].tolist()
                if (g, i, j) != key:
                    key, left, labels = (g, i, j), None, Labels()
                if side and left is None:
                    continue
                some = Members(batch.slice(a, b - a))
                if side:
                    out += found(left, some, g, labels)
                elif left is None:
                    left = some
                else:
                    left.add(some)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["g", "u", "v"])

    tasks = tasks.repartition(shuffle_partitions(both.sparkSession), "g", "i", "j").sortWithinPartitions("g", "i", "j", "side", "node")
    return tasks.mapInArrow(run, "g long, u long, v long")


def sets_of(docs: DataFrame, classes: DataFrame, nodes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """node, sig, members (the full set) of the given nodes (node, distinct), in a written table."""
    wanted = classes.join(nodes, "node").select("doc", "node", "print", "sig")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).join(wanted, "doc").select("node", "print", "sig", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found = [shingles(t or "") for t in batch.column(3).to_pylist()]
            # a doc_id may have several texts, and each class one of them
            own = pa.array([fingerprint(s) == p for s, p in zip(found, batch.column(1).to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([s.tobytes() for s in found], pa.binary())], names=["node", "sig", "members"]).filter(own)

    return written(rows.mapInArrow(run, "node long, sig binary, members binary"), "sets")


def verified_links(docs: DataFrame, classes: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """u, v: verified links that span the components of the classes (node, doc, print, n, bands, sig)."""
    bands = banded(classes)
    heads = written(bands.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1").select("key", "head"), "heads")
    members = written(bands.join(heads, "key").select("key", "node", "head"), "members")
    signatures, sizes = classes.select("node", "sig"), classes.select("node", "n")

    def sides(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pairs (u, v) as left members v, each its own g, and right members u."""
        as_member = lambda g, node: pairs.select(F.col(g).alias("g"), F.col(node).alias("node")).distinct().join(sizes, "node").select("g", "node", F.col("node").alias("label"), F.lit(False).alias("minor"), "n")
        return as_member("v", "v"), as_member("v", "u")

    stars = written(members.where("node <> head").select(F.col("node").alias("u"), F.col("head").alias("v")).distinct(), "stars")
    if stars.isEmpty():
        return stars
    near = written(compared(*sides(stars), signatures, percent, "pairs").select("u", "v"), "near")
    sets = sets_of(docs, classes, near.select(F.col("u").alias("node")).union(near.select("v")).distinct(), doc_id, text)
    first = written(compared(*sides(near), sets, percent, "links").select("u", "v"), "links")

    label = components(first)
    own = members.select("key", "node").join(label, "node", "left").select("key", "node", F.coalesce("component", "node").alias("label"))
    counts = own.groupBy("key", "label").agg(F.count("*").alias("c"))
    split = written(counts.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("major"), F.count("*").alias("labels")).where("labels > 1").select(F.col("key").alias("g"), "major"), "split")
    if split.isEmpty():
        return first
    left = own.withColumnRenamed("key", "g").join(split, "g").join(sizes, "node")
    left = written(left.select("g", "node", "label", (F.col("label") != F.col("major")).alias("minor"), "n"), "left")
    flags = written(compared(left.where("minor"), left, signatures, percent, "flags").select("g", F.col("u").alias("node")).distinct(), "flags")
    if flags.isEmpty():
        return first
    again = written(left.join(flags, ["g", "node"], "left_semi"), "again")
    sets = sets_of(docs, classes, again.select("node").distinct(), doc_id, text)
    return first.union(written(compared(again.where("minor"), again, sets, percent, "links").select("u", "v"), "links"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of docs."""
    rows = written(signed(docs, doc_id, text), "signatures")
    full = rows.where("doc_id is not null and n_shingles > 0")
    # the number of a class is fixed as soon as the table is written; a doc_id with several texts is in several classes
    of_print = full.groupBy("print").agg(F.min("doc_id").alias("doc"), F.first("bands").alias("bands"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n"))
    classes = written(of_print.select(F.monotonically_increasing_id().alias("node"), "doc", "print", "n", "bands", "sig"), "classes")
    links = written(verified_links(docs, classes, percent, doc_id, text), "links")
    one = lambda side: classes.select(F.col("node").alias(side), F.col("doc").alias(f"{side}_doc"))
    between = links.join(one("u"), "u").join(one("v"), "v").select(F.col("u_doc").alias("u"), F.col("v_doc").alias("v"))
    own = full.join(classes.select("print", "doc"), "print").where("doc_id <> doc").select(F.col("doc_id").alias("u"), F.col("doc").alias("v"))
    found = components(between.union(own))
    out = rows.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that are the smallest doc_id of their component, once each, with the columns of docs.

    Repeated rows of one doc_id count as copies: one of them stays, that with the smallest
    text, and of equal texts that whose columns, as JSON, come first. Rows with a null doc_id stay.
    """
    found = near_duplicates(docs, percent, doc_id, text)
    rows = docs.select(named(doc_id).cast("long").alias("id"), F.coalesce(named(text), F.lit("")).alias("text"), whole_row(docs).alias("row"))
    left = rows.join(found.where("not kept").select(F.col("doc_id").alias("id")).distinct(), "id", "left_anti")
    again = found.where("doc_id is not null and kept").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("id"))
    if again.isEmpty():
        return left.select("row.*")
    twice = written(again, "twice")
    chosen = left.join(twice, "id", "left_semi").groupBy("id").agg(F.min_by("row", F.struct("text", F.to_json("row"))).alias("row"))
    return left.join(twice, "id", "left_anti").select("row.*").unionByName(chosen.select("row.*"))


ORACLE = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
    e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
    reach(doc_id, other) AS (SELECT doc_id, doc_id FROM w UNION SELECT reach.doc_id, e.b FROM reach JOIN e ON reach.other = e.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(other)::BIGINT AS component_id, w.doc_id = min(other) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN reach ON reach.doc_id = w.doc_id GROUP BY w.doc_id"""
