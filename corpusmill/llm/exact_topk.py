"""Exact top-k search by inner product: a Voronoi join of queries and data over pivots.

Vectors become integers, floor(256 * x). Queries are distinct vectors, dealt to the Voronoi
cells of pivots drawn from them. Of each cell two summaries go to the driver: of its queries
the radius and the largest norm, of the data nearest to its pivot how many there are and the
smallest distances. From these alone follows, for each cell of queries, a score that k rows
are sure to reach (the bound), and a data row is sent to a group of neighbouring cells only if
    pivot . row + radius * |row| >= bound
for one of them: the left side is the most that the row can score there. Groups hold
GROUP queries at most; their data are dealt out by salts, so that no task holds a group
whole, and each task streams its data past its queries in slices and keeps the best of each.

A vector that very many rows have is one query, and stands for as many candidates as can be
among the best (k + 1, the own row being none); nothing else is left out. Data without
structure leave the bounds wide: then every row goes to every group, which is a join in blocks.

Results: vectors that are null or hold a null or a non-finite component take no part, nor do
those whose squared norm reaches 2^62, as their scores need more than 64 bits. Of vectors of
unequal length the missing components count as 0. Equal scores are in ascending vec_id, a
null vec_id last (it is a candidate, and no query). Rows that repeat a vec_id are rows of
their own: each is a query where its id says so, with five results, and a candidate to the
other. Only the named columns are read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import written

K, QUERY_STEP, SCALE = 5, 50, 256
#: Pivots: one for so many queries, within these bounds. Queries of a group, at most on average; rows of a salt of its data.
QUERIES_A_PIVOT, MOST_PIVOTS, GROUP, SALT_ROWS = 64, 256, 2048, 50_000
#: Rows that are scored at a time.
SLICE = 2048
_KINDS = ("<i2", "<i4")


def packed(vector: np.ndarray) -> bytes | None:
    """The integers of a vector in the smaller of two widths that holds them, which the first byte says; equal vectors give equal bytes."""
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * vector)
        if not np.isfinite(scaled).all() or float((scaled * scaled).sum()) >= 2.0**62:
            return None
    most = max(scaled.max(initial=0), -1 - scaled.min(initial=0))
    kind = 0 if most < 1 << 15 else 1  # the norm leaves no larger ones
    return bytes([kind]) + scaled.astype(_KINDS[kind]).tobytes()


def unpacked(rows: list[bytes], width: int = 0) -> np.ndarray:
    """The vectors as int64 rows of equal width, at least `width`."""
    found = [np.frombuffer(r, _KINDS[r[0]], offset=1) for r in rows]
    out = np.zeros((len(found), max([width, *map(len, found)])), np.int64)
    for k, v in enumerate(found):
        out[k, : len(v)] = v
    return out


def padded(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1]))) if matrix.shape[1] < width else matrix


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows: in doubles where all sums are exact there, else in 64-bit integers."""
    width = max(a.shape[1], b.shape[1])
    a, b = padded(a, width), padded(b, width)
    norms = [float((x.astype(float) ** 2).sum(axis=1).max(initial=0)) for x in (a, b)]
    if norms[0] * norms[1] < 2.0**104:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def rows_of(embeddings: DataFrame) -> DataFrame:
    """vec_id, vec (packed) of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            vectors = []
            for k in range(batch.num_rows):
                values = lists[k].values if lists[k].is_valid else None
                vectors.append(None if values is None or values.null_count else packed(values.to_numpy(zero_copy_only=False).astype(float)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.binary())], names=["vec_id", "vec"])

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, vec binary").where("vec is not null")


class Pivots:
    """The pivots, and what is known of the cells of queries and of data around them."""

    def __init__(self, vectors: list[bytes]):
        self.at = unpacked(vectors)
        self.squares = (self.at.astype(float) ** 2).sum(axis=1)

    def near(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each vector: the nearest pivot, the distance to it (rounded up), and the inner products with all."""
        dots = products(vectors, self.at).astype(float)
        squares = (vectors.astype(float) ** 2).sum(axis=1)
        apart = np.maximum(squares[:, None] + self.squares[None, :] - 2 * dots, 0)
        cell = apart.argmin(axis=1)
        return cell, np.sqrt(apart[np.arange(len(cell)), cell]) * (1 + 1e-9) + 1e-6, dots

    def bounds(self, radius: np.ndarray, norm: np.ndarray, data: dict[int, list[float]], k: int) -> np.ndarray:
        """For each cell of queries a score that k rows reach at least, whatever query of the cell asks.

        A row at distance t from pivot p scores q.p - |q| t at least, and q.p is the cell's own
        pivot's product less radius * |p| at least.
        """
        own = products(self.at, self.at).astype(float) - radius[:, None] * np.sqrt(self.squares)[None, :]
        sure = [own[:, p] - norm * t for p, found in data.items() for t in found]
        if len(sure) < k:
            return np.full(len(radius), -np.inf)
        bound = np.sort(np.array(sure), axis=0)[-k]
        return bound - 1e-6 * (1 + np.abs(bound))


def cell_summary(vectors: DataFrame, pivots: Pivots, keep: int) -> list:
    """pivot, n, norm, radius, and the `keep` smallest distances of the cell: a few numbers a task and cell, then a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = unpacked(batch.column(0).slice(at, SLICE).to_pylist())
                cell, apart, _ = pivots.near(rows)
                norms = np.sqrt((rows.astype(float) ** 2).sum(axis=1)) * (1 + 1e-9)
                for c in np.unique(cell):
                    of = cell == c
                    n, norm, radius, least = found.get(int(c), (0, 0.0, 0.0, []))
                    found[int(c)] = (n + int(of.sum()), max(norm, float(norms[of].max())), max(radius, float(apart[of].max())), sorted([*least, *np.sort(apart[of])[:keep].tolist()])[:keep])
        yield pa.RecordBatch.from_pylist([{"pivot": c, "n": v[0], "norm": v[1], "radius": v[2], "least": v[3]} for c, v in found.items()], schema=pa.schema([("pivot", pa.int32()), ("n", pa.int64()), ("norm", pa.float64()), ("radius", pa.float64()), ("least", pa.list_(pa.float64()))]))

    each = vectors.select("vec").mapInArrow(run, "pivot int, n long, norm double, radius double, least array<double>")
    least = F.slice(F.array_sort(F.flatten(F.collect_list("least"))), 1, keep)
    return each.groupBy("pivot").agg(F.sum("n").alias("n"), F.max("norm").alias("norm"), F.max("radius").alias("radius"), least.alias("least")).collect()


def grouped(cells: list, pivots: Pivots, size: int) -> tuple[dict[int, int], dict[int, int]]:
    """The group of each cell of queries, neighbours together, and into how many parts a group's queries are cut.

    Cells are taken nearest first, starting from the fullest; a cell that is larger than a
    group is a group of its own, cut by a hash of its vectors.
    """
    left, group, parts, n = {c.pivot: c.n for c in cells}, {}, {}, 0
    while left:
        start = max(left, key=lambda p: (left[p], -p))
        apart = pivots.squares - 2 * products(pivots.at[[start]], pivots.at)[0]
        filled = 0
        for p in sorted(left, key=lambda p: (p != start, apart[p], p)):
            if filled and filled + left[p] > size:
                break
            group[p], filled = n, filled + left.pop(p)
        parts[n] = -(-filled // size)
        n += 1
    return group, parts


def best(scores: np.ndarray, rows: tuple[np.ndarray, ...], held: list, keep: int) -> list:
    """held with the slice's rows taken in: of each query the `keep` best (score, vec_id is null, vec_id, rid) as arrays, best first."""
    k = min(keep, scores.shape[1])
    if not k:
        return held
    least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    worst = np.array([h[0][-1] if len(h[0]) == keep else np.iinfo(np.int64).min for h in held])
    query, row = np.nonzero(scores >= np.maximum(least, worst)[:, None])
    for q in np.unique(query):
        at = row[np.searchsorted(query, q) : np.searchsorted(query, q, "right")]
        new = [np.concatenate([old, part]) for old, part in zip(held[q], (scores[q, at], *(r[at] for r in rows)), strict=True)]
        order = np.lexsort((new[3], new[2], new[1], -new[0]))[:keep]
        held[q] = [x[order] for x in new]
    return held


def solved(sent: DataFrame, keep: int) -> DataFrame:
    """qid, vec_id, rid, score: of each query the `keep` best of what its task has seen.

    sent holds group, salt, qid (null for data), vec_id, rid, vec; a task's rows are sorted, so
    that a group's queries come before its data.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, qids, queries, matrix, held = None, [], [], None, []

        def done() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(qids), 256):
                some = held[at : at + 256]
                sizes = [len(h[0]) for h in some]
                if sum(sizes):
                    score, no_id, vec_id, rid = (np.concatenate([h[c] for h in some]) for c in range(4))
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qids[at : at + 256], sizes)), pa.array(vec_id, mask=no_id.astype(bool)), pa.array(rid), pa.array(score)], names=["qid", "vec_id", "rid", "score"])

        for batch in batches:
            keys = list(zip(batch.column("group").to_pylist(), batch.column("salt").to_pylist(), strict=True))
            asks = batch.column("qid").is_valid().to_pylist()
            at = 0
            while at < len(keys):
                end = at + 1
                while end < len(keys) and keys[end] == keys[at] and asks[end] == asks[at] and (asks[at] or end - at < SLICE):
                    end += 1
                if keys[at] != key:
                    yield from done()
                    key, qids, queries, matrix, held = keys[at], [], [], None, []
                part = batch.slice(at, end - at)
                if asks[at]:
                    qids += part.column("qid").to_pylist()
                    queries += part.column("vec").to_pylist()
                elif qids:
                    if matrix is None:
                        matrix, held = unpacked(queries), [[np.empty(0, np.int64)] * 4 for _ in qids]
                    ids = part.column("vec_id")
                    rows = (np.array(ids.is_null().to_pylist(), np.int64), ids.fill_null(0).to_numpy(), part.column("rid").to_numpy())
                    held = best(products(matrix, unpacked(part.column("vec").to_pylist())), rows, held, keep)
                at = end
        yield from done() if held else ()

    return sent.mapInArrow(run, "qid long, vec_id long, rid long, score long")


def top_k(embeddings: DataFrame, k: int = K, step: int = QUERY_STEP, group: int = GROUP, salt_rows: int = SALT_ROWS, a_pivot: int = QUERIES_A_PIVOT) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest inner product for each row whose vec_id is divisible by step."""
    rows = written(rows_of(embeddings).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    tie = [F.col("vec_id").asc_nulls_last(), F.col("rid")]
    # copies beyond the k + 1 first of a vector are among the best of no query
    data = written(rows.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy(*tie))).where(F.col("n") <= k + 1).drop("n"), "candidates")
    asking = rows.where(F.col("vec_id") % step == 0)
    queries = written(asking.groupBy("vec").agg(F.min("rid").alias("qid")), "queries")
    n = queries.count()
    chosen = [r.vec for r in queries.orderBy(F.xxhash64("vec"), "vec").limit(min(MOST_PIVOTS, max(1, n // a_pivot))).collect()]
    result = "query_id long, rank int, vec_id long, score long"
    if not chosen:
        return rows.sparkSession.createDataFrame([], result)
    pivots = Pivots(chosen)
    cells, around = cell_summary(queries, pivots, 1), cell_summary(data, pivots, k + 1)
    radius, norm = np.zeros(len(chosen)), np.zeros(len(chosen))
    for c in cells:
        radius[c.pivot], norm[c.pivot] = c.radius, c.norm
    bound = pivots.bounds(radius, norm, {c.pivot: c.least for c in around}, k + 1)
    of_cell, parts = grouped(cells, pivots, group)
    starts, n_salts = dict(zip(parts, np.concatenate([[0], np.cumsum(list(parts.values()))]).tolist(), strict=False)), max(1, -(-sum(c.n for c in around) // salt_rows))
    members: dict[int, np.ndarray] = {g: np.array([p for p, x in of_cell.items() if x == g]) for g in parts}

    def place_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                cell, _, _ = pivots.near(unpacked(some.column("vec").to_pylist()))
                place = [starts[of_cell[c]] + h % parts[of_cell[c]] for c, h in zip(cell.tolist(), some.column("h").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), some.column("qid"), some.column("vec")], names=["group", "qid", "vec"])

    def place_data(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                some = batch.slice(at, SLICE)
                vectors = unpacked(some.column("vec").to_pylist())
                _, _, dots = pivots.near(vectors)
                norms = np.sqrt((vectors.astype(float) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-6
                may = dots + radius[None, :] * norms[:, None] + 1e-6 * (1 + np.abs(dots)) >= bound[None, :]
                for g, own in members.items():
                    to = pa.array(np.flatnonzero(may[:, own].any(axis=1)))
                    if len(to):
                        sent = some.take(to)
                        for part in range(parts[g]):
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(to), starts[g] + part, np.int32)), *sent.columns], names=["group", *sent.schema.names])

    salt = F.pmod(F.xxhash64("rid"), F.lit(n_salts)).cast("int")
    asked = queries.select("qid", "vec", F.pmod(F.xxhash64("vec"), F.lit(1 << 30)).alias("h")).mapInArrow(place_queries, "group int, qid long, vec binary")
    asked = asked.select("group", F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1))).alias("salt"), "qid", F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("long").alias("rid"), "vec")
    given = data.select("vec_id", "rid", "vec").mapInArrow(place_data, "group int, vec_id long, rid long, vec binary").select("group", salt.alias("salt"), F.lit(None).cast("long").alias("qid"), "vec_id", "rid", "vec")
    sent = asked.unionAll(given).repartition("group", "salt").sortWithinPartitions("group", "salt", F.col("qid").asc_nulls_last())
    first = Window.partitionBy("qid").orderBy(F.desc("score"), *tie)
    found = solved(sent, k + 1).withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1).drop("nth")
    # the queries' own rows: a vector that many of them share is asked for once, and each leaves itself out
    own = asking.join(queries, "vec").select("qid", F.col("vec_id").alias("query_id"), F.col("rid").alias("own"))
    pairs = own.join(found, "qid").where("own <> rid")
    place = F.row_number().over(Window.partitionBy("own").orderBy(F.desc("score"), *tie))
    return pairs.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
WITH d AS (SELECT vec_id, rowid AS r, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM (SELECT *, row_number() OVER () AS rowid FROM embeddings)
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.r, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score FROM d q JOIN d ON q.r <> d.r WHERE q.vec_id % {QUERY_STEP} = 0)
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s QUALIFY rank <= {K}"""
