import math

import numpy as np
import pytest
from oracle import spark_rows, sql_rows

from corpusmill.llm import exact_topk
from corpusmill.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, rid string, `group` int, `a.b` int"


def brute(rows, k, step):
    vectors = []
    for vec_id, v in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(256 * x) for x in v]
        if sum(x * x for x in ints) < 1 << 62:
            vectors.append((vec_id, ints))
    out = []
    for n, (q, a) in enumerate(vectors):
        if q is None or q % step:
            continue
        best = sorted(((-sum(x * y for x, y in zip(a, b)), v is None, v or 0) for m, (v, b) in enumerate(vectors) if m != n))[:k]
        out += [(q, r, None if none else v, -s) for r, (s, none, v) in enumerate(best, 1)]
    return sorted(out, key=repr)


def found(spark, rows, k=5, step=50, **more):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in exact_topk.top_k(df, k, step, **more).select("query_id", "rank", "vec_id", "score").collect()), key=repr)


def clustered(n, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, 6)) * 4
    return [(int(i), (centres[i % 8] + rng.normal(size=6) * 0.1).tolist()) for i in range(n)]


@pytest.mark.parametrize("more", [{}, {"group": 5, "a_pivot": 2, "salt_rows": 40}, {"group": 1, "a_pivot": 1, "salt_rows": 1000}])
def test_brute_force(spark, more):
    rows = clustered(200) + [(None, [1.0] * 6), (50, [1.0] * 6), (50, [1.0] * 6), (-100, [0.5, -0.25]), (7, None), (100, [1.0, None]), (150, [math.nan] * 6), (8, [math.inf] * 6), (200, []), (250, [1e12] * 6), (300, [3e6, -2e6]), (350, [1e-300] * 6)]
    assert found(spark, rows, step=10, **more) == brute(rows, 5, 10)


def test_copies_are_one_query_and_few_candidates(spark):
    rows = [(k, [0.5, 0.25]) for k in range(300)] + [(k, [0.1, k / 1000]) for k in range(300, 400)]
    assert found(spark, rows, group=3, a_pivot=1) == brute(rows, 5, 50)


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(50, [1.0])]) == []
    assert found(spark, [(1, [1.0]), (3, [2.0])]) == []
    assert found(spark, [(50, [1.0]), (3, [2.0]), (4, [2.0])]) == [(50, 1, 3, 256 * 512), (50, 2, 4, 256 * 512)]


def test_bounds_hold_and_leave_out_what_is_far():
    """Of every query the bound of its cell is no more than its k-th score, and no row above it may be left out."""
    vectors = [exact_topk.packed(np.array(v)) for _, v in clustered(400)]
    rows, pivots = exact_topk.unpacked(vectors), exact_topk.Pivots(vectors[:8])
    cell, apart, dots = pivots.near(rows)
    radius = np.array([apart[cell == p].max(initial=0) for p in range(8)])
    norm = np.full(8, np.sqrt((rows.astype(float) ** 2).sum(axis=1)).max())
    bound = pivots.bounds(radius, norm, {p: np.sort(apart[cell == p])[:6].tolist() for p in range(8)}, 6)
    scores = exact_topk.products(rows, rows)
    kth = np.sort(scores, axis=1)[:, -6]
    assert (kth >= bound[cell]).all() and np.isfinite(bound).all()
    may = dots + radius * np.sqrt((rows.astype(float) ** 2).sum(axis=1))[:, None] + 1 >= bound
    for q in range(0, 400, 20):
        assert may[scores[q] >= kth[q], cell[q]].all()
    assert may.mean() < 0.5


def test_groups_are_bounded_but_for_single_cells():
    class Cell:
        def __init__(self, pivot, n):
            self.pivot, self.n = pivot, n

    pivots = exact_topk.Pivots([exact_topk.packed(np.array([float(k), 1.0])) for k in range(6)])
    sizes = [3, 2, 40, 1, 5, 4]
    group, parts = exact_topk.grouped([Cell(k, n) for k, n in enumerate(sizes)], pivots, 6)
    for g in parts:
        filled = sum(sizes[p] for p, x in group.items() if x == g)
        assert parts[g] == -(-filled // 6) and (filled <= 6 or list(group.values()).count(g) == 1)


@pytest.mark.parametrize("values", [[0.1, -0.1], [200.0, -1.0], [8e6], [-8e6], [], [-128.0], [127.99]])
def test_packed_vectors_come_back(values):
    raw = exact_topk.packed(np.array(values))
    assert exact_topk.unpacked([raw])[0].tolist() == [math.floor(256 * x) for x in values]


def test_products_of_large_numbers_are_exact():
    a = np.array([[2**30 + 1, 3]], np.int64)
    assert exact_topk.products(a, a)[0, 0] == (2**30 + 1) ** 2 + 9


def test_query_equals_sql(spark):
    assert spark_rows(exact_topk.top_k(table(spark, SF, "embeddings"))) == sql_rows(exact_topk.ORACLE, SF)
