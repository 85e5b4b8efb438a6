import math
import re
from collections import Counter

import pytest
from oracle import spark_rows, sql_rows

from corpusmill.llm import lexical_search
from corpusmill.llm.common import table

SF = "/root/testdata/sf0.001"


def split(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)


def brute(docs, items, k=10):
    found = [(d, split(t)) for d, t in docs]
    n_docs, n_all = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    df = Counter(x for _, t in found for x in set(t))
    own: dict = {}
    for i, t in items:
        own.setdefault(i, set()).update(split(t))
    out = []
    for item, asked in own.items():
        scored = []
        for d, t in found:
            if not t:
                continue
            m, tf = 100 - 90 + (90 * len(t) * n_docs) // n_all, Counter(t)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((1000000000 * tf[x]) // (1000 * tf[x] + 8 * m)) for x in asked if tf[x])
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def ranked(spark, docs, items, **more):
    docs = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, n int, `a.b` int")
    items = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, terms string")
    return sorted((tuple(r) for r in lexical_search.rank(docs, items, **more).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


DOCS = [(k, f"Alpha beta{k % 5} {'gamma ' * (k % 7)} delta-{k % 3} épée ÉPÉE x_{k}") for k in range(60)]
DOCS += [(3, "alpha repeated id"), (3, "alpha repeated id"), (None, "alpha without id"), (61, None), (62, ""), (63, " \t-_!"), (64, "long " * 50_000 + "gamma"), (-5, "ALPHA"), (65, "ΑΒΓ α β")]
ITEMS = [(1, "alpha gamma"), (2, "épée delta 1"), (2, "beta3"), (3, None), (4, ""), (5, "nowhere"), (None, "gamma LONG"), (7, "α β and ΑΒΓ"), (1, "alpha gamma"), (8, "x alpha " * 400)]


@pytest.mark.parametrize("more", [{}, {"block_terms": 1}, {"block_terms": 4}])
def test_brute_force(spark, more):
    assert ranked(spark, DOCS, ITEMS, **more) == brute(DOCS, ITEMS)


@pytest.mark.parametrize("window", [1, 7])
def test_windows_do_not_show(spark, monkeypatch, window):
    """The same by tasks whose windows are small: what a later window has must be better to be taken."""
    asked = {t: n for n, t in enumerate(sorted({t for _, x in ITEMS for t in lexical_search.terms(x or "")}))}
    docs = spark.createDataFrame([d for d in DOCS if d[0] is not None and d[0] != 3], "doc_id long, text string")
    found = lexical_search.postings(docs, asked).orderBy("doc_id").coalesce(1)
    weights = lexical_search.np.arange(1, len(asked) + 1) * 100
    items = [lexical_search.np.array(sorted({asked[t] for t in lexical_search.terms(x or "")}), "int64") for _, x in ITEMS]
    want = sorted(map(tuple, lexical_search.best_of(found, items, weights, 60, 900, 10).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", window)
    monkeypatch.setattr(lexical_search, "WINDOW", window)
    try:
        assert sorted(map(tuple, lexical_search.best_of(found, items, weights, 60, 900, 10).collect())) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_tables(spark):
    assert ranked(spark, [], ITEMS) == [] and ranked(spark, DOCS, []) == [] and ranked(spark, [(1, None)], ITEMS) == []


def test_equal_scores_by_doc_id(spark):
    docs = [(k, "same words here") for k in range(40, 0, -1)] + [(50, "other")]
    assert [r[2] for r in sorted(ranked(spark, docs, [(1, "same")]))] == list(range(1, 11))


def test_terms():
    assert lexical_search.terms("Don't A_b é—ß1!\x7f\x80") == [b"don", b"t", b"a", b"b", "é—ß1".encode(), "\x80".encode()]


def test_query_equals_sql(spark):
    assert spark_rows(lexical_search.rank(table(spark, SF, "documents"), table(spark, SF, "benchmark"))) == sql_rows(lexical_search.ORACLE, SF)
