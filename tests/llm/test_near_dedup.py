import random

import numpy as np

from corpusmill.llm import near_dedup
from corpusmill.llm.components import components
from corpusmill.llm.near_dedup import bound_table, near_duplicates, one_of_each, passing, shingles, signature


def brute_sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def brute(ids, texts):
    sets, parent = brute_sets(texts), {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(ids[i]), find(ids[j])))
                parent[b] = a
    return [(d, len(s), find(d), find(d) == d) for d, s in zip(ids, sets, strict=True)]


def corpus(n=240, seed=3):
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["É", "ÉB", "Ab"]
    base = [pick.choices(words, k=pick.randint(3, 120)) for _ in range(12)]
    out = [None, "", " \n", "One two", "one TWO", "one two three four", "É b", "é b"]
    for _ in range(n):
        t = list(pick.choice(base))
        for _ in range(pick.choice([0, 0, 1, 2, 4])):
            t[pick.randrange(len(t))] = pick.choice(words)
        out.append(" ".join(t[pick.choice([0, 0, 1]) :]))
    return out


def check(spark, ids, texts):
    extra = ["'x' as sig", "1 as node", "2 as kept", "3 as __drop", "4 as __twice", "5 as id", "6 as `row`", "7 as `a.b`"]
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").selectExpr("*", *extra).repartition(3)
    assert sorted(map(tuple, near_duplicates(df).collect())) == sorted(brute(ids, texts))
    return df


def test_against_brute_force(spark):
    texts = corpus()
    ids = random.Random(1).sample(range(-50, 5000), len(texts))
    df = check(spark, ids, texts)
    kept = one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _, _, k in brute(ids, texts) if k)


def boilerplate(n=90, seed=6):
    """Texts that share half their words or more, many of them above and many below the threshold: buckets percolate."""
    pick = random.Random(seed)
    common = [f"c{i}" for i in range(60)]
    out = []
    for k in range(n):
        own = [f"k{k}x{i}" for i in range(pick.choice([4, 8, 11, 14, 20, 40]))]
        out.append(" ".join(common + own))
    return out + [" ".join(common[: 60 - k] + [f"z{i}" for i in range(3 * k)]) for k in range(10)]


def test_blocks_of_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 8)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 900)
    texts = boilerplate() + corpus(60, 4)
    check(spark, list(range(len(texts))), texts)


def test_second_round(spark, monkeypatch):
    """Members that aren't linked with the first of their bucket are still compared with each other."""
    seen = []
    real = near_dedup.compared
    monkeypatch.setattr(near_dedup, "compared", lambda *a: seen.append(a[-1]) or real(*a))
    common = [f"c{i}" for i in range(48)]
    texts = [" ".join(common + [f"a{g}x{i}" for i in range(30)] + [f"m{g}y{k}"]) for g in range(6) for k in range(5)]
    check(spark, list(range(len(texts))), texts)
    assert seen.count("flags") == 1


def test_edges(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "x " * 60_000), (3, "x " * 50_000), (4, None)]
    rows += [(17, a), (17, b), (13, a + " more"), (19, b + " more")]  # one doc_id with two texts joins the copies of both
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (None, None, True), (2, 2, True), (3, 2, False), (4, 4, True), (13, 13, True), (17, 13, False), (17, 13, False), (19, 13, False)], key=str)
    assert sorted((r.doc_id for r in one_of_each(df).collect()), key=str) == sorted([1, None, 2, 4, 13], key=str)
    assert near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, 5), (9, 3), (3, 7), (7, 9)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, 3: 3, 7: 3, 9: 3}


def test_signatures_estimate_and_bounds():
    pick = np.random.default_rng(1)
    a = " ".join(map(str, pick.integers(0, 10**6, 3000)))
    b = a.rsplit(" ", 300)[0]
    x, y = shingles(a), shingles(b)
    real = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert abs((signature(x) == signature(y)).mean() - real) < 0.12
    table = bound_table()
    assert table == sorted(table) and 60 < table[-1] < 96 and table[0] >= 1


def test_recall_of_bands_and_bounds():
    """Of pairs at the threshold and a little above, none is lost by bands or by the posterior bound."""
    pick, lost, n = np.random.default_rng(5), 0, 400
    for _ in range(n):
        both = pick.integers(0, 1 << 63, 300).astype(np.uint64)
        a, b = (np.unique(np.concatenate([both, pick.integers(0, 1 << 63, 50).astype(np.uint64)])) for _ in range(2))
        x, y = signature(a), signature(b)
        band = (x.reshape(near_dedup.BANDS, -1) == y.reshape(near_dedup.BANDS, -1)).all(axis=1).any()
        lost += not (band and len(passing(x.astype(np.uint8), y.astype(np.uint8)[None], bound_table())[0]))
    assert lost == 0


def test_of_equal_rows_but_for_a_column_the_same_one_stays(spark):
    text = " ".join(f"w{k}" for k in range(30))
    for order in (1, -1):
        docs = spark.createDataFrame([(7, text, "b", {"k": 1}), (7, text, "a", {"k": 1}), (8, "other", "c", {})][::order], "doc_id long, text string, lang string, m map<string,int>").coalesce(1)
        assert sorted((r.doc_id, r.lang) for r in near_dedup.one_of_each(docs).collect()) == [(7, "a"), (8, "c")]
