import itertools
import random

import numpy as np

from corpusmill.llm import decontaminate
from corpusmill.llm.decontaminate import MASKS, bitmaps, clean, find_items, maybe, needed


def words(text):
    return [w for w in ("".join(filter(str.isalnum, c.lower())) for c in (text or "").split()) if w]


def brute(text, item):
    """Whether some diagonal has a window that agrees, by trying all of them."""
    w, v = words(text), words(item)
    if len(v) < 8:
        return bool(v) and any(w[i : i + len(v)] == v for i in range(len(w)))
    size = min(13, len(v))
    for shift in range(-len(v), len(w)):
        for a in range(len(v) - size + 1):
            if 0 <= a + shift and a + shift + size <= len(w) and sum(v[a + i] == w[a + shift + i] for i in range(size)) * 100 >= 80 * size:
                return True
    return False


def sample(seed, n):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of"] * 60
    items = [" ".join(pick.choices(vocabulary, k=pick.randint(3, 40))) for _ in range(25)]
    docs = []
    for _ in range(n):
        body = pick.choices(vocabulary, k=pick.randint(0, 80))
        if pick.random() < 0.6:
            passage = pick.choice(items).split()
            for _ in range(pick.choice([0, 0, 1, 2, 3, 6])):
                passage[pick.randrange(len(passage))] = pick.choice(vocabulary)
            at = pick.randint(0, len(body))
            body[at:at] = [w.title() + pick.choice(["", ",", "."]) for w in passage[pick.choice([0, 0, 3]) :]]
        docs.append(" ".join(body))
    return docs, items


def best(text, item):
    w, v = words(text), words(item)
    size = min(13, len(v))
    return max(sum(v[a + i] == w[a + shift + i] for i in range(size)) for shift in range(-len(v), len(w)) for a in range(len(v) - size + 1) if 0 <= a + shift and a + shift + size <= len(w))


def test_against_brute_force(spark):
    docs, items = sample(1, 150)
    docs += [None, "", "| - |", "x " * 3000, docs[3], docs[3], "before w1 w2 w3 after", "w1 w2 w4 w3"]
    items += ["W1, w2 w3!", "w4", items[2]]
    extra = "*", "1 as item_id", "'x' as words", "2 as k1", "3 as `row`", "4 as `a.b`"
    d = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string").selectExpr(*extra).repartition(3)
    b = spark.createDataFrame([*enumerate(items), (99, None), (98, ""), (97, "- |")], "item_id long, text string").selectExpr("*", "5 as doc_id")
    want = {(i, k) for i, t in enumerate(docs) for k, v in enumerate(items) if brute(t, v)}
    rows = find_items(d, b).collect()
    assert len(rows) == len(want) > 60 and {(r.doc_id, r.item_id) for r in rows} == want
    for r in rows:
        n = len(words(items[r.item_id]))
        assert (r.n_item_words, r.n_window) == (n, min(13, n)) and r.n_match == best(docs[r.doc_id], items[r.item_id])
    kept = clean(d, b)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == set(range(len(docs))) - {i for i, _ in want}


def test_masks_cover_all_patterns():
    """Whatever places of a window differ, as many as are allowed, some mask fits between them."""
    for n in range(8, 14):
        size, least = needed(n)
        for gone in itertools.combinations(range(size), size - least):
            assert any(not {o + p for p in m} & set(gone) for m in MASKS for o in range(size - m[-1])), (n, gone)
    assert needed(40) == needed(13) == (13, 11) and needed(7) == (7, 7)


def test_bitmaps(spark):
    pick = np.random.default_rng(3)
    keys = pick.integers(-(1 << 63), (1 << 63) - 1, 5000)
    bits, upper, lower = bitmaps(spark.createDataFrame([(int(k),) for k in keys], "seed long"))
    assert len(maybe(keys.view(np.uint64), bits, upper, lower)) == len(keys)
    others = pick.integers(-(1 << 63), (1 << 63) - 1, 100_000).view(np.uint64)
    assert len(maybe(others, bits, upper, lower)) < 100


def test_hot_seeds(spark, monkeypatch):
    """One phrase stands in every text and every item; the shuffled form of clean() gives the same."""
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    hot = "which one of the following is the right answer to this"
    items = [(k, f"{hot} {' '.join(f'i{k}w{j}' for j in range(12))}") for k in range(20)]
    docs = [(k, f"{hot} {' '.join(f'd{k}w{j}' for j in range(30))}") for k in range(60)] + [(100 + k, f"a b c {t} d") for k, t in items[:5]]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in find_items(d, b).collect()} == {(i, k) for i, t in docs for k, v in items if brute(t, v)}
    assert {r.doc_id for r in clean(d, b).collect()} == {i for i, t in docs if not any(brute(t, v) for _, v in items)}


def test_empty_and_repeated(spark):
    d = spark.createDataFrame([(None, "a b c d e f g h i j"), (5, "a b c d e f g h i j"), (5, "a b c d e f g h i j")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "A b c d e f g h"), (1, "A b c d e f g h")], "item_id long, text string")
    assert sorted((tuple(r) for r in find_items(d, b).collect()), key=str) == sorted([(None, 1, 8, 8, 8)] * 2 + [(5, 1, 8, 8, 8)] * 4, key=str)
    assert find_items(d.limit(0), b).count() == 0 and find_items(d, b.limit(0)).count() == 0 and clean(d, b.limit(0)).count() == 3
    assert clean(d, b).count() == 0 and clean(d.limit(0), b).count() == 0


def test_a_text_with_very_many_hits(spark):
    """Its lines are dealt out in parts, its words once a part: what crosses does not grow with hits times length."""
    item = " ".join(f"w{j}" for j in range(16))
    text = " ".join(f"{item} x{k}" for k in range(3000))
    docs = spark.createDataFrame([(1, text), (2, "nothing of it " * 50), (3, "w0 w1 y " + item)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, item + " more"), (3, "none of this is there at all in them")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.n_match) for r in find_items(docs, items).collect()) == [(1, 1, 13), (1, 2, 13), (3, 1, 13), (3, 2, 13)]
