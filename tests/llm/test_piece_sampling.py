import math
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm.piece_sampling import Sampler, decode, digests, encode, with_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
DRAW = Sampler(PATH)
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abthe ing  \n▁é漢🙂")) | st.characters(codec="utf-8"), max_size=40), max_size=5), st.integers(-(2**63), 2**63 - 1))
def test_lossless_and_reproducible(batch, key):
    keys = np.full(len(batch), key)
    ids = DRAW.sample(keys, batch, 7)
    assert [DRAW.decode(x) for x in ids] == batch
    other = Sampler(PATH)
    other.sample(np.array([1]), ["some other words first"], 3)
    for k in range(len(batch)):  # one at a time, with another cache
        assert other.sample(keys[:1], [batch[k]], 7)[0].tolist() == ids[k].tolist()
    for t, x in zip(batch, ids, strict=True):
        if "▁" not in t and t and "\x00" not in t:
            assert SP.decode(x.tolist()) == t


def test_shares_follow_the_lattice():
    word, weights = "then", {}

    def walk(rest, path, log):
        if not rest:
            weights[tuple(path)] = log
        for k in range(1, len(rest) + 1):
            if rest[:k] in DRAW.pieces.weight:
                i, w = DRAW.pieces.weight[rest[:k]]
                walk(rest[k:], [*path, i], log + math.log(w))

    walk(" " + word, [], 0.0)
    total = sum(map(math.exp, weights.values()))
    n = 60_000
    seen = Counter(tuple(x.tolist()) for x in DRAW.sample(np.arange(n), [word] * n, 5))
    assert set(seen) <= set(weights)
    for path, w in weights.items():
        p = math.exp(w) / total
        assert abs(seen[path] - n * p) < 6 * math.sqrt(n * p * (1 - p)) + 6


def test_filtering_of_many_equals_that_of_one():
    units = [" ", " the", " thnterble,", "  x", " é▁漢", " 🙂a🙂", " " + "wordword" * 5]
    node, bound, length, piece = DRAW.pieces.many(units)
    base = 0
    for u in units:
        n, b, k, i = DRAW.pieces.one(u)
        mine = (node >= base) & (node <= base + len(u))
        assert (node[mine] - base).tolist() == n.tolist() and length[mine].tolist() == k.tolist() and piece[mine].tolist() == i.tolist()
        assert np.abs(bound[mine] - b).max() <= 8
        base += len(u) + 1


def test_tables(spark):
    rows = [(1, "The cat  sat\non ▁ it", "x"), (2, None, "y"), (3, "", "z"), (None, "no key", ""), (1, "The cat  sat\non ▁ it", "x"), (5, "word" * 30_000, ""), (6, "a b " * 40_000, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_pieces string")
    drawn = encode(df.repartition(3), PATH, 9).collect()
    assert {(r.doc_id, r.text) for r in decode(spark.createDataFrame(drawn, "doc_id long, pieces array<int>"), PATH).collect()} == {(d, t) for d, t, _ in rows}
    once = {r.doc_id: tuple(r) for r in digests(df.repartition(1), PATH, 9).collect()}
    assert once == {r.doc_id: tuple(r) for r in digests(df.repartition(5), PATH, 9).collect()} and all(x[-1] for x in once.values())
    assert once[1][2] == len(next(r.pieces for r in drawn if r.doc_id == 1)) and once[2][2] == 0
    full = with_pieces(df, PATH, 9)
    assert full.columns == [*df.columns, "pieces"] and sorted(full.select(df.columns).collect(), key=str) == sorted(df.collect(), key=str)
    assert digests(df.limit(0), PATH).count() == 0
    assert with_pieces(full, PATH, 9).columns == [*full.columns, "pieces_"] and with_pieces(full, PATH, 9).where("pieces is not distinct from pieces_").count() == len(rows)
