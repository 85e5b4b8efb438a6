import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import token_counts
from corpusmill.llm.token_counts import Counters, Lengths, count_tokens, frequent_chunks, packed, tokenizer, unpacked

PATH = public_tokenizers.path("byte_bpe_50k.json")


def whole(texts):
    return [len(tokenizer(PATH).encode(t, add_special_tokens=False).ids) for t in texts]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab'st1,. \n\t\r 　é漢🙂")) | st.characters(codec="utf-8"), max_size=40), max_size=5))
def test_chunks_equal_whole_texts(texts):
    assert Lengths(PATH, {}).counts(texts) == whole(texts)


def test_special_strings_and_long_texts():
    t = ["a <|endoftext|> b<|endoftext|>", "<|endoftext|>", " x", "x ", "x" * 100_000, "ab cd " * 30_000, "a  b"]
    assert Lengths(PATH, {"b": 1}).counts(t) == whole(t)


def test_query(spark):
    rows = [(1, "the cat\nsat on it", "x"), (2, None, "y"), (3, "", None), (None, "a b", "z"), (1, "the cat\nsat on it", "x"), (4, "word " * 600, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(df, PATH).collect())
    want = sorted((d or -1, len((t or "").encode()), n, n > 512) for (d, t, _), n in zip(rows, whole([t or "" for _, t, _ in rows]), strict=True))
    assert got == want
    assert count_tokens(df.limit(0), PATH).count() == 0


def test_spaces_that_touch_white_space():
    spaces = [" ", "\u00a0", "\n", "\t", "\u3000", "\u2003", "\x85", "\x1f", "\u2028"]
    t = ["Menu \u00a0 \u00a0 Home", "a \u00a0 \u00a0 \u00a0b", "x \u00a0 \u00a0\ny", " ", "", "  a", "a  ", "\n a", "a \n"]
    t += [f"one{a}{b}{c}{d}two three" for a in spaces for b in spaces for c in spaces for d in [*spaces, ""]]
    assert Lengths(PATH, {}).counts(t) == whole(t)


def test_bounded_counters(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "TASK_COUNTERS", 100)
    counts = Counters()
    for k in range(1000):
        counts.update(["often", f"once{k}", "often"])
        counts.prune()
        assert len(counts) <= 102
    assert counts["often"] == 2000
    long = "x" * 5000
    df = spark.createDataFrame([(f"a {long}{k} the the of {long}",) for k in range(50)] + [(None,), ("",), (long,)], "text string").repartition(40)
    assert frequent_chunks(df) == ["the", "of"]  # 40 tasks, merged in two levels; long chunks are never counted


def test_packed_table():
    table = {"a": 1, "": 2, "漢字\nx": 300, "b" * 32: 7}
    assert unpacked(packed(table)) == table and unpacked(packed({})) == {}
