import random
import re

import numpy as np
import public_tokenizers

import corpus_pipeline
from corpusmill.llm.piece_sampling import Sampler
from test_decontaminate import brute as leaks
from test_near_dedup import brute as near
from test_quality_rules import brute as quality

SECRET = re.compile(r"token = [0-9a-f]{40}")


def fixture(spark, path):
    pick = random.Random(11)
    words = [f"wo{i}rd" for i in range(900)]
    prose = lambda n: " ".join(pick.choices(words, k=n))
    items = [prose(n) for n in (15, 20, 30)]
    texts = [prose(pick.randint(55, 140)) for _ in range(12)]
    texts += [texts[1], texts[2] + " more", texts[3].upper(), prose(90) + " token = " + "0123456789abcdef" * 2 + "01234567", prose(20), None, "", "spam " * 80, prose(60) + " # | # | # | # | # | #"]
    texts += [f"{prose(60)} {items[k % 3]} {prose(20)}" for k in range(3)]
    docs = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return docs, items


def brute(docs, items):
    left = [d for d in docs if quality(d[1])[-1]]
    kept = {i for i, _, _, k in near([d[0] for d in left], [d[1] for d in left]) if k}
    left = [d for d in left if d[0] in kept and not any(leaks(d[1], t) for t in items)]
    draw, out = Sampler(public_tokenizers.path("piece_bpe_32k.model")), []
    for i, t, lang, source, n in left:
        new = SECRET.sub("[REDACTED]", t)
        out.append((i, new, lang, source, n if new == t else len(new), draw.sample(np.array([i]), [new], 0)[0].tolist()))
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    docs, items = fixture(spark, tmp_path)
    want = brute(docs, items)
    got = corpus_pipeline.run(spark, f"file://{tmp_path}")
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "pieces"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert any("[REDACTED]" in r[1] for r in want) and 10 <= len(want) < len(docs)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "pieces"]


def test_stages_keep_columns_and_take_nulls(spark, tmp_path):
    fixture(spark, tmp_path)
    odd = spark.createDataFrame([(None, "a b", None, None, None, "x"), (1, None, None, None, None, "y")], "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (odd, odd.limit(0)):
            assert stage(spark, docs, f"file://{tmp_path}").columns == odd.columns
    assert corpus_pipeline.secrets(spark, odd, "").count() == 2


def test_stages_pass_any_column_names(spark, tmp_path):
    fixture(spark, tmp_path)
    more = "`a.b` int, Pieces string, TEXT2 string, row int, `pieces_` int, `back``tick` string, n int"
    text = " ".join(f"w{k}" for k in range(80)) + ". token = " + "0123456789abcdef" * 2
    docs = spark.createDataFrame([(1, text, "en", "s", len(text), 5, "p", "t", 6, 7, "b", 8)], f"doc_id long, text string, lang string, source string, n_chars long, {more}")
    assert docs.columns[5] == "a.b"
    for name, stage in corpus_pipeline.STAGES:
        docs_out = stage(spark, docs, f"file://{tmp_path}")
        assert docs_out.columns[:12] == docs.columns and docs_out.columns[12:] == (["pieces__"] if name == "pieces" else [])
        assert [r[5:12] for r in docs_out.collect()] == [(5, "p", "t", 6, 7, "b", 8)]
        docs = docs_out.select(*(f"`{c.replace('`', '``')}`" for c in docs.columns))
    assert "[REDACTED]" in docs.first().text
