import random
import re
from collections import Counter

from pyspark.sql import functions as F

from corpusmill.llm.quality_rules import Rule, Sampled, default_rules, keep_good, op7, quality, rule_order, sample_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, rep = len(w), len(inside)
    chars, symbols = sum(map(len, w)), sum(c in "#*$%&|<>" for c in text)
    dup, caps = len(lines) - len(set(lines)), sum("A" <= c <= "Z" for c in text)
    base = n < 50 or 100 * rep > 50 * n
    ok = 10 * symbols <= n and not (dup >= 5 and 10 * dup > 3 * len(lines)) and 2 * caps <= chars and 2 * n <= chars <= 40 * n
    return (n, chars, symbols, dup, rep, base, not base and ok)


TEXTS = [None, "", " \n\t", "a b c", "a b c a b c d", "x " * 100, "é漢🙂 b c " * 3, "a\nb\n\na\n a\n", "# * | <a> &", "a b a b a b",
         " ".join(f"word{i}" for i in range(60)), " ".join(f"WORD{i}" for i in range(60)), "\n".join(["one line here"] * 10 + [f"w{i} v{i} u{i} t{i}" for i in range(20)]), "long word " * 20_000, "one\x0btwo\x0cthree four"]


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'x' as n_words", "1 as kept")
    got = {r.doc_id: tuple(r)[1:] for r in op7(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    names = keep_good(df)
    assert names.columns == df.columns
    assert {r.doc_id for r in names.collect()} == {i for i, t in enumerate(texts) if brute(t)[-1]}


def test_against_brute_force(spark):
    pick = random.Random(5)
    words = ["a", "bb", "c", "\n", "#", "É", "A", "\t", "d e f", "\n\n", "word", "🙂"]
    check(spark, [*TEXTS, *(" ".join(pick.choices(words[: pick.randint(2, 12)], k=pick.randint(0, 120))) for _ in range(300))])


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert op7(df.limit(0)).count() == 0 and keep_good(df.limit(0)).count() == 0
    assert [r.name for r, _, _ in rule_order(default_rules(), [])] == [r.name for r in default_rules()]


def test_order_by_rejection_per_cost():
    rules = [Rule("dear", F.lit(True), ("n_repeat_words",)), Rule("cheap", F.lit(True), ("n_symbols",)), Rule("same", F.lit(True), ("n_symbols",)), Rule("never", F.lit(False), ())]
    sizes = (1000, 150, 10)
    sampled = [Sampled(0b0001, 30, sizes), Sampled(0b0110, 20, sizes), Sampled(0b0000, 50, sizes)]
    found = rule_order(rules, sampled)
    assert [(r.name, gone) for r, _, gone in found] == [("cheap", 20), ("dear", 30), ("never", 0), ("same", 0)]
    assert found[0][1] == 3 * 19 * 1000 + 100 and found[-1][1] == 50  # n_symbols is there already, so same costs its test alone
    assert found == rule_order(rules, sampled[::-1])


def test_same_order_in_every_run(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    runs = [sample_counts(d, default_rules()) for d in (docs, docs.repartition(7), docs)]
    names = [[r.name for r, _, _ in rule_order(default_rules(), x)] for x in runs]
    assert names[0] == names[1] == names[2] and sum(p.rows for p in runs[0]) > 5
    by = [{r.doc_id: r.rejected_by for r in quality(d).collect()} for d in (docs, docs.repartition(5))]
    assert by[0] == by[1] and len({*by[0].values()}) > 3


def test_short_circuit(spark):
    """A later rule's statistic isn't made for rows that an earlier one rejects: here it would fail for them."""
    df = spark.createDataFrame([(1, "not a number"), (2, "17"), (3, "4")], "doc_id long, text string")
    first = Rule("letters", F.regexp_like("__text", F.lit("[a-z]")), ())
    fails = Rule("small", F.col("__text").cast("int") < 10, ())  # an error for letters
    for rules in ([first, fails],):
        got = {r.doc_id: r.rejected_by for r in quality(df, rules).collect()}
        assert got == {1: "letters", 2: None, 3: "small"}
        assert [r.doc_id for r in keep_good(df, rules).collect()] == [2]
    plan = keep_good(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().optimizedPlan().toString()
    # every statistic that isn't the first rule's stands behind a test of what was decided before
    assert "Python" not in plan and plan.count("CASE WHEN isnull(__by") >= 4, plan
