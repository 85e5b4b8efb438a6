import itertools
import re
from collections import Counter

import pytest
from oracle import spark_rows, sql_rows

from corpusmill.llm import filter_audit
from corpusmill.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, bits int, digest string, `a.b` int"


def brute(docs, labels):
    bits = []
    for doc_id, text, source, *_ in docs:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        out = {"A"} if len(words) < 200 else set()
        out |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        out |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        out |= {"D"} if re.search("[#$%&*|]", text) else set()
        out |= {"E"} if doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, *_ in docs) else set()
        own = [x for x in labels if doc_id is not None and x[0] == doc_id]
        bits.append((source or "", out, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    rows, shares = [], Counter()
    for part in {b[0] for b in bits}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [b for b in bits if b[0] == part]
            for step, f in enumerate(order, 1):
                gone = [b for b in bits if b[0] == part and b[1] & set(order[: step - 1])]
                removed = [b for b in left if f in b[1]]
                left = [b for b in left if f not in b[1]]
                shares[part, f] += len(removed)
                rows.append([part, order, step, len(left), len(removed), sum(f in b[1] for b in gone), sum(b[0] == part and b[1] == {f} for b in bits), sum(b[2] for b in removed), sum(b[3] for b in removed)])
    return sorted((*r, shares[r[0], r[1][r[2] - 1]]) for r in rows)


def audited(spark, docs, labels):
    got = filter_audit.audit(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(*x, "p") for x in labels], "doc_id long, quality int, toxic int, part string"))
    return sorted(tuple(r) for r in got.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect())


def test_brute_force(spark):
    long, dull = " ".join(f"w{k}" for k in range(250)), "same same " * 150
    texts = [long, long, dull, dull + "#", long.upper(), long + " x", None, "", " \t\n", " ".join("ab" * 300), long + " A" * 20, long + " é|", "w" * 200_000]
    docs = [(k % 11 if k % 7 else None, t, ("web", None, "", "x")[k % 4], 1, "d", 2) for k, t in enumerate(texts * 3)]
    labels = [(k, k % 2, (k % 3) // 2) for k in range(9)] + [(1, 0, 1), (None, 1, 1), (2, None, None)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_text_with_copies_in_any_order(spark):
    docs = [(k, "copy", "s", 0, "", 0) for k in reversed(range(50))]
    rows = audited(spark, docs, [(0, 1, 1), (7, 1, 0)])
    step = next(r for r in rows if r[1] == "EABCD" and r[2] == 1)
    assert step[3:9] == (1, 49, 0, 0, 1, 0)


def test_empty_tables(spark):
    assert audited(spark, [], []) == []
    assert len(audited(spark, [(1, "x", "s", 0, "", 0)], [])) == 600


@pytest.mark.parametrize("text, bits", [("", 1), ("a " * 200, 2), ("ab " * 100 + "cd " * 100, 2), (" ".join(map(str, range(200))), 0), ("B" + "a" * 48, 5), ("B" + "a" * 49, 1), ("é$", 9), ("a b", 1)])
def test_limits_of_the_filters(text, bits):
    assert filter_audit.failed(text)[0] == bits


def test_query_equals_sql(spark):
    assert spark_rows(filter_audit.audit(table(spark, SF, "documents"), table(spark, SF, "labels"))) == sql_rows(filter_audit.ORACLE, SF)
