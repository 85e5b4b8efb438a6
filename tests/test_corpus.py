import hashlib
import os

import pytest
from pyspark.sql import functions as F

from corpusmill.sources.corpus import corpus_lines, corpus_ranges, read_ranges, write_corpus, write_corpus_file


def lines(spark, texts, header="# H\n"):
    rows = spark.createDataFrame(list(enumerate(texts)), "ord long, md string")
    return corpus_lines(rows.repartition(5) if texts else rows, header)


@pytest.mark.parametrize("texts", [[], ["one"], ["é" * 1000, None, "", "b\n\nc"], [f"page {k} " * (k % 50) for k in range(500)]])
@pytest.mark.parametrize("scheme", ["", "file://"])
def test_one_file_has_the_bytes_of_the_format(spark, tmp_path, texts, scheme):
    path = f"{tmp_path}/out/corpus.txt"
    ranges = write_corpus_file(lines(spark, texts), scheme + path)
    want = "\n".join(["# H\n", *(f"\n\n{t or ''}" for t in texts)]).encode()
    assert open(path, "rb").read() == want and os.listdir(f"{tmp_path}/out") == ["corpus.txt"]
    found = ranges.join(read_ranges(ranges, scheme + path), "seq").collect()
    assert len(found) == len(texts) + 1
    for r in found:
        assert bytes(r.data) == (b"# H\n" if r.seq < 0 else f"\n\n{texts[r.seq] or ''}".encode()) == want[r.begin : r.begin + r.n_bytes]
    # a later run takes the file's place
    write_corpus_file(lines(spark, ["other"]), path)
    assert open(path).read() == "# H\n\n\n\nother"


def test_ranges_are_summed_without_one_task_for_all(spark):
    ranges = corpus_ranges(lines(spark, [f"{k}" * (k % 90) for k in range(2000)]))
    plan = ranges._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    rows = ranges.orderBy("seq").collect()
    assert all(a.begin + a.n_bytes + 1 == b.begin for a, b in zip(rows, rows[1:], strict=False)) and rows[0].begin == 0


def test_parts_are_the_same_text(spark, tmp_path):
    made = lines(spark, [f"page {k}" for k in range(100)])
    write_corpus(made, f"file://{tmp_path}/parts")
    write_corpus_file(made, f"{tmp_path}/one")
    parts = b"".join(open(f"{tmp_path}/parts/{n}", "rb").read() for n in sorted(os.listdir(f"{tmp_path}/parts")) if n.startswith("part-"))
    assert parts == open(f"{tmp_path}/one", "rb").read() + b"\n"
    assert hashlib.md5(parts[:-1]).hexdigest() == spark.read.format("binaryFile").load(f"{tmp_path}/one").select(F.md5("content")).first()[0]
