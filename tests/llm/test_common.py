import pyarrow as pa

from corpusmill.llm.common import clear_scratch, scratch, slices, worker_state, written


def test_one_state_at_a_time():
    made = []
    make = lambda x: lambda: made.append(x) or x
    assert [worker_state("a", 1, make(1)), worker_state("a", 1, make(2)), worker_state("b", 1, make(3)), worker_state("a", 1, make(4))] == [1, 1, 3, 4]
    assert made == [1, 3, 4]


def test_slices():
    batch = pa.RecordBatch.from_arrays([pa.array(range(10))], names=["x"])
    assert [b.column(0).to_pylist() for b in slices([batch, batch.slice(0, 0), batch.slice(8)], 4)] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9], [8, 9]]


def test_scratch(spark):
    df = written(spark.range(5), "five")
    assert df.count() == 5 and scratch(spark, "a") != scratch(spark, "a")
    clear_scratch(spark)
