"""What the training-data operators share: table reading, the shared folder, batches."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is what the session has in spark.checkpoint.dir; a temporary folder of this
    machine only where that is unset (tests, a local master).
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if "dir" not in _LOCAL:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _LOCAL["dir"] = tempfile.mkdtemp(prefix="corpusmill-")
        atexit.register(shutil.rmtree, _LOCAL["dir"], ignore_errors=True)
    return "file://" + _LOCAL["dir"]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/corpusmill/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "zstd", by: list[str] | None = None) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    writer = df.write.option("compression", compression)
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes all tables that operators have written in the shared folder, when no result that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/corpusmill")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def texts(column) -> list[str]:
    """Python strings of an Arrow column, null as empty."""
    return [x or "" for x in column.to_pylist()]


_STATE: dict = {}


def worker_state(owner: str, key, make: Callable[[], T]) -> T:
    """What an operator keeps in a worker between tasks: made once for a key.

    A worker outlives an operator and serves the next one too, so it holds the state of one
    owner at a time; another owner's goes before the new one is made.
    """
    if _STATE.get("of") != (owner, key):
        _STATE.clear()
        gc.collect()
        _STATE["value"], _STATE["of"] = make(), (owner, key)
    return _STATE["value"]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows of batches in smaller ones, so that what Python makes of a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def named(name: str) -> Column:
    """The column of just that name, whatever characters it has."""
    return F.col(f"`{name.replace('`', '``')}`")


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, where their names clash with nothing and mean nothing."""
    return F.struct(*map(named, docs.columns))


def beside(docs: DataFrame, *columns) -> DataFrame:
    """The rows of docs as one struct, row, and columns beside it."""
    return docs.select(whole_row(docs).alias("row"), *columns)


def restored(rows: DataFrame, names: list[str], **new) -> DataFrame:
    """The columns of beside()'s rows again, those of new in place of the old ones."""
    return rows.select(*((new[c] if c in new else F.col("row").getField(c)).alias(c) for c in names), *(x.alias(c) for c, x in new.items() if c not in names))


def unused(name: str, names: list[str]) -> str:
    """name, with underscores behind it where names has it already, in whatever case."""
    taken = {c.lower() for c in names}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def settle(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of steps that are written and over.

    The cleaner acts when the driver's collector finds the plans unused, which may be long
    after; a long chain of steps would keep all its shuffles on disk until then. The
    driver's Python lets go of its plans a moment after its own collection, hence twice.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)
