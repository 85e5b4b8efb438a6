"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where that is unset and the master is local."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if "dir" not in _LOCAL:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _LOCAL["dir"] = tempfile.mkdtemp(prefix="corpusmill-")
        atexit.register(shutil.rmtree, _LOCAL["dir"], ignore_errors=True)
    return "file://" + _LOCAL["dir"]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that is not there yet."""
    return f"{shared_dir(spark)}/corpusmill/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a written table: no lineage, and safe from lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The page snapshot and other tables of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
