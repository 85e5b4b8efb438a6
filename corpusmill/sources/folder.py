"""A folder of records, each a few files with one stem, as a data source: spark.read and df.write with format "stems".

A row has stem and one column for each kind of file, named by its extension with _ for dots
(json, html, md, redirect_json); null stands for a file that isn't there. The option `kinds`
lists the columns; the first is the record's own file, and without it there is no record.

Writing: each task stages a record's files below a folder of the job's own and then moves
them to their names, the record's own file last and, where there is one already, taken away
first. So whatever stops a task, a reader finds the old record, the new one or none, never
half of one; a retried task writes the same names again. The job's folder goes with its end,
or when it is given up. Nothing passes through the driver.

Reading: the names are listed once and dealt out in ranges, a few hundred records a task,
which opens all files of a record in one go. Conditions on stem (=, in, <, <=, >, >=, prefix)
choose among the names before any file is opened. With the option `bodies` set to false only
the record's own file is read; the others are '' where they exist.

The folder is any that pyarrow's file systems reach from the executors.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StringType, StructField, StructType

#: Records of a task, and of a batch.
RANGE, BATCH = 400, 50


def opened(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def _drop(files: fs.FileSystem, path: str) -> None:
    with contextlib.suppress(FileNotFoundError):
        files.delete_file(path)


class Stems(DataSource):
    @classmethod
    def name(cls) -> str:
        return "stems"

    def schema(self) -> StructType:
        return StructType([StructField(c, StringType()) for c in ("stem", *self.kinds())])

    def kinds(self) -> list[str]:
        return self.options.get("kinds", "json,html,md").split(",")

    def reader(self, schema: StructType) -> DataSourceReader:
        return StemsReader(self.options["path"], self.kinds(), self.options.get("bodies", "true").lower() != "false", tuple(filter(None, self.options.get("without", "").split(","))))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("records are replaced one by one: use mode('append')")
        return StemsWriter(self.options["path"], self.kinds())


@dataclass
class Names(InputPartition):
    """Some records: their stems, and which other files each has."""

    stems: tuple[str, ...]
    others: tuple[tuple[str, ...], ...]


#: For each condition on a string what it asks of one.
TESTS: dict[type, Callable] = {
    EqualTo: lambda x, v: x == v,
    In: lambda x, v: x in v,
    LessThan: lambda x, v: x.encode() < v.encode(),
    LessThanOrEqual: lambda x, v: x.encode() <= v.encode(),
    GreaterThan: lambda x, v: x.encode() > v.encode(),
    GreaterThanOrEqual: lambda x, v: x.encode() >= v.encode(),
    StringStartsWith: lambda x, v: x.startswith(v),
}


class StemsReader(DataSourceReader):
    def __init__(self, path: str, kinds: list[str], bodies: bool, without: tuple[str, ...]):
        self.path, self.kinds, self.bodies, self.without, self.tests = path, kinds, bodies, without, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if type(f) in TESTS and f.attribute == ("stem",):
                self.tests.append((type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        files, path = opened(self.path)
        names = {x.base_name for x in files.get_file_info(fs.FileSelector(path, allow_not_found=True)) if x.type == fs.FileType.File}
        end = "." + self.kinds[0].replace("_", ".")
        stems = sorted(n.removesuffix(end) for n in names if n.endswith(end) and not n.endswith(self.without) and n[0] != ".")
        stems = [s for s in stems if all(TESTS[kind](s, value) for kind, value in self.tests)]
        others = [tuple(k for k in self.kinds[1:] if f"{s}.{k.replace('_', '.')}" in names) for s in stems]
        return [Names(tuple(stems[k : k + RANGE]), tuple(others[k : k + RANGE])) for k in range(0, len(stems), RANGE)] or [Names((), ())]

    def read(self, partition: Names) -> Iterator[pa.RecordBatch]:
        files, path = opened(self.path)

        def content(stem: str, kind: str) -> str | None:
            try:
                with files.open_input_stream(f"{path}/{stem}.{kind.replace('_', '.')}") as f:
                    return f.read().decode("utf-8", "replace")
            except FileNotFoundError:
                return None

        for at in range(0, len(partition.stems), BATCH):
            rows = list(zip(partition.stems[at : at + BATCH], partition.others[at : at + BATCH], strict=True))
            columns = [[s for s, _ in rows], [content(s, self.kinds[0]) for s, _ in rows]]
            columns += [[None if k not in there else content(s, k) if self.bodies else "" for s, there in rows] for k in self.kinds[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["stem", *self.kinds])


@dataclass
class Written(WriterCommitMessage):
    records: int


class StemsWriter(DataSourceArrowWriter):
    def __init__(self, path: str, kinds: list[str]):
        self.path, self.kinds, self.staging = path.rstrip("/"), kinds, f".staging-{uuid.uuid4().hex}"
        files, folder = opened(self.path)
        files.create_dir(f"{folder}/{self.staging}", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, folder = opened(self.path)
        own, n = f"{folder}/{self.staging}/{TaskContext.get().taskAttemptId()}", 0
        files.create_dir(own)
        # the record's own file is the last to come
        order = [*self.kinds[1:], self.kinds[0]]
        for batch in iterator:
            for row in batch.to_pylist():
                if row["stem"] is not None:
                    self.publish(files, folder, own, row, order)
                    n += 1
        return Written(n)

    def publish(self, files: fs.FileSystem, folder: str, own: str, row: dict, order: list[str]) -> None:
        ends = {k: f"{row['stem']}.{k.replace('_', '.')}" for k in order}
        for k in order:
            if row[k] is not None:
                with files.open_output_stream(f"{own}/{ends[k]}") as f:
                    f.write(row[k].encode("utf-8", "replace"))
        _drop(files, f"{folder}/{ends[order[-1]]}")
        for k in order:
            if row[k] is not None:
                files.move(f"{own}/{ends[k]}", f"{folder}/{ends[k]}")
            else:
                _drop(files, f"{folder}/{ends[k]}")

    def _end(self) -> None:
        files, folder = opened(self.path)
        with contextlib.suppress(FileNotFoundError):
            files.delete_dir(f"{folder}/{self.staging}")

    def commit(self, messages: list[Written | None]) -> None:
        self._end()

    def abort(self, messages: list[Written | None]) -> None:
        """Records that were moved are whole and stay, as pages that a crawl has saved; the rest goes."""
        self._end()


def register(spark: SparkSession) -> None:
    """Makes the format known, and lets conditions reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Stems)
