"""Polled documents as a stream source with its own offsets.

A poller lands every answer as one file, under a name that sorts after the names before it. The source's offset is, for each
input folder, the last name read, so a restart goes on where the stored offset ends and reads each poll once. A poll is
one partition: tasks fetch and parse the documents, the driver sees names only.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from millrace.stores import store

FORMAT = "millrace_polls"
SCHEMA = "input string, poll string, document string"


def landed(path: str, after: str = "") -> list[str]:
    """The names of the polls in a folder that come after ``after``, in order; hidden and marker files are none."""
    files, inner = store(path)
    found = files.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._" and f.base_name > after)


def land(spark: SparkSession, staged: str, folder: str, mark: str) -> None:
    """Move the files under ``staged`` into a poll folder, under names that begin with ``mark``, by renames of Spark's file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(folder)
    files = source.getFileSystem(conf)
    files.mkdirs(target)
    for status in files.listStatus(source):
        name = status.getPath().getName()
        if name[0] not in "._":
            files.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(target, f"{mark}-{name}"))


@dataclass
class _Poll(InputPartition):
    path: str
    name: str


class _Reader(DataSourceStreamReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def initialOffset(self) -> dict:
        return {path: "" for path in self.paths}

    def latestOffset(self) -> dict:
        return {path: (landed(path) or [""])[-1] for path in self.paths}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Poll(path, name) for path in self.paths for name in landed(path, start.get(path, "")) if name <= end.get(path, "")]

    def read(self, partition: _Poll) -> Iterator[pa.RecordBatch]:
        files, inner = store(partition.path)
        with files.open_input_stream(f"{inner}/{partition.name}") as stream:
            text = stream.read().decode()
        columns = [pa.array([value]) for value in (partition.path.rstrip("/").rsplit("/", 1)[-1], partition.name, text)]
        yield pa.RecordBatch.from_arrays(columns, ["input", "poll", "document"])


class PollSource(DataSource):
    """``readStream.format("millrace_polls")``; option ``paths``: a JSON list of folders."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(json.loads(self.options["paths"]))


def stream(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``input`` (base name of the folder), ``poll`` (file name), ``document`` (its text) of every poll that lands in any of the folders.

    An input added to the list later is read from its beginning. A poll landed under a name that sorts before one already read
    is not seen, and the newest poll of a folder stays there. A poll is one document and must fit a task.
    """
    spark.dataSource.register(PollSource)
    return spark.readStream.format(FORMAT).option("paths", json.dumps(paths)).load()
