"""A message sink whose batches are all or nothing: Spark's data source writer over a pooled client.

Each task opens one client, sends its rows to a segment of its own, and reports a receipt. The driver then publishes the
batch: one manifest, written under a temporary name and renamed, lists its segments. Readers take what manifests list, so a failed task or
job leaves no message, and a batch that runs again finds its manifest and drops what it has sent. Segments lie in a folder
that all executors reach (any file system that pyarrow opens by its address).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter

from millrace.stores import store

FORMAT = "millrace_outbox"


class SegmentClient:
    """A client that appends messages, one a line, to one segment; line ends inside a message are escaped."""

    def __init__(self, path: str, name: str):
        files, inner = store(path)
        files.create_dir(f"{inner}/segments", recursive=True)
        self.name, self.sent, self.sent_chars = name, 0, 0
        self.stream = files.open_output_stream(f"{inner}/segments/{name}")

    def send(self, message: str) -> None:
        self.stream.write(json.dumps(message, ensure_ascii=False).encode() + b"\n")
        self.sent += 1
        self.sent_chars += len(message)

    def close(self) -> None:
        self.stream.close()


@dataclass
class Receipt(WriterCommitMessage):
    segment: str
    sent: int
    sent_chars: int


class _Writer(DataSourceStreamWriter):
    def __init__(self, path: str, column: str):
        self.path, self.column = path, column

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        client = None
        try:
            for row in iterator:
                if row[self.column] is None:
                    continue
                client = client or SegmentClient(self.path, uuid.uuid4().hex)
                client.send(row[self.column])
        except BaseException:
            if client:
                client.close()
                _drop(self.path, [client.name])
            raise
        if client:
            client.close()
        return Receipt(client.name, client.sent, client.sent_chars) if client else Receipt("", 0, 0)

    def commit(self, messages: list[Receipt | None], batchId: int) -> None:
        receipts = [m for m in messages if m is not None and m.segment]
        files, inner = store(self.path)
        files.create_dir(f"{inner}/manifests", recursive=True)
        manifest = f"{inner}/manifests/{batchId:012d}.json"
        if files.get_file_info(manifest).type != fs.FileType.NotFound:  # published by an earlier attempt
            _drop(self.path, [r.segment for r in receipts])
            return
        hidden = f"{inner}/manifests/.{uuid.uuid4().hex}"
        lines = [{"batch": batchId, "segment": r.segment, "sent": r.sent, "sent_chars": r.sent_chars} for r in receipts]
        with files.open_output_stream(hidden) as out:
            out.write("".join(json.dumps(line) + "\n" for line in lines).encode())
        files.move(hidden, manifest)

    def abort(self, messages: list[Receipt | None], batchId: int) -> None:
        _drop(self.path, [m.segment for m in messages if m is not None and m.segment])


def _drop(path: str, segments: list[str]) -> None:
    files, inner = store(path)
    for segment in segments:
        if files.get_file_info(f"{inner}/segments/{segment}").type != fs.FileType.NotFound:
            files.delete_file(f"{inner}/segments/{segment}")


class OutboxSource(DataSource):
    """``writeStream.format("millrace_outbox")`` with the options ``path`` and ``column`` (a text column; null messages are left out)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        column = self.options.get("column", "value")
        if column not in schema.fieldNames():
            raise ValueError(f"no column {column!r} to send")
        return _Writer(self.options["path"], column)


def writer(df: DataFrame, col: str, path: str) -> DataStreamWriter:
    """A streaming write of a text column to the outbox at ``path``."""
    df.sparkSession.dataSource.register(OutboxSource)
    return df.select(col).writeStream.format(FORMAT).option("path", path).option("column", col)


def receipts(spark: SparkSession, path: str) -> DataFrame:
    """``batch, segment, sent, sent_chars`` of everything published."""
    return spark.read.schema("batch long, segment string, sent long, sent_chars long").json(f"{path}/manifests")


def messages(spark: SparkSession, path: str) -> DataFrame:
    """``batch, message`` of everything published; segments that no manifest lists are not read as messages."""
    lines = spark.read.text(f"{path}/segments").select(F.col("_metadata.file_name").alias("segment"), F.from_json(F.concat(F.lit('{"m":'), "value", F.lit("}")), "m string")["m"].alias("message"))
    return lines.join(receipts(spark, path).select("batch", "segment"), "segment").select("batch", "message")
