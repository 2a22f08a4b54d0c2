"""A directory of archives as lines: zip, gz, dat and json files.

The first line of a zip entry or a gz file is a header and is skipped; dat and
json files are read whole; files of any other type are ignored.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LINES = "file string, value string"
_BATCH_LINES = 10_000


def _unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            name = path.as_py().rsplit("/", 1)[-1]
            with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                for entry in archive.infolist():
                    if entry.is_dir():
                        continue
                    with archive.open(entry) as raw:
                        text = io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline=None)
                        next(text, None)
                        held: list[str] = []
                        for line in text:
                            held.append(line.rstrip("\n"))
                            if len(held) == _BATCH_LINES:
                                yield pa.record_batch([[name] * len(held), held], ["file", "value"])
                                held = []
                        if held:
                            yield pa.record_batch([[name] * len(held), held], ["file", "value"])


def unzipped(files: DataFrame) -> DataFrame:
    """Lines of zip archives given as ``(path, content)`` rows, the shape of the binary file
    source. An entry is read as a stream, so only the compressed archive is held in memory."""
    return files.select("path", "content").mapInArrow(_unzip, _LINES)


def _without_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column("file")
        first = pa.array([files[0].as_py() == last])
        last = files[-1].as_py()
        yield batch.filter(pa.concat_arrays([first, pc.equal(files[1:], files[:-1])]))


def gzipped(spark: SparkSession, directory: str) -> DataFrame:
    """Lines of the gz files without each file's first line. A gz file cannot be split, so its
    lines arrive in order in one partition and the first one is where the file name changes."""
    raw = spark.read.option("pathGlobFilter", "*.gz").text(directory)
    tagged = raw.select(F.col("_metadata.file_name").alias("file"), "value")
    return tagged.mapInArrow(_without_headers, _LINES)


def plain(spark: SparkSession, directory: str) -> DataFrame:
    raw = spark.read.option("pathGlobFilter", "*.{dat,json}").text(directory)
    return raw.select(F.col("_metadata.file_name").alias("file"), "value")


def lines(spark: SparkSession, directory: str) -> DataFrame:
    """(file, value) over every readable file of the directory."""
    zips = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(directory)
    )
    return (
        unzipped(zips).unionByName(gzipped(spark, directory)).unionByName(plain(spark, directory))
    )


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            body = "\n".join(["header", *batch.column("value").to_pylist()]) + "\n"
            archive.writestr("part.csv", body)
        content = out.getvalue()
        yield pa.record_batch(
            [[f"archive-{zlib.crc32(content):08x}.zip"], [content]],
            schema=pa.schema([("path", pa.string()), ("content", pa.binary())]),
        )


def zipped(df: DataFrame) -> DataFrame:
    """Pack a ``value`` column into archives of one Arrow batch each, as ``(path, content)`` rows."""
    return df.select("value").mapInArrow(_zip, "path string, content binary")
