"""Zip archives entry by entry: a large archive is read by many tasks, each by ranges.

One task per group of archives reads their central directories only. The entries, rows of a few numbers, are then dealt out by their compressed
size, and each is inflated as a stream from its own place in the archive. Neither an archive nor an entry is ever held whole.
"""

from __future__ import annotations

import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.stores import store

ENTRY = "path string, entry string, at long, packed long, size long, method int, crc long"
#: Compressed bytes a task reads, about, and bytes it asks for at once.
TASK_BYTES, READ_BYTES = 128 << 20, 1 << 20
_LOCAL_HEADER, _SIGN = "<4s22xHH", b"PK\x03\x04"


def _directories(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in ENTRY.split(", ")]
    for batch in batches:
        for path in batch.column("path").to_pylist():
            files, inner = store(path)
            with files.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
                entries = [e for e in archive.infolist() if not e.is_dir()]
            locked = [e.filename for e in entries if e.flag_bits & 1]
            if locked:
                raise ValueError(f"{path}: entry {locked[0]!r} is encrypted")
            columns = [
                [path] * len(entries), [e.filename for e in entries], [e.header_offset for e in entries], [e.compress_size for e in entries],
                [e.file_size for e in entries], [e.compress_type for e in entries], [e.CRC for e in entries],
            ]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def entries(spark: SparkSession, directory: str) -> DataFrame:
    """``path, entry, at, packed, size, method, crc`` of every entry of the zip files in a directory; folders are none."""
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(directory).select("path")
    return archives.mapInArrow(_directories, ENTRY)


def _inflated(path: str, at: int, packed: int, method: int, crc: int, entry: str) -> Iterator[bytes]:
    """The entry's bytes in pieces, checked at the end."""
    if method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise ValueError(f"{path}: entry {entry!r} has compression method {method}")
    files, inner = store(path)
    seen, inflate = 0, zlib.decompressobj(-15) if method == zipfile.ZIP_DEFLATED else None
    with files.open_input_file(inner) as raw:
        raw.seek(at)
        head = struct.calcsize(_LOCAL_HEADER)
        sign, name, extra = struct.unpack(_LOCAL_HEADER, raw.read(head))
        if sign != _SIGN:
            raise ValueError(f"{path}: no entry at {at}")
        raw.seek(at + head + name + extra)
        while packed > 0:
            part = raw.read(min(READ_BYTES, packed))
            if not part:
                raise EOFError(f"{path}: entry {entry!r} is cut off")
            packed -= len(part)
            while part:
                out = inflate.decompress(part, READ_BYTES) if inflate else part
                part = inflate.unconsumed_tail if inflate else b""
                seen = zlib.crc32(out, seen)
                yield out
        if inflate:
            out = inflate.flush()
            seen = zlib.crc32(out, seen)
            yield out
    if seen != crc:
        raise ValueError(f"{path}: entry {entry!r} is damaged")


def _lines(pieces: Iterator[bytes], header: bool) -> Iterator[list[str]]:
    """Lists of whole lines; a line ends with ``\\n``, ``\\r\\n`` or ``\\r``."""
    rest, skip = b"", 1 if header else 0
    for piece in pieces:
        rest += piece
        # a return at the end may be half of a line end
        cut = max(rest.rfind(b"\n"), rest.rfind(b"\r", 0, len(rest) - 1)) + 1
        if cut:
            found = rest[:cut].decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n").split("\n")[:-1]
            rest = rest[cut:]
            dropped, skip = found[skip:], max(0, skip - len(found))
            if dropped:
                yield dropped
    if rest:
        found = rest.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n").split("\n")
        found = found[:-1] if rest[-1:] == b"\r" else found
        if found[skip:]:
            yield found[skip:]


def lines(found: DataFrame, header: bool = True, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``file, entry, value``: the lines of the entries, without each one's first line.

    Entries are dealt to tasks of about ``task_bytes`` compressed bytes, so an archive of many entries is read by many tasks; one entry is read by one, since
    deflated data has no places to begin at. So there are never more tasks than entries.
    """
    total, number = found.agg(F.sum("packed"), F.count(F.lit(1))).first()
    tasks = max(1, min(number, -(-(total or 0) // task_bytes)))
    dealt = found.repartition(tasks, "path", "entry", "at") if tasks > 1 else found.coalesce(1)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pieces = _inflated(row["path"], row["at"], row["packed"], row["method"], row["crc"], row["entry"])
                for held in _lines(pieces, header):
                    name = row["path"].rsplit("/", 1)[-1]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in ([name] * len(held), [row["entry"]] * len(held), held)], ["file", "entry", "value"])

    return dealt.mapInArrow(read, "file string, entry string, value string")


def pack(df: DataFrame, directory: str, archive: str, entry: str, col: str = "value") -> DataFrame:
    """Write lines into zip files named by ``archive``, one entry for each value of ``entry``, with a header line; returns ``path, rows``.

    An archive is written by one task, entry by entry, from rows sorted by archive and entry.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, inner = store(directory)
        files.create_dir(inner, recursive=True)
        held: dict = {"archive": None}

        def done() -> Iterator[pa.RecordBatch]:
            if held["archive"] is not None:
                held["out"].close()
                held["zip"].close()
                held["raw"].close()
                files.move(f"{inner}/.{held['archive']}.part", f"{inner}/{held['archive']}.zip")
                yield pa.RecordBatch.from_arrays([pa.array([f"{inner}/{held['archive']}.zip"]), pa.array([held["rows"]])], ["path", "rows"])

        for batch in batches:
            names, parts, values = (batch.column(k).to_pylist() for k in range(3))
            # runs of one entry are written at once
            starts = [k for k in range(len(names)) if not k or names[k] != names[k - 1] or parts[k] != parts[k - 1]]
            for low, high in zip(starts, [*starts[1:], len(names)]):
                name, part = names[low], parts[low]
                if name != held["archive"]:
                    yield from done()
                    raw = files.open_output_stream(f"{inner}/.{name}.part")
                    held = {"archive": name, "raw": raw, "zip": zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED), "entry": None, "rows": 0}
                if part != held["entry"]:
                    if held["entry"] is not None:
                        held["out"].close()
                    held["entry"], held["out"] = part, held["zip"].open(f"{part}.csv", "w")
                    held["out"].write(b"header\n")
                held["out"].write(("\n".join(values[low:high]) + "\n").encode())
                held["rows"] += high - low
        yield from done()

    rows = df.select(F.col(archive).cast("string").alias("a"), F.col(entry).cast("string").alias("e"), F.col(col).cast("string").alias("v"))
    return rows.repartition("a").sortWithinPartitions("a", "e").mapInArrow(write, "path string, rows long")
