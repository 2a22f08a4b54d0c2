"""Zip archives read entry by entry, against the standard library."""

import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.sources import zip_entries


def write(path, entries, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as archive:
        for name, body in entries.items():
            archive.writestr(name, body)


def want(path):
    out = []
    with zipfile.ZipFile(path) as archive:
        for entry in archive.infolist():
            if not entry.is_dir():
                with archive.open(entry) as raw:
                    text = io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline=None)
                    out += [(path.name, entry.filename, line.rstrip("\n")) for line in list(text)[1:]]
    return out


def test_many_entries_go_to_many_tasks(spark, tmp_path):
    draw = random.Random(1)
    line = lambda: "".join(draw.choice("abcdefé \t,") for _ in range(draw.randrange(40)))
    bodies = {f"d/{i}.csv": "header\n" + "\n".join(line() for _ in range(draw.randrange(300))) for i in range(40)}
    write(tmp_path / "one.zip", {"d/": "", **bodies, "empty.csv": "", "only.csv": "header", "crlf.csv": "h\r\na\r\n\r\nb\rc\r"})
    write(tmp_path / "two.zip", {"x": b"h\nbytes \xff\xfe\nend", "long.csv": "h\n" + "y" * (3 << 20) + "\nlast"}, zipfile.ZIP_STORED)
    (tmp_path / "no.txt").write_text("ignored")
    found = zip_entries.entries(spark, str(tmp_path))
    assert found.count() == 45
    lines = zip_entries.lines(found, task_bytes=8 << 10)
    assert sorted(map(tuple, lines.collect())) == sorted(want(tmp_path / "one.zip") + want(tmp_path / "two.zip"))
    used = lines.where("file = 'one.zip'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert used > 3  # more tasks than archives
    assert zip_entries.lines(found, header=False).where("value = 'header'").count() == 41


def test_damaged_encrypted_and_unknown_entries_are_errors(spark, tmp_path):
    write(tmp_path / "a.zip", {"one.csv": "header\n" + "abc\n" * 50}, zipfile.ZIP_STORED)
    data = bytearray((tmp_path / "a.zip").read_bytes())
    data[60] ^= 1
    (tmp_path / "a.zip").write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        zip_entries.lines(zip_entries.entries(spark, str(tmp_path))).collect()
    write(tmp_path / "a.zip", {"one.csv": "header\nabc"}, zipfile.ZIP_BZIP2)
    with pytest.raises(Exception, match="compression method"):
        zip_entries.lines(zip_entries.entries(spark, str(tmp_path))).collect()


def test_packing_and_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x", "1"), ("a", "y", "2"), ("b", "x", "3"), ("a", "x", "4")], "archive string, entry string, value string")
    packed = zip_entries.pack(rows, str(tmp_path / "out"), "archive", "entry").collect()
    assert sorted((r["path"].rsplit("/", 1)[-1], r["rows"]) for r in packed) == [("a.zip", 3), ("b.zip", 1)]
    got = sorted(map(tuple, zip_entries.lines(zip_entries.entries(spark, str(tmp_path / "out"))).collect()))
    assert got == [("a.zip", "x.csv", "1"), ("a.zip", "x.csv", "4"), ("a.zip", "y.csv", "2"), ("b.zip", "x.csv", "3")]
    (tmp_path / "none").mkdir()
    assert zip_entries.lines(zip_entries.entries(spark, str(tmp_path / "none"))).collect() == []


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_lines_across_pieces(size):
    data = b"h\na\r\nb\rc\n\n\r\nlast"
    pieces = (data[i : i + size] for i in range(0, len(data), size))
    assert [v for part in zip_entries._lines(pieces, True) for v in part] == ["a", "b", "c", "", "", "last"]


def test_never_more_tasks_than_entries(spark, tmp_path):
    write(tmp_path / "a.zip", {f"{i}.csv": "header\n" + "\n".join(str(j * 7919 % 10007) for j in range(2000)) for i in range(3)})
    lines = zip_entries.lines(zip_entries.entries(spark, str(tmp_path)), task_bytes=64)
    assert lines.rdd.getNumPartitions() <= 3 and lines.count() == 6000
