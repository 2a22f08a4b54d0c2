"""Column functions, cleaning and sources on hand-written rows."""

import datetime as dt
import gzip
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import clean, text, times, vectors
from millrace.operators import nulls, project
from millrace.sources import archives, dictionary, documents, envelope
from millrace.sources import text as text_source


def column(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"value {type_}")


def out(df):
    return [row[0] for row in df.collect()]


def test_tokens_keep_interior_and_drop_trailing_blanks(spark):
    df = column(spark, ["a b  ", "a  b", "", "   ", " a", None])
    assert out(df.select(text.tokens("value"))) == [["a", "b"], ["a", "", "b"], [""], [], ["", "a"], None]
    assert out(df.select(text.token_count("value"))) == [2, 3, 1, 0, 2, None]


def test_words_split_on_runs_and_keep_a_leading_empty_word(spark):
    df = column(spark, ["a \t b\n", "  a"])
    assert out(df.select(text.words("value"))) == [["a", "b"], ["", "a"]]


def test_small_map_translation(spark):
    df = column(spark, ["the  red house", "blue"])
    done = df.select(text.translate_words("value", {"red": "rot", "house": "haus"}))
    assert out(done) == ["the rot haus", "blue"]
    assert out(df.select(text.translate_words("value", {}))) == ["the red house", "blue"]


def test_phrases_match_in_any_order_and_case(spark):
    df = column(spark, ["Bike share in NYC", "nyc bike", "city"])
    assert out(df.select(text.matches_any_phrase("value", ["nyc bike share"]))) == [True, False, False]


def test_csv_line_keeps_empty_fields(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert out(df.select(text.csv_line("x", "y", "z"))) == ["a,,c"]


def test_base_name(spark):
    df = column(spark, ["file:/d/subject12.dat", "x.tar.gz", "plain"])
    assert out(df.select(text.base_name("value"))) == ["subject12", "x.tar", "plain"]


def test_empty_field_becomes_zero_only_when_asked(spark):
    names = [f.name for f in schemas.CDR.fields]
    raw = spark.createDataFrame([("5", "1383260400000", "39", "", "0.5", "", "x", "")], schemas.as_text(names))
    loose = clean.typed(raw, schemas.CDR).first()
    assert loose["smsInActivity"] is None and loose["callOutActivity"] is None
    ok = raw.withColumn("callOutActivity", F.lit(""))
    strict = clean.typed(ok, schemas.CDR, empty_as_zero=True).first()
    assert strict["smsInActivity"] == 0.0 and strict["countryCode"] == 39
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.typed(raw, schemas.CDR, empty_as_zero=True).collect()


def test_age_passes_other_text_through(spark):
    df = column(spark, ["1980", "\\N", ""])
    assert out(df.select(clean.age_or_text(F.col("value"), 2015))) == ["35", "\\N", ""]


def test_epoch_units_are_kept_apart(spark):
    millis = column(spark, [1383260400000], "long")
    assert out(millis.select(times.bucket_of_epoch_millis(F.col("value")))) == ["13-10-31|23"]
    seconds = column(spark, [1383260400], "long")
    assert out(seconds.select(times.day_of_epoch_seconds(F.col("value")))) == ["2013-10-31"]
    both = seconds.select(F.lit(1).alias("id"), "value")
    assert project.key_by_day_in_batches(both, "id", "value").collect() == [(1, "2013-10-31")]


def test_slice_predicate_covers_ten_or_eleven_channels(spark):
    row = [0.0] * 28 + [5.0] + [0.0] * 3
    df = spark.createDataFrame([(row,)], "v array<double>")
    ten, eleven = df.select(
        vectors.any_above(F.col("v"), 18, 10, 1.0), vectors.any_above(F.col("v"), 18, 11, 1.0)
    ).first()
    assert (ten, eleven) == (False, True)


def test_any_nan(spark):
    df = spark.createDataFrame([(1.0, float("nan")), (1.0, 2.0)], "a double, b double")
    assert out(df.select(clean.any_nan("a", "b"))) == [True, False]


def test_null_operators(spark):
    df = spark.createDataFrame([(None, 1), (0, None), (3, 3)], "a int, b int")
    assert nulls.drop_any(df).collect() == [(3, 3)]
    assert [r["a"] for r in nulls.replace(nulls.fill(df, 0, ["a"]), {0: 1}, ["a"]).collect()] == [1, 1, 3]


@pytest.mark.parametrize(
    "kind, line, want",
    [
        ("comma", "a,,b,,", ["a", "", "b"]),
        ("tab", "a\tb\t\t", ["a", "b"]),
        ("tab_all", "a\tb\t\t", ["a", "b", "", ""]),
        ("whitespace", "  a  b ", ["", "a", "b"]),
        ("blank", "a  b ", ["a", "", "b"]),
    ],
)
def test_delimited_lines(spark, kind, line, want):
    assert out(column(spark, [line]).select(text_source.fields(F.col("value"), kind))) == [want]


def test_positions_beyond_the_line_are_null(spark):
    df = text_source.positional(column(spark, ["a,b"]), "comma", {"first": 0, "tenth": 9})
    assert df.collect() == [("a", None)]


def test_malformed_and_reordered_json(spark):
    raw = column(spark, ['{"stars": 4, "attributes": {"Wi-Fi": "free"}}', '{"stars": 3}', "{oops"])
    rows = documents.parsed(raw, "value", schemas.BUSINESS).select("doc.attributes.Wi-Fi", "doc.stars")
    assert rows.collect() == [("free", 4.0), (None, 3.0), (None, None)]


def test_json_map_both_ways(spark):
    raw = column(spark, ['{"DE": "49", "FR": "33"}'])
    assert sorted(documents.json_map(raw, "value").collect()) == [("DE", "49"), ("FR", "33")]
    assert sorted(documents.json_map(raw, "value", swap=True).collect()) == [("33", "FR"), ("49", "DE")]


def test_multi_line_grid_document(spark, tmp_path):
    square = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]
    grid = {"features": [{"id": 7, "geometry": {"coordinates": [square]}}]}
    (tmp_path / "grid.json").write_text(json.dumps(grid, indent=2))
    assert documents.grid(spark, str(tmp_path)).collect() == [(7, 0, 0, 1, 0, 1, 1, 0, 1)]


def test_dictionary_comments_duplicates_and_encoding(spark, tmp_path):
    lines = ["# a comment", "house\told", " house \t Häuschen ", "dog\tHund", "broken"]
    (tmp_path / "German").write_bytes("\n".join(lines).encode("iso-8859-1"))
    rows = dictionary.dictionary(spark, str(tmp_path), "German").collect()
    assert sorted(rows) == [("dog", "Hund"), ("house", "Häuschen")]
    with pytest.raises(ValueError):
        dictionary.dictionary(spark, str(tmp_path), "Klingon")


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_translation_keeps_every_line(spark, threshold):
    rows = [(1, "red house red"), (2, "blue  car"), (3, None), (4, ""), (5, "red"), (5, "red house")]
    lines = spark.createDataFrame(rows, "id int, line string")
    words = spark.createDataFrame([("red", "rot"), ("house", "haus")], "word string, translation string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = project.translate(lines, "id", "line", words).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(got, key=repr) == [(1, "rot haus rot"), (2, "blue car"), (3, None), (4, ""), (5, "rot haus"), (5, "rot")]


def test_envelope_decodes_bytes(spark):
    df = spark.createDataFrame([(b"k", "Zürich".encode())], "key binary, value binary")
    assert envelope.payload(df).collect() == [("Zürich",)]


def test_archives_skip_headers_of_zip_and_gz_only(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("one.csv", "header\n1\n\n2\n")
        archive.writestr("two.csv", "header\n3")
        archive.writestr("empty.csv", "")
    for name in ("b", "c"):
        with gzip.open(tmp_path / f"{name}.csv.gz", "wt") as f:
            f.write(f"header\n{name}1\n\n{name}2\n")
    (tmp_path / "d.dat").write_text("d1\nd2\n")
    (tmp_path / "e.json").write_text('{"e": 1}\n')
    (tmp_path / "f.txt").write_text("ignored\n")
    rows = archives.lines(spark, str(tmp_path)).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r["file"], []).append(r["value"])
    assert by_file == {
        "a.zip": ["1", "", "2", "3"],
        "b.csv.gz": ["b1", "", "b2"],
        "c.csv.gz": ["c1", "", "c2"],
        "d.dat": ["d1", "d2"],
        "e.json": ['{"e": 1}'],
    }


def test_schema_from_json_file(spark, tmp_path):
    path = tmp_path / "schema.json"
    path.write_text(json.dumps(json.loads(schemas.CDR.json()), indent=1))
    assert schemas.from_json_file(spark, str(path)) == schemas.CDR


def test_parent_goes_into_each_child(spark):
    df = spark.createDataFrame(
        [("t1", [("A", 1), ("B", 2)]), ("t2", [])], "created string, quote array<struct<symbol: string, n: int>>"
    )
    assert project.explode_with_parent(df, ["created"], "quote").collect() == [("t1", "A", 1), ("t1", "B", 2)]


def test_instant_and_wall_round_trip(spark):
    moment = dt.datetime(2024, 1, 2, 3, 4, 5, 6)
    df = column(spark, [moment], "timestamp_ntz")
    assert out(df.select(times.wall(times.instant(F.col("value"))))) == [moment]


def test_csv_inference_and_rename(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("1\t2.5\ta\n2\t3.5\tb\n")
    df = text_source.tab_table(spark, str(tmp_path), ["i", "d", "s"])
    assert df.dtypes == [("i", "int"), ("d", "double"), ("s", "string")]
    assert os.path.exists(tmp_path)


def test_a_word_list_of_any_name(spark, tmp_path):
    (tmp_path / "Dutch").write_text("# words\nhuis\thouse\nhuis\thome\n", encoding="iso-8859-1")
    assert [tuple(r) for r in dictionary.dictionary(spark, str(tmp_path), "Dutch").collect()] == [("huis", "home")]
