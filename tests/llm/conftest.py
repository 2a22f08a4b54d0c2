import random

import pytest

#: columns that operators use inside, to clash with
EXTRA = "row size n chunk src source_size target taken label score cell key region doc lot slot ids keep_id kept".split()


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdeilmnorst") for _ in range(draw.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, near copies and shared passages."""
    passage, base = words(1, 40), words(2, 120)
    edited = base.split()
    edited[60] = "changed"
    rows = [
        (1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, " ".join(edited), "en", "b"),
        (4, words(3, 30) + " " + passage + " " + words(4, 10), None, "b"),
        (5, passage + "\n" + words(5, 25), "fr", None), (6, words(6, 5) + "\t" + passage, "fr", "c"),
        (7, None, "en", "a"), (8, "", "en", None), (9, " \n\t ", None, "a"), (10, "two words", "en", "c"), (11, "Two  words", "en", "c"),
        (None, words(7, 60), "en", "a"), (None, None, None, None),
        (12, words(8, 50), "en", "a"), (12, words(8, 50), "en", "a"),
        (13, "été 中文\x00 nul " + words(9, 30), "fr", "d"),
        (14, words(10, 40_000), "en", "long"), (15, "again and again " * 400, "en", "a"), (16, "x" * 3000, "en", "e"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with extra columns of clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in odd_rows], schema)
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("extra").alias(c) for c in EXTRA])


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture
def small_chunks(monkeypatch):
    from millrace.llm import chunks

    monkeypatch.setattr(chunks.store, "__defaults__", ("doc_id", "text", 2000))
