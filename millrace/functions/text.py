"""Column expressions on text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Text = Column | str


def _col(c: Text) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: Text) -> Column:
    """Split on single blanks, keep interior empty tokens, drop trailing ones.

    The empty string is one (empty) token; a string of blanks only has none.
    """
    body = _col(text)
    kept = F.rtrim(body)
    return (
        F.when(body == "", F.array(F.lit("")))
        .when(kept == "", F.array().cast("array<string>"))
        .otherwise(F.split(kept, " "))
    )


def words(text: Text) -> Column:
    """Split on runs of white space; leading white space gives one empty word."""
    return F.split(F.regexp_replace(_col(text), r"\s+$", ""), r"\s+")


def token_count(text: Text) -> Column:
    """``size(tokens(text))`` without building the array: blanks left after the trim, plus one."""
    body = _col(text)
    kept = F.rtrim(body)
    blanks = F.length(kept) - F.length(F.replace(kept, F.lit(" "), F.lit("")))
    return F.when((kept == "") & (body != ""), F.lit(0)).otherwise(blanks + 1)


def translate_words(text: Text, dictionary: Mapping[str, str]) -> Column:
    """Replace known words through a small in-plan map; see ``operators.project`` for large ones."""
    pairs = [F.lit(part) for item in dictionary.items() for part in item]
    lookup = F.create_map(*pairs) if pairs else F.expr("cast(map() as map<string, string>)")
    return F.array_join(F.transform(words(text), lambda w: F.coalesce(lookup[w], w)), " ")


def matches_any_phrase(text: Text, phrases: Iterable[str]) -> Column:
    """True where all words of one phrase occur, in any order and case."""
    wanted = [p.lower().split() for p in phrases]

    def matches(present: Column) -> Column:
        phrase = lambda ws: reduce(lambda a, b: a & b, [F.array_contains(present, w) for w in ws])
        return reduce(lambda a, b: a | b, map(phrase, wanted))

    # a lambda variable, so the text is split once, not once per word
    return F.transform(F.array(F.split(F.lower(_col(text)), r"\s+")), matches)[0]


def csv_line(*cols: Text) -> Column:
    """Comma-joined values; a null becomes an empty field instead of vanishing."""
    return F.concat_ws(",", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])


def joined_key(*cols: Text) -> Column:
    return F.concat_ws(":", *[_col(c).cast("string") for c in cols])


def base_name(path: Text) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(F.regexp_replace(_col(path), r"^.*/", ""), r"\.[^.]*$", "")
