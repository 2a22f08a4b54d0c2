r"""Personal data and the terms that give it away, with DataFrame operations only.

1. **Base**: e-mail and IP addresses, card and phone numbers, by pattern and check (``base_spans``).
2. **Evidence**: a text is read as passages (sentences and lines); a passage that occurs again, in a copy, counts once. For every
   protected value and every term beside it in a passage, the distinct passages with both are counted, and for these terms
   the distinct passages of the whole corpus that hold them.
3. **Disclosure** of a value e by a term t is the share of the information in e that t gives away: the pointwise mutual
   information ``log(N n(t,e) / (n(t) n(e)))`` over the information content ``log(N / n(e))``. It is 1 for a term found beside e alone.
4. A term with a disclosure of ``threshold`` or more for any value, and ``support`` passages to show it, is a span wherever
   it occurs. It is generalised to its class (``[word]`` or ``[number]``) where the class itself stays below the threshold
   for that value, else removed.

Counts are combinable aggregates over hashes, so a value or a term in a third of all rows is spread over tasks. Places in a text are
sums over its matches in order, so a long text is a longer sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.scratch import new_dir

KINDS = ("email", "ip", "card", "phone")

#: The contract's patterns, matched in one way only: what follows a repetition cannot be part of it, so it need not be given
#: back, and a match cannot begin inside a run that an earlier start would have taken whole (but where a match has just ended). So a
#: long run of letters or digits costs one pass and no stack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
#: What a text has at least where a pattern can match.
_SIGN = {"email": "@", "ip": ".", "phone": "+"}

#: What is taken out of a passage before its terms are read: as above, but for numbers too short for a card.
_HIDDEN = (PATTERNS["email"], PATTERNS["phone"], PATTERNS["ip"], r"[0-9](?:[\x20-]?[0-9]){11,}+")

PASSAGE_END = r"[.!?]+[\x20\x09-\x0D]+|[\x0A-\x0D]+"
TERM = r"[\p{L}\p{N}_'-]+"
SUPPORT, THRESHOLD = 3, 0.95
#: Terms are screened on the passages of one in so many hashes.
SLICES = 64

_EVERY, _WORD, _NUMBER = "#", "#word", "#number"  # no term has this sign
_KEY = ("doc_id", "h", "g", "n")
_SPAN = ("start", "rank", "end", "kind", "value", "action", "reached")


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def placed(matched: DataFrame, pattern: str, found: str, keys: tuple[str, ...]) -> DataFrame:
    """``keys, start, end, value`` (code points) of every match in the array ``found``; ``keys`` name one row of ``matched``, which
    has the ``text``.
    """
    gaps = F.transform(F.split("text", pattern, -1), lambda x: F.length(x).cast("bigint"))
    zipped = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))
    each = matched.where(F.size(found) > 0).select(*keys, F.posexplode(zipped).alias("at", "match"))
    each = each.select(*keys, "at", "match.gap", "match.value").withColumn("length", F.length("value").cast("bigint"))
    upto = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(upto)
    return each.withColumn("end", end).select(*keys, (F.col("end") - F.col("length")).alias("start"), "end", "value")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    back = F.reverse(number)

    def worth(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits(value)).between(12, 19), luhn(digits(value))).otherwise(False)
    return F.length(digits(value)).between(9, 15)


def _matches(text: Column, kind: str) -> Column:
    all_of = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), 0)
    return F.when(F.contains(text, F.lit(_SIGN[kind])), all_of).otherwise(F.array().cast("array<string>")) if kind in _SIGN else all_of


def _stored(texts: DataFrame) -> DataFrame:
    """The rows by number and key; those with a match of any kind keep their text and what matched."""
    matched = texts.withColumns({kind: _matches(F.col("text"), kind) for kind in KINDS})
    any_match = F.greatest(*[F.size(kind) for kind in KINDS]) > 0
    return _saved(
        matched.select(
            F.monotonically_increasing_id().alias("row"), *_key(),
            *[F.when(F.size(kind) > 0, F.col(kind)).alias(kind) for kind in KINDS],
            F.when(any_match, F.col("text")).alias("text"),
        ),
        "sanitise-matches",
    )


def _key() -> list[Column]:
    """What tells a text from others with little chance of error; rows alike in it are alike in their spans."""
    return [F.col("doc_id"), F.xxhash64("text").alias("h"), F.xxhash64(F.lit(7), "text").alias("g"), F.length("text").alias("n")]


def base_spans(stored: DataFrame) -> DataFrame:
    """``row, start, rank, end, kind, value`` of all matches that pass their check."""
    spans = None
    for rank, kind in enumerate(KINDS):
        own = placed(stored, PATTERNS[kind], kind, ("row",)).where(valid(kind, F.col("value")))
        own = own.select("row", "start", F.lit(rank).alias("rank"), "end", F.lit(kind).alias("kind"), "value", F.lit("remove").alias("action"))
        spans = own if spans is None else spans.unionByName(own)
    return _saved(spans, "sanitise-base")


def _protected(passage: Column) -> Column:
    """The values of a passage in one form each."""

    def own(kind: str) -> Column:
        alike = {"email": F.lower, "ip": F.trim}.get(kind, digits)
        good = F.filter(_matches(passage, kind), lambda v: valid(kind, v))
        return F.transform(good, lambda v: F.concat(F.lit(f"{kind}:"), alike(v)))

    return F.array_distinct(F.concat(*map(own, KINDS)))


def _passages(texts: DataFrame) -> DataFrame:
    return texts.select(F.explode(F.split("text", PASSAGE_END, -1)).alias("passage")).where("passage <> ''")


def _terms(passage: Column) -> Column:
    """The terms of a passage, the sign of the passage itself, and those of the classes it has a letter or a digit of."""
    signs = F.array(F.lit(_EVERY), F.when(passage.rlike(r"\p{L}"), F.lit(_WORD)), F.when(passage.rlike("[0-9]"), F.lit(_NUMBER)))
    return F.concat(F.regexp_extract_all(F.lower(passage), F.lit(TERM), 0), F.array_compact(signs))


def _class(term: Column) -> Column:
    return F.when(term.rlike("[0-9]"), F.lit(_NUMBER)).otherwise(F.lit(_WORD))


def _is_term() -> Column:
    return ~F.col("term").startswith("#")


def pairs(texts: DataFrame) -> DataFrame:
    """``value, term, both``: the distinct passages that hold a protected value and a term outside of all values."""
    entities = _passages(texts).select("passage", _protected(F.col("passage")).alias("values")).where(F.size("values") > 0)
    rest = F.col("passage")
    for pattern in _HIDDEN:
        rest = F.regexp_replace(rest, pattern, " ")
    terms = F.array_intersect(_terms(rest), _terms(F.col("passage")))  # no remains of a word
    seen = entities.select(F.xxhash64("passage").alias("h"), "values", F.explode(terms).alias("term"))
    return seen.select("h", F.explode("values").alias("value"), "term").groupBy("value", "term").agg(F.count_distinct("h").alias("both"))


def _passages_with(hashed: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, n``: the distinct passages with each of ``terms``."""
    every = hashed.select("h", F.explode(_terms(F.col("passage"))).alias("term"))
    return every.join(terms, "term", "left_semi").groupBy("term").agg(F.count_distinct("h").alias("n"))


def _possible(hashed: DataFrame, found: DataFrame, of_value: DataFrame, characters: int, threshold: float) -> DataFrame:
    """The terms of ``found`` that are not yet known to stay below the threshold; signs are all kept.

    A disclosure of ``threshold`` needs ``n(t) <= n(t,e) (N / n(e)) ** (1 - threshold)``. There are no more passages than characters, and a term
    has at least the passages it has in a slice of them, so common words go out after a look at one slice.
    """
    most = F.col("both") * F.pow(F.lit(float(characters)) / F.col("n_value"), F.lit(1 - threshold)) * (1 + 1e-6)
    allowed = found.where(_is_term()).join(of_value, "value").groupBy("term").agg(F.max(most).alias("most"))
    sliced = _passages_with(hashed.where(F.pmod("h", F.lit(SLICES)) == 0), found.select("term").distinct())
    over = sliced.join(allowed, "term").where(F.col("n") > F.col("most")).select("term")
    return _saved(found.select("term").distinct().join(over, "term", "left_anti"), "sanitise-possible")


def disclosing_terms(texts: DataFrame, protected: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """``term, disclosure, action`` of the terms that give away a protected value.

    ``texts`` and ``protected`` have a column ``text``: all texts, and those that hold protected values.
    """
    found = _saved(pairs(protected).where(F.col("both") >= support), "sanitise-pairs")
    if found.where(_is_term()).isEmpty():
        return texts.sparkSession.createDataFrame([], "term string, disclosure double, action string")
    hashed = _passages(texts).select("passage", F.xxhash64("passage").alias("h"))
    of_value = found.where(F.col("term") == _EVERY).select("value", F.col("both").alias("n_value"))
    possible = _possible(hashed, found, of_value, texts.agg(F.sum(F.length("text"))).first()[0] or 1, threshold)
    of_term = _saved(_passages_with(hashed, possible), "sanitise-terms")
    total = of_term.where(F.col("term") == _EVERY).first()["n"]
    told = F.log(F.lit(float(total)) * F.col("both") / (F.col("n") * F.col("n_value")))
    known = F.log(F.lit(float(total)) / F.col("n_value"))
    judged = found.join(of_term, "term").join(of_value, "value").where(F.col("n_value") < total)
    judged = judged.select("value", "term", F.round(told / known, 9).alias("disclosure")).where(F.col("disclosure") >= threshold)
    classes = judged.where(F.col("term").isin(_WORD, _NUMBER)).select("value", F.col("term").alias("class"), F.lit(True).alias("told"))
    by_value = judged.where(_is_term()).withColumn("class", _class(F.col("term"))).join(classes, ["value", "class"], "left")
    return by_value.groupBy("term").agg(
        F.max("disclosure").alias("disclosure"),
        F.when(F.max(F.coalesce("told", F.lit(False))), F.lit("remove")).otherwise(F.lit("generalise")).alias("action"),
    )


def term_spans(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Key and span of every occurrence of a disclosing term; texts of one key count once."""
    keyed = texts.select(*_key(), "text")
    own = keyed.select(*_KEY, F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TERM), 0)).alias("term"))
    hits = own.join(found.select("term"), "term", "left_semi").select(*[F.col(c).alias(f"_{c}") for c in _KEY]).distinct()
    hits = _saved(hits, "sanitise-hits")  # of known size, so that no text is moved where they are few
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    for c in _KEY[1:]:
        same = same & (F.col(c) == F.col(f"_{c}"))
    held = keyed.join(hits, same, "left_semi").dropDuplicates(list(_KEY)).withColumn("all", F.regexp_extract_all("text", F.lit(TERM), 0))
    spans = placed(held, TERM, "all", _KEY).withColumn("term", F.lower("value")).join(found.select("term", "action"), "term")
    return spans.select(*_KEY, "start", F.lit(len(KINDS)).alias("rank"), "end", F.lit("term").alias("kind"), "value", "action")


def sanitise(
    docs: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, and ``base`` and ``spans``, arrays of ``(start, rank, end, kind, value, action, reached)``.

    Both are by start, then kind. ``spans`` holds the base and the terms (kind ``term``) that disclose a protected value; a term that
    touches the base is part of it already. ``reached`` is the end of what the spans before cover. A null or empty text has
    no spans; a null or repeated id is an id like others; equal passages count once as evidence; an empty table gives no rows. A
    value in every passage has no information to give away. The spans of one document come together in one row.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    stored = _stored(texts)
    base = base_spans(stored)
    protected = stored.join(base.select("row").distinct(), "row", "left_semi").select("text")
    found = _saved(disclosing_terms(texts, protected, support, threshold), "sanitise-disclosing")
    spans = base.withColumn("base", F.lit(True))
    if not found.isEmpty():
        added = _saved(term_spans(texts, found), "sanitise-added")
        rows = stored.select("row", *[F.col(c).alias(f"_{c}") for c in _KEY])
        same = F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        for c in _KEY[1:]:
            same = same & (F.col(c) == F.col(f"_{c}"))
        added = added.join(rows, same).select("row", "start", "rank", "end", "kind", "value", "action", F.lit(False).alias("base"))
        # a term that the base before it reaches into, or that reaches into the base after it, is no span of its own
        ordered = Window.partitionBy("row").orderBy("start", "rank")
        before, after = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(1, Window.unboundedFollowing)
        spans = spans.unionByName(added).withColumn("last", F.max(F.when(F.col("base"), F.col("end"))).over(before))
        spans = spans.withColumn("next", F.min(F.when(F.col("base"), F.col("start"))).over(after))
        spans = spans.where("base OR (coalesce(last, 0) <= start AND coalesce(next, end) >= end)").drop("last", "next")
    earlier = Window.partitionBy("row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("reached", F.coalesce(F.max("end").over(earlier), F.lit(0).cast("bigint")))
    listed = spans.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(F.col("base"), F.struct(*_SPAN)))).alias("base"), F.sort_array(F.collect_list(F.struct(*_SPAN))).alias("spans")
    )
    empty = F.array().cast(listed.schema["spans"].dataType)
    return stored.select("row", "doc_id").join(listed, "row", "left").select(
        "doc_id", F.coalesce("base", empty).alias("base"), F.coalesce("spans", empty).alias("spans")
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text without its spans: base values and generalised terms leave their kind in brackets, removed terms nothing."""

    def mark(span: Column) -> Column:
        name = F.when(span["kind"] != "term", span["kind"]).when(span["action"] == "generalise", F.substring(_class(F.lower(span["value"])), 2, 9))
        return F.coalesce(F.concat(F.lit("["), name, F.lit("]")), F.lit(""))

    def piece(span: Column) -> Column:
        before = F.substring(text, (span["reached"] + 1).cast("int"), F.greatest(span["start"] - span["reached"], F.lit(0)).cast("int"))
        # a span that begins inside an earlier one leaves no mark of its own
        return F.concat(before, F.when(span["start"] >= span["reached"], mark(span)).otherwise(F.lit("")))

    last = F.coalesce(F.array_max(F.transform(spans, lambda s: s["end"])), F.lit(0))
    return F.concat(F.array_join(F.transform(spans, piece), ""), F.substring(text, (last + 1).cast("int"), F.length(text)))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
