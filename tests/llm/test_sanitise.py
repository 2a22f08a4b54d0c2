"""Personal data and disclosing terms against Python's regular expressions and plain counts."""

import hashlib
import math
import re
from collections import defaultdict

from pyspark.sql import functions as F

from millrace.llm import sanitise

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(number))) % 10 == 0


def good(kind, value):
    number = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    return {"email": True, "card": 12 <= len(number) <= 19 and luhn(number), "phone": 9 <= len(number) <= 15}[kind]


def base(text):
    found = [(m.start(), rank, m.end(), kind, m[0]) for rank, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text) if good(kind, m[0])]
    return sorted(found)


def telling(texts, support=sanitise.SUPPORT, threshold=sanitise.THRESHOLD):
    """The terms that give a value away, by counting every passage."""
    cut = lambda t: [p for p in re.split(r"[.!?]+[ \t-\r]+|[\n-\r]+", t) if p]
    terms = lambda p: {t.lower() for t in re.findall(r"[\w'-]+", p)} | {"#"} | ({"#number"} if re.search("[0-9]", p) else set())
    every = {p for t in texts for p in cut(t)}
    both, own = defaultdict(set), defaultdict(set)
    for p in {p for t in texts if base(t) for p in cut(t)}:
        rest = p
        for pattern in (BASE["email"], BASE["phone"], BASE["ip"], r"[0-9]([\x20-]?[0-9]){11,}"):
            rest = re.sub(pattern, " ", rest)
        for _, _, _, kind, v in base(p):
            value = kind + (v.lower() if kind == "email" else v if kind == "ip" else re.sub("[^0-9]", "", v))
            own[value].add(p)
            for t in terms(rest) & terms(p):
                both[value, t].add(p)
    out = set()
    for (value, t), seen in both.items():
        if len(seen) >= support and not t.startswith("#") and len(own[value]) < len(every):
            n = sum(t in terms(p) for p in every)
            if round(math.log(len(every) * len(seen) / (n * len(own[value]))) / math.log(len(every) / len(own[value])), 9) >= threshold:
                out.add(t)
    return out


def expected(texts):
    told, out = telling(texts), []
    for text in texts:
        own = base(text)
        more = [(m.start(), 4, m.end(), "term") for m in re.finditer(r"[\w'-]+", text) if m[0].lower() in told]
        more = [m for m in more if not any(b[0] < m[2] and m[0] < b[2] for b in own)]
        listed = [",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(x)) for x in ([b[:4] for b in own], [b[:4] for b in own] + more)]
        out.append((hashlib.sha256(listed[0].encode()).hexdigest(), listed[1]))
    return out


ODD = [
    None, "", "a@b", "a@b.c_x@d.e", "x@y@z.com été a.b%c+d-e@f-g.h.i! 中文@q.r", "1.2.3.4.5 300.1.1.1 1.2.3.4", "255.255.255.255 0001.2.3.00000255 256.0.0.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111 4111111111111111 ", "+1 (017) 555-7713.", "+49 30 1234567890123456 +12", "++1 234 567 89 01-",
    "4242 4242 4242 4242", "+4242 4242 4242 4242", "1" * 30_000, "a" * 50_000 + "@", "x@y.z" * 300, "(" * 5000 + "+1" + "(" * 5000, "0.0.0.0" * 9, "1-2 3--4  5",
]


def run(df):
    found = sanitise.sanitise(df)
    return found.select("doc_id", F.sha2(sanitise.listed(F.col("base")), 256).alias("b"), sanitise.listed(F.col("spans")).alias("s"))


def test_base_spans_of_odd_texts(spark, nothing):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, ODD[4]), (None, ODD[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in "row start base h g n kind term at".split()])
    want = expected([t or "" for _, t in rows])
    assert sorted(map(tuple, run(df).collect()), key=repr) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=repr)
    assert run(nothing).collect() == []


def test_screening_changes_nothing(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(people())), "doc_id long, text string")
    want = sorted(map(tuple, run(df).collect()))
    monkeypatch.setattr(sanitise, "SLICES", 1)
    assert sorted(map(tuple, run(df).collect())) == want


def test_whole_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], expected([r.text or "" for r in docs])))
    assert {r.doc_id: (r.b, r.s) for r in run(spark.read.parquet(f"{sf}/documents.parquet")).collect()} == want


def people():
    """Everyday lines, and one person whose byname stands beside an address in most places."""
    things = "dog cat man child cook barn shop lake mill road tree hill farm town yard gate wall path ship well".split()
    plain = [f"The {a} walks to the {b}. It rains in the {a}!" for a in things for b in things if a != b]
    told = [f"Write to {who} at bo.ek@mail1.example.com {how}." for who, how in (("Quillon", "today"), ("quillon", "again"), ("Quillon", "by noon"), ("Quillon", "at 7 or 8"))]
    return plain + told + ["Nobody has seen Quillon in the barn.", told[0], "Unit 77x sits by 10.0.0.1 and runs.\nUnit 77x, on 10.0.0.1 too.\n77x is 10.0.0.1!\nThe barn"]


def test_terms_that_give_a_value_away(spark):
    texts = people()
    assert telling(texts) == {"quillon", "write", "at", "77x"}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = expected(texts)
    found = {r.doc_id: (r.b, r.s) for r in run(df).collect()}
    assert found == dict(enumerate(want))
    assert want[384][1] == "term:16:23" and want[0][1] == ""
    both = sanitise.sanitise(df).withColumnRenamed("doc_id", "id").join(df, F.col("id") == F.col("doc_id"))
    clean = {r.doc_id: r.clean for r in both.select("doc_id", sanitise.redacted(F.col("text"), F.col("spans")).alias("clean")).collect()}
    assert clean[0] == texts[0] and clean[384] == "Nobody has seen [word] in the barn."
    assert clean[380] == "[word] to [word] [word] [email] today." and clean[386].startswith("Unit [number] sits by [ip] and runs.")


def test_redaction_of_spans_inside_spans(spark):
    text = "call +4242 4242 4242 4242 now"  # a card inside a phone number that is none
    df = spark.createDataFrame([(1, text), (2, "é +1 234 567 8901 é"), (3, "")], "doc_id long, text string")
    both = sanitise.sanitise(df).withColumnRenamed("doc_id", "id").join(df, F.col("id") == F.col("doc_id"))
    got = {r.doc_id: r.clean for r in both.select("doc_id", sanitise.redacted(F.col("text"), F.col("spans")).alias("clean")).collect()}
    assert got == {1: "call +[card] now", 2: "é [phone] é", 3: ""}
