"""The classifier, the language model and the benchmark search."""

import math
import re
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import maxent, quality, templates
from millrace.llm import text as T

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def held(doc, folds, rest):
    return doc is not None and zlib.crc32(str(doc).encode()) % folds == rest


def test_trees_separate_and_score_like_a_walk():
    draw = np.random.default_rng(1)
    rows = draw.normal(size=(3000, 5)).astype(np.float32)
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 3] < -0.2)).astype(float)
    trees = quality.fit(rows[:2000], labels[:2000])
    scores = trees.score(rows[2000:])
    assert ((scores > 0.5) == labels[2000:]).mean() > 0.97
    margin = trees.base
    for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
        node = 0
        while node < len(f):
            node = 2 * node + 1 + int(rows[2000, f[node]] > t[node])
        margin += leaf[node - len(f)]
    assert scores[0] == pytest.approx(1 / (1 + math.exp(-margin)))


def test_classifier_on_held_out_documents(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == held(r.doc_id, 5, 0) for r in rows)
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_classifier_never_learns_held_out_labels(spark, odd, nothing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 17)] + [(None, 1), (3, None)], "doc_id long, quality int")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted(map(tuple, quality.classify(odd, x).collect()), key=repr) for x in (labels, flipped))
    assert one == two and len(one) == odd.count() and all(0 <= r[2] <= 1 for r in one)
    assert {r[2] for r in map(tuple, quality.classify(odd, labels.limit(0)).collect())} == {0.5}
    assert quality.classify(nothing, labels).collect() == []


def test_sample_is_bounded_where_one_id_has_most_labels(spark, odd, monkeypatch):
    taken = []
    monkeypatch.setattr(quality, "fit", lambda rows, labels, fit=quality.fit: taken.append(len(labels)) or fit(rows, labels))
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int").crossJoin(spark.range(300)).drop("id")
    assert quality.classify(odd, labels, sample=20).count() == odd.count() and taken[0] <= 40


def test_scores_against_brute_force(odd, odd_rows, nothing, small_chunks):
    docs = [(r[0], WORD.findall((r[1] or "").encode().lower())) for r in odd_rows]
    counts = Counter()
    for doc, ws in docs:
        if not held(doc, 7, 2):
            counts.update(ws + [b" end"])
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for doc, ws in docs:
        ws = ws + [b" end"]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws)
        want[doc, held(doc, 7, 2), len(ws), sum(counts[w] > 0 for w in ws), total, round(base, 4)] += 1
    got = maxent.score(odd, steps=4).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert maxent.score(nothing, steps=1).collect() == []


def test_without_training_documents(spark, small_chunks):
    left_out = [i for i in range(60) if held(i, 7, 2)]
    docs = spark.createDataFrame([(i, "some words here") for i in left_out], "doc_id long, text string")
    assert {(r.n_known, r.train_tokens) for r in maxent.score(docs, steps=2).collect()} == {(0, 0)}


def test_training_raises_likelihood_and_model_beats_base(spark, sf):
    cells = spark.createDataFrame([(int(h) * maxent.CLASSES + int(h) % 5, 10 + int(h)) for h in range(50)], "cell long, n long")
    weights, course = maxent.train(cells, 8)
    assert all(b >= a - 1e-9 for a, b in zip(course, course[1:])) and course[-1] > course[0]
    probability = np.exp(maxent._log_softmax(weights[maxent._feature_rows()].sum(1)))
    assert np.allclose(probability.sum(1), 1)
    rows = maxent.score(spark.read.parquet(f"{sf}/documents.parquet")).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_common_words_have_classes_and_a_step_is_sent_without_files():
    from pyspark import cloudpickle

    assert maxent.FREQUENT == 47 and maxent.CLASSES == 64 and maxent.ROWS == 1 << 13 and maxent.STEPS == 24
    used, rows = np.unique(maxent._feature_rows(), return_inverse=True)
    weights = np.random.default_rng(3).normal(size=(len(used), maxent.CLASSES)).astype(np.float32)
    sent = cloudpickle.dumps(maxent._gradient(weights, rows.reshape(-1, maxent.FEATURES).astype(np.uint16), False))
    assert len(sent) < 1 << 20  # larger commands become broadcast files on every machine


QUESTION = "A farmer named Smith has 12 apples and sells 5 kg of them to Jones for 12 dollars each before noon today"


def search(spark, texts, items=(QUESTION,), **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, row string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r.doc_id: r.item_ids for r in templates.contamination(docs, bench, **options).collect()}


def test_templates(spark):
    other = QUESTION.replace("12", "31").replace("Smith", "Lopez").replace("5 kg", "7 lb")
    mixed = QUESTION.replace("12 apples", "31 apples").replace("12 dollars", "44 dollars")
    found = search(spark, [
        "Before it. " + QUESTION + " And after.", QUESTION.upper(), QUESTION.replace(" ", "!! "), other,
        mixed, "A farmer has apples and sells them", None, "", "12 13 14 15 16 17 18 19 20 21",
    ])
    assert [bool(found[i]) for i in range(4)] == [True] * 4
    assert found[5] == found[6] == found[7] == found[8] == []
    # the number that stood for two equal ones is two numbers: windows over both disagree
    share = {r.doc_id: r.coverage for r in templates.contamination(
        spark.createDataFrame([(0, other), (1, mixed)], "doc_id long, text string"),
        spark.createDataFrame([(0, QUESTION)], "item_id long, text string"), coverage=0.1).collect()}
    assert share[0] == 1.0 and share[1] < 1.0


def test_numbers_alone_must_be_the_same(spark):
    item = "10 20 30 40 50 60 70 80 90"
    assert search(spark, [item, "11 21 31 41 51 61 71 81 91"], [item]) == {0: [0], 1: []}


def test_lists_of_numbers_meet_their_equals_only():
    items = templates.Items([0, 1], [" ".join(map(str, range(a, a + 40))) for a in (100, 300)], templates.WIDTH)
    draw = np.random.default_rng(2)
    text = " ".join(map(str, draw.integers(1000, 9999, 20_000))) + " " + " ".join(map(str, range(300, 340)))
    data = np.frombuffer(text.encode(), np.uint8)
    (found,) = items.matches(data, np.array([0, len(data)])).values()
    assert {items.ids[i]: share for i, share in found.items()} == {1: 1.0}


def test_windows_are_found_in_every_reading():
    draw, size = np.random.default_rng(9), 6

    def text(n, capitals, stops):
        words = [w.capitalize() if draw.random() < capitals else w for w in draw.choice(["tom", "milk", "sells", "the"], n)]
        return " ".join(w + "." * (draw.random() < stops) for w in words)

    items = templates.Items(list(range(20)), [text(12, 0.4 + 0.05 * (i % 5), 0.5) for i in range(20)], size)
    texts = [text(80, capitals, stops) for capitals in (0.1, 0.3, 0.7) for stops in (0.1, 0.4) for _ in range(120)]
    data, ends = T.column_bytes(pa.array(texts))
    hashes, kind, value, words, maybe = templates.canonical(data, ends)
    found = {(w, p) for w, p, _ in items.hits(hashes, kind, value, words, maybe)}
    every = np.flatnonzero(T.fits(words, size))
    must = may = 0
    for p in np.flatnonzero(T.fits(items.words, size)).tolist():
        alike, literal, equal = np.ones(len(every), bool), np.zeros(len(every), int), np.ones(len(every), bool)
        for k in range(size):
            w = every + k
            same = items.hashes[p + k] == hashes[w]
            named = (items.kind[p + k] == templates.NAME) | items.maybe[p + k]
            alike &= same | (named & ((kind[w] == templates.NAME) | maybe[w]))
            literal += same & (kind[w] == templates.LITERAL)
            equal &= items.value[p + k] == value[w]
        alike &= (literal >= templates.LITERALS) | equal
        all_of_them = set(every[alike].tolist())
        mine = {w for w, q in found if q == p}
        assert mine <= all_of_them
        if items.maybe[p : p + size].sum() <= 3:
            assert mine == all_of_them
            must += len(mine)
        may += len(all_of_them)
    assert must > 1000 and may > must and len(found) > 0.98 * may


GERMAN = "Jeden Morgen verkauft der alte Bauer auf dem Markt frische Milch und fragt dann die Frau nach dem Preis"


def test_german_nouns_are_no_names(spark):
    other = GERMAN
    for a, b in zip("Morgen Bauer Markt Milch Frau Preis".split(), "Abend Lehrer Platz Luft Katze Wetter".split(), strict=True):
        other = other.replace(a, b)
    farm = "Auf dem Hof stehen 12 Kisten mit Milch und in jeder Kiste sind 30 Flaschen für den Markt"
    moved = farm.replace("12", "fünf").replace("30", "44")
    nouns = farm.replace("Hof", "Feld").replace("Kisten", "Hunde").replace("Milch", "Brot").replace("Kiste", "Hütte").replace("Flaschen", "Katzen")
    texts = [GERMAN, other, "Text davor. " + GERMAN + " Und mehr.", GERMAN.upper(), moved, nouns]
    assert search(spark, texts, [GERMAN, farm]) == {0: [0], 1: [], 2: [0], 3: [0], 4: [1], 5: []}


def test_numbers_and_units_of_other_languages(spark):
    items = ["Le train part à huit heures et roule pendant 3 jours avant la ville", "El tren sale en 5 horas y tarda dos semanas hasta la ciudad"]
    texts = [items[0].replace("huit", "9").replace("3 jours", "12 semaines"), items[1].replace("5 horas", "7 días").replace("dos", "4")]
    assert search(spark, texts, items) == {0: [0], 1: [1]}


LIST = """
import resource, sys
import numpy as np
from millrace.llm import templates
names = "Farmer Named Has Apples And Sells Of Them To For Dollars Rome Paris Berlin Vienna Pick One Milk Bread Chair".split()
list_item = "Pick one\\nRome\\nParis\\nBerlin\\nVienna\\nPick\\nOne\\nMilk\\nChair"
items = templates.Items([0, 1], [sys.argv[1], list_item], templates.WIDTH)
text = "\\n".join(names[i] for i in np.random.default_rng(5).integers(0, len(names), 380_000)) + "\\n" + list_item
data = np.frombuffer(text.encode(), np.uint8)
assert len(data) > 2_000_000
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = items.matches(data, np.array([0, len(data)]))
assert {items.ids[i] for i, share in found[0].items() if share == 1.0} == {1}, dict(found)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


def test_a_list_with_a_capital_on_every_line_takes_bounded_memory():
    run = subprocess.run([sys.executable, "-c", LIST, QUESTION], capture_output=True, text=True, check=False, timeout=120)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) < 150


def test_short_items_blocks_and_odd_rows(spark, odd, nothing):
    items = ["two words", None, "", QUESTION, "two words"]
    assert search(spark, ["Two words", "three words", "some two words here"], items)[0] == [0, 4]
    one = search(spark, [QUESTION, "two words"], items)
    assert one == search(spark, [QUESTION, "two words"], items, block_bytes=1)
    bench = spark.createDataFrame([(0, QUESTION)], "item_id long, text string")
    assert templates.contamination(odd, bench).filter("contaminated").count() == 0
    assert templates.contamination(odd, bench).count() == odd.count()
    assert templates.contamination(odd, bench.limit(0)).filter("NOT contaminated").count() == odd.count()
    assert templates.contamination(nothing, bench).collect() == []


TOM = "Tom has 12 apples. Tom gives 5 apples to Ann. Tom eats 2 more. How many apples does Tom have?"


def test_names_that_open_sentences_units_glued_on_and_number_words(spark):
    bob = TOM.replace("Tom", "Bob")
    kilos = "after lunch the old farmer sold 5kg of his red apples to them"
    dozen = "after supper the young baker bought twelve of her green pears from us"
    texts = [
        TOM, bob, "Then " + bob, kilos.replace("5kg", "7kg"), kilos.replace("5kg", "7 kg"), kilos.replace("5kg", "Nine kg"),
        dozen.replace("twelve", "12"), dozen.replace("twelve", "Seven"),
    ]
    assert search(spark, texts, [TOM, kilos, dozen]) == {0: [0], 1: [0], 2: [0], 3: [1], 4: [1], 5: [1], 6: [2], 7: [2]}
    # every choice of names and literals has a key
    words = ["Then Bob sold ten of his green apples", "then Tom sold 10 of his green apples", "Later then Tom sold 10 of his green apples"]
    assert search(spark, words[1:], words[:1]) == {0: [0], 1: [0]}
    assert search(spark, words[:1], words[1:2]) == {0: [0]}


def test_changes_in_the_middle_do_not_cut_an_item_in_two(spark):
    item = "blue rivers run down from tall hills toward quiet old towns where few people still live"
    ws, texts = item.split(), []
    assert len(ws) == 16
    for at in range(1, 16):
        texts += [" ".join([*ws[:at], "indeed", *ws[at + (not put) :]]) for put in (True, False)]
    assert all(search(spark, texts, [item]).values())
    assert search(spark, [" ".join(ws[8:] + ws[:8]), " ".join(ws[:8]) + " and more of that"], [item]) == {0: [], 1: []}


def test_names_and_numbers_of_more_words(spark):
    texts = [QUESTION.replace("Smith", "De Souza").replace("Jones", "Van Der Berg").replace("12", "1 200")]
    short = "we saw that Smith ran off after Smith lost what Smith found near where Smith slept"
    texts += [short.replace("Smith", "De Souza"), short]
    assert search(spark, texts, [QUESTION, short]) == {0: [0], 1: [1], 2: [1]}
    assert search(spark, texts[2:], texts[1:2]) == {0: [0]}
