"""Token shards, attribution, mixing, the registered queries and the pipeline."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from millrace.llm import attribution, mixing, tokens, training_order
from millrace.llm.queries import CASES

TRICKY = ["", " ", "a  b", " lead", "trail ", "a \n b", "it's <|endoftext|> 12 x1", "été 中文 \U0001f600", "a\tb c d", "don't  stop"]


@pytest.fixture(scope="module")
def coder():
    return tokens.Coder(tokens.read_vocabulary())


def test_known_words_give_the_ids_of_the_whole_text(coder, odd_rows):
    for text in TRICKY + [r[1] for r in odd_rows if r[1]]:
        for _ in range(2):
            assert coder.encode(text) == coder._direct(text)


def test_permutation_is_one_to_one_and_inverts():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        slots = training_order.permute(np.arange(n), n, 9)
        assert sorted(slots.tolist()) == list(range(n))
        assert (training_order.permute(slots, n, 9, inverse=True) == np.arange(n)).all()
    assert (training_order.permute(np.arange(1000), 1000, 1) != training_order.permute(np.arange(1000), 1000, 2)).any()


def test_a_worker_keeps_no_words(coder):
    held = lambda: {k: len(v) for k, v in vars(coder).items() if isinstance(v, dict)}
    before = held()
    coder.encode(" ".join(f"w{i:05}x" for i in range(5000)))
    assert held() == before


def test_shards_hold_every_token_and_resume(spark, odd, odd_rows, nothing, coder):
    path = training_order.new_path(spark)
    manifest = training_order.materialise(odd, path, length=64)
    rows = training_order.read(spark, path).orderBy("seq").collect()
    assert sorted(r.slot for r in rows) == list(range(manifest["sequences"]))
    ids = np.frombuffer(b"".join(bytes(r.ids) for r in rows), coder.kind)
    assert (ids[manifest["tokens"] :] == coder.end).all() and sum(r.n_tokens for r in rows) == manifest["tokens"]
    parts = np.split(ids[: manifest["tokens"]], np.flatnonzero(ids[: manifest["tokens"]] == coder.end) + 1)[:-1]
    got = Counter(coder._coding.decode(p[:-1].tolist()) for p in parts)
    assert got == Counter(r[1] or "" for r in odd_rows)
    late = manifest["sequences"] // 2
    again = {r.slot: bytes(r.ids) for r in training_order.read(spark, path, late).collect()}
    assert again == {r.slot: bytes(r.ids) for r in rows if r.slot >= late}
    empty = training_order.new_path(spark)
    assert training_order.materialise(nothing, empty)["sequences"] == 0
    assert training_order.read(spark, empty).collect() == []


def test_attribution(spark, odd, odd_rows, nothing, coder):
    got = attribution.attribute(odd).collect()
    sums, want = Counter(), Counter()
    for r in got:
        sums[r.doc_id] += r.n_tokens
    for doc, text, *_ in odd_rows:
        want[doc] += len(coder._direct(text or "")) // 2
    assert sums == +want
    assert attribution.attribute(nothing).collect() == []


def test_boundary_tokens_go_to_the_larger_share(coder):
    text = "unbelievably"
    assert coder.lengths[np.frombuffer(coder.encode(text), coder.kind)].tolist() == [2, 3, 3, 4]

    def cut(*at):
        _, _, _, n, crossing = attribution.spans(coder, [text], lambda data, ends: np.array([0, *at]))
        return n.tolist(), crossing.tolist()

    assert cut(4) == ([2, 2], [1, 0])  # two of three characters lie before the cut
    assert cut(3) == ([1, 3], [0, 1])
    assert cut(10) == ([4, 0], [1, 0])  # two and two: the earlier section
    assert cut(3, 4) == ([2, 0, 2], [1, 0, 0])
    text, low, high, n, _ = attribution.spans(coder, ["éa\nb", "", "c"])
    assert list(zip(text, low, high)) == [(0, 0, 3), (0, 3, 4), (2, 0, 1)]


def brute_mix(rows, seed=17, most=3):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    words = {s: sum(n for n, r in zip(size, rows) if r[3] == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    target, free, left = {}, set(sources), sum(size)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > most * words[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: most * words[s] for s in full}
        left -= sum(most * words[s] for s in full)
        free -= full
    return size, words, target


def test_mix(odd, odd_rows, nothing):
    size, words, target = brute_mix(odd_rows)
    got = mixing.mix(odd, block=16).collect()
    assert len(got) == len(odd_rows)
    assert Counter((r.doc_id, r.size, r.source_size) for r in got) == Counter((d[0], n, words[d[3]]) for d, n in zip(odd_rows, size))
    by_target = Counter()
    for r in got:
        assert r.taken <= 3 * r.size
        by_target[r.source_size, round(r.target, 6)] += r.taken
    for s in words:
        assert by_target[words[s], round(target[s], 6)] == int(target[s] + 1e-9)
    again = mixing.mix(odd.repartition(3), block=16).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixing.mix(nothing).collect() == []


def test_schedule_interleaves_sources(spark):
    goals = spark.createDataFrame([("a", 10_000, 9000.0), ("b", 10_000, 3000.0), (None, 500, 1500.0)], "src string, source_size long, target double")
    slots = mixing.schedule(goals, block=10).orderBy("slot").collect()
    assert {s: sum(r.words for r in slots if r.src == s) for s in ("a", "b", None)} == {"a": 9000, "b": 3000, None: 1500}
    for first in (300, 600, 1000):  # every stretch of the schedule is near the weights
        part = [r.src for r in slots if r.slot < first]
        assert abs(part.count("a") / len(part) - 9000 / 13500) < 0.02
    assert max(Counter((r.src, r.block) for r in slots).values()) <= 3


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("key", [k for k, c in CASES.items() if c.sql])
def test_queries_agree_with_sql(spark, con, sf, key):
    assert compare(spark, con, CASES[key], sf) is None


def test_every_operator_has_a_query():
    names = list(__spark_entry__.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_attribution_query(spark, sf, coder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sums = Counter()
    for r in CASES["op6_token_attribution"].run(spark, sf).collect():
        sums[r.doc_id] += r.n_tokens
    assert sums == +Counter({d: len(coder._direct(t)) // 2 for d, t in texts.items()})


def test_training_order_query(spark, sf, coder):
    rows = CASES["op4_training_order"].run(spark, sf).collect()
    total = sum(len(coder._direct(r.text)) // 2 + 1 for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sum(r.n_tokens for r in rows) == total and sorted(r.seq for r in rows) == list(range(len(rows)))
    assert all(len(r.ids_sha256) == 64 for r in rows) and hashlib.sha256(b"").hexdigest() not in {r.ids_sha256 for r in rows}


def test_benchmark_query_finds_every_item_in_a_text(spark, sf):
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {r.doc_id for r in CASES["op8_template_decontamination"].run(spark, sf).collect() if r.contaminated}
    assert found == {d for d, t in texts.items() if any(i in t for i in items)}


@pytest.fixture(scope="module")
def odd_tables(spark, odd, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    odd.write.parquet(f"{at}/documents.parquet")
    labels = [(i, int(i != 16), 0) for i in range(1, 17)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(0, " ".join(odd.filter("doc_id = 13").first().text.split()[2:20]))], "item_id long, text string").write.parquet(
        f"{at}/benchmark.parquet"
    )
    return at


def test_pipeline_on_odd_tables(spark, odd, odd_tables):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, odd_tables)
        assert out.columns == odd.columns
        kept = out.collect()
        docs = spark.createDataFrame(kept, odd.schema) if kept else docs.limit(0)
        if name == "near_dedup":
            assert not {2, 3} & {r.doc_id for r in kept}
        if name == "decontamination":
            assert 13 not in {r.doc_id for r in kept} and None in {r.doc_id for r in kept}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, odd_tables).count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), odd_tables).collect() == []
    assert corpus_pipeline.run(spark, odd_tables).filter(F.col("slot").isNull()).count() == 0


def test_pipeline_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = corpus_pipeline.good_quality(spark, docs, sf)
    rejected = {r.doc_id for r in CASES["op2_quality_gbt"].run(spark, sf).collect() if not r.predicted}
    assert rejected and {r.doc_id for r in good.collect()} == {r.doc_id for r in docs.collect()} - rejected
    mix = {r.doc_id: r for r in mixing.mix(docs).collect()}
    copies = Counter(r.doc_id for r in corpus_pipeline.mixed(spark, docs, sf).collect())
    assert copies == +Counter({d: int(r.taken / r.size + 0.5) for d, r in mix.items() if r.size})
