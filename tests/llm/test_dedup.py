"""Exact, near and passage deduplication against brute force on odd rows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import components, exact, near, substring, suffixes

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LAST = 1 << 62


def body(text):
    return (text or "").encode()


def ordered(rows):
    return sorted(rows, key=lambda r: (LAST if r[0] is None else r[0], r[1] or ""))


def test_exact(odd, odd_rows, nothing):
    texts = [body(r[1]).lower() for r in odd_rows]
    want = []
    for row, text in zip(odd_rows, texts):
        ids = [r[0] for r, t in zip(odd_rows, texts) if t == text]
        keep = max((i for i in ids if i is not None), default=None)
        want.append((row[0], keep, len(ids), keep is None or row[0] == keep, hashlib.sha256(text).hexdigest()))
    for capacity in (1, 2048):
        assert Counter(map(tuple, exact.dedup(odd, capacity).collect())) == Counter(want)
    assert exact.dedup(nothing).collect() == []


def test_directory_splits_until_buckets_fit(spark):
    entries = spark.range(4000).selectExpr("xxhash64(id) AS key")
    pointers, bits = exact.directory(entries, capacity=50)
    found = pointers.collect()
    assert sorted(p.cell for p in found) == list(range(1 << bits))
    placed = entries.withColumn("cell", exact._cell(bits)).join(pointers, "cell").groupBy("bucket").count().collect()
    assert max(r["count"] for r in placed) <= 50
    assert len({p.depth for p in found}) > 1


def test_colliding_keys_are_chained():
    rows = [(7, "s1", b"one", 3, 1), (7, "s2", b"two", 9, 1), (7, "s1", b"one", 5, 2), (8, "s3", b"x", None, 1)]
    columns = [pa.array(c) for c in zip(*rows)]
    columns[2] = pa.array([r[2] for r in rows], pa.binary())
    batch = pa.RecordBatch.from_arrays(columns, ["key", "sha", "body", "largest", "n"])
    out = pa.Table.from_batches(exact._owners(iter([batch.slice(0, 2), batch.slice(2)]))).to_pylist()
    assert {(r["key"], r["sha"], r["keep_id"], r["group_size"]) for r in out} == {(7, "s1", 5, 3), (7, "s2", 9, 1), (8, "s3", None, 1)}


def test_words_of_repeated_windows_go(odd, odd_rows, nothing, small_chunks):
    for width in (20, 5):
        seen, want = set(), Counter()
        for doc, text, *_ in ordered(odd_rows):
            ws = WORD.findall(body(text))
            gone = [False] * len(ws)
            for s in range(len(ws) - width + 1):
                k = tuple(ws[s : s + width])
                if k in seen:
                    gone[s : s + width] = [True] * width
                seen.add(k)
            want[doc, len(ws), sum(gone), b" ".join(w for w, g in zip(ws, gone) if not g).decode()] += 1
        assert Counter(map(tuple, substring.remove_repeats(odd, width).collect())) == want
    assert substring.remove_repeats(nothing).collect() == []


def test_bytes_of_repeated_strings_go(odd, odd_rows, nothing, small_chunks):
    for width in (50, 20):
        least, want = {}, Counter()
        for doc, text, *_ in ordered(odd_rows):
            for s in range(len(body(text)) - width + 1):
                least.setdefault(body(text)[s : s + width], LAST if doc is None else doc)
        for doc, text, *_ in odd_rows:
            t = body(text)
            gone = bytearray(len(t))
            for s in range(len(t) - width + 1):
                if least[t[s : s + width]] < (LAST if doc is None else doc):
                    gone[s : s + width] = b"\1" * width
            kept = bytes(b for b, g in zip(t, gone) if not g)
            want[doc, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept] += 1
        got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(odd, width).collect())
        assert got == want
    assert suffixes.remove_repeats(nothing).collect() == []


def test_two_stage_order_is_lexicographic():
    draw = np.random.default_rng(3)
    texts = [bytes(draw.integers(97, 100, 90, dtype=np.uint8)) for _ in range(30)] + [b"ab" * 40, b"a" * 80, b"abc" * 30]
    width, pad = 16, 32
    padded = np.frombuffer(b"".join(t + b"\0" * pad for t in texts) + b"\0" * 16, np.uint8).copy()
    begin = np.cumsum([0] + [len(t) + pad for t in texts])[:-1]
    stop = np.concatenate([np.full(len(t) + pad, b + len(t)) for t, b in zip(texts, begin)] + [np.full(16, len(padded))]).astype(np.int32)
    wanted = np.concatenate([np.arange(b, b + len(t) - width + 1) for t, b in zip(texts, begin)])
    order = suffixes.two_stage(padded, stop, wanted, width)
    assert sorted(order.tolist()) == sorted(wanted.tolist())
    heads = [padded[p : p + width].tobytes() for p in order]
    assert heads == sorted(heads)


def brute_near(rows, width=5, percent=75):
    sets = []
    for doc, text, *_ in rows:
        ws = WORD.findall(body(text).lower())
        sets.append({tuple(ws[s : s + width]) for s in range(max(len(ws) - width + 1, 1))} if ws else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return Counter((r[0], len(s), c := least.get(root(i)), r[0] is not None and r[0] == c) for i, (r, s) in enumerate(zip(rows, sets)))


def test_near(odd, odd_rows, nothing):
    assert Counter(map(tuple, near.near_duplicates(odd).collect())) == brute_near(odd_rows)
    assert near.near_duplicates(nothing).collect() == []


def test_near_in_deep_regions_and_split_clusters(spark, monkeypatch):
    from conftest_words import family

    rows = family(60)
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    monkeypatch.setattr(near, "REGION", 8)  # regions go deeper, clusters are compared region by region
    got = {r.doc_id: r.component_id for r in near.near_duplicates(docs).collect()}
    want = {r[0]: r[2] for r in brute_near(rows)}
    assert got == want
    monkeypatch.setattr(near, "SHINGLES", 900)  # two documents fill a block
    assert {r.doc_id: r.component_id for r in near.near_duplicates(docs).collect()} == want


@pytest.mark.parametrize("region, shared", [(4, 6), (8, 5), (8, 12), (1024, 6)])
def test_linked_pairs_inside_a_crowd_of_others(spark, monkeypatch, region, shared):
    """Pairs just above the similarity among texts just below it are all found, however small the windows are."""
    from conftest import words

    core, rows = words(50, 164), []
    for pair in range(60):
        both = words(1000 + pair, shared)
        rows += [(2 * pair + i, f"{core} {both} {words(5000 + 2 * pair + i, 30 - shared)}") for i in (0, 1)]
    rows += [(1000 + i, words(9000, 80) + f" end {i}") for i in range(40)]  # near copies, all linked
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(near, "REGION", region)
    want = brute_near(rows)
    assert len({r[2] for r in want}) == 61
    assert Counter(map(tuple, near.near_duplicates(docs).collect())) == want


@pytest.mark.parametrize("pack", [60, 1 << 18])
def test_rarest_shingles_are_rows_only_where_labels_differ(spark, monkeypatch, pack):
    """Crowds of two sizes: shingles of one document or of linked ones are no rows, and all links are found."""
    from conftest import words

    made, saved = {}, near._saved

    def counted(df, label):
        df = saved(df, label)
        made[label] = df.count()
        return df

    monkeypatch.setattr(near, "_saved", counted)
    monkeypatch.setattr(near, "REGION", 8)
    monkeypatch.setattr(near, "PACK", pack)
    rare = []
    for crowd in (40, 80):
        rows = [(i, f"{words(70, 200)} {words(100 + i, 20)}") for i in range(crowd)]  # all linked, each with words of its own
        rows += [(900 + i, f"{words(70, 120)} {words(700, 60 + 3 * i)}") for i in range(3)]  # share a part, linked with each other only
        want = brute_near(rows)
        assert {r[2] for r in want} == {0, 900}
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert Counter(map(tuple, near.near_duplicates(docs).collect())) == want
        assert made["forest-hot"] >= crowd
        rare.append(made["forest-rare"])
    assert rare[0] <= 10 * 43 and rare[1] <= 10 * 83  # each document has about 50 shingles among its rarest


def test_packs_and_ranges_give_the_shingles_of_several_labels(monkeypatch):
    sets = {(1, 1): [5, 9, 1 << 63], (2, 1): [5, 7], (3, 3): [7, (1 << 64) - 1], (4, 4): [(1 << 64) - 1, 1 << 40], (5, 1): [9]}
    packs, told = [], []
    for number, part in enumerate([[(1, 1), (3, 3)], [(2, 1), (5, 1)], [(4, 4)]]):
        rows = sorted((h, *who) for who in part for h in sets[who])
        blobs = [np.array(x, kind).tobytes() for x, kind in zip(zip(*rows), (np.uint64, np.int64, np.int64))]
        packs.append(pa.table({"chunk": [number], **{c: pa.array([b], pa.binary()) for c, b in zip(("hashes", "docs", "labels"), blobs)}}))
        told += near._told(4)(packs[-1].to_batches())
    told = pa.Table.from_batches(told)
    ranges = [told.filter(pa.compute.equal(told["range"], r)) for r in set(told["range"].to_pylist())]
    answers = pa.concat_tables([near._several(t) for t in ranges])
    got = set()
    for number, pack in enumerate(packs):
        rows = near._open_rows(pack, answers.filter(pa.compute.equal(answers["chunk"], number)))
        got |= {(r["lot"] % (1 << 64), r["doc"], r["label"]) for r in rows.to_pylist()}
    last = (1 << 64) - 1
    assert got == {(7, 2, 1), (7, 3, 3), (last, 3, 3), (last, 4, 4)}


def test_windows_of_sorted_orders(monkeypatch):
    """Runs up to the number are one window; longer ones are windows that overlap by half, to the end."""
    monkeypatch.setattr(near, "REGION", 4)
    first, size = near._windows(np.array([0, 1, 3, 7]), np.array([1, 3, 7, 16]))
    assert list(zip(first, size)) == [(1, 2), (3, 4), (7, 4), (9, 4), (11, 4), (13, 3)]
    first, size = near._windows(np.array([0]), np.array([1]))
    assert len(first) == len(size) == 0


def test_long_clusters_are_compared_in_blocks(spark, monkeypatch):
    from conftest_words import family

    rows = family(40)
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    monkeypatch.setattr(near, "SHINGLES", 1000)
    assert Counter(map(tuple, near.near_duplicates(docs).collect())) == brute_near(rows)
    lots = spark.createDataFrame([(1, i) for i in range(30)] + [(2, 0), (2, 5)], "lot long, doc long")
    sizes = spark.createDataFrame([(i, 100) for i in range(30)], "doc long, n long")
    met, rows = Counter(), near._in_blocks(lots, sizes).collect()
    by_lot = {lot: [r.doc for r in rows if r.lot == lot] for lot in {r.lot for r in rows}}
    for docs in by_lot.values():
        met.update((a, b) for a in docs for b in docs if a < b)
    assert len(by_lot) > 2 and set(met) == {(a, b) for a in range(30) for b in range(a + 1, 30)}


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5)], "u long, v long")
    assert {tuple(r) for r in components.components(edges).collect()} == {(2, 1), (3, 1), (7, 1), (8, 1), (9, 1), (21, 20)}


def test_components_of_a_hub_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(components, "PART", 10)
    draw = np.random.default_rng(4)
    pairs = [(i, 1) for i in range(2, 200)] + [(300 + i, 300 + i // 2) for i in range(1, 200)] + draw.integers(600, 900, (250, 2)).tolist()
    label = list(range(1000))
    for _ in range(1000):
        before = label[:]
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    edges = spark.createDataFrame([tuple(map(int, p)) for p in pairs], "u long, v long")
    assert {tuple(r) for r in components.components(edges).collect()} == {(i, c) for i, c in enumerate(label) if i != c}
